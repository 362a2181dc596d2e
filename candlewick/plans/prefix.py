"""Distributed exclusive prefix sums.

``running_offsets`` gives every row of a (reduced) table the sum of a
weight over all rows before it in a total order, without a window over the
whole table in one task:

1. range-partition by the order into P pieces and record the piece
   (written, so the ids are fixed even if a task is re-run);
2. a running sum inside each piece (window partitioned by the piece id);
3. per-piece totals -> P rows, whose running sum the driver adds up and
   hands back as P literals.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.session import Saved, save


@dataclass
class Offsets:
    df: DataFrame   # input rows + the offset
    total: int      # sum of the weight over all rows
    table: Saved    # what ``df`` reads: drop it once nothing does


def running_offsets(df: DataFrame, order: Sequence[str], weight: str, out: str = "_offset", pieces: int | None = None) -> Offsets:
    """Add ``out`` = sum of ``weight`` over rows strictly before each row.

    ``order`` must be a total order of ``df`` (unique keys).
    """
    pieces = pieces or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))
    table = save(df.repartitionByRange(pieces, *order).withColumn("_piece", F.spark_partition_id()), "prefix")
    ranged = table.df
    # at most ``pieces`` rows of two numbers
    totals = sorted((r["_piece"], int(r["t"] or 0)) for r in ranged.groupBy("_piece").agg(F.sum(weight).alias("t")).collect())
    before = dict(zip((p for p, _ in totals), accumulate((t for _, t in totals), initial=0)))
    base = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), F.col("_piece")) if before else F.lit(0)
    wp = Window.partitionBy("_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = F.sum(weight).over(wp) - F.col(weight)
    return Offsets(ranged.withColumn(out, (base + local).cast("long")).drop("_piece"), sum(t for _, t in totals), table)
