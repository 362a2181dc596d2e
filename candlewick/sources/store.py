"""Bar store: prepared bars as a table partitioned by year and bucketed by symbol (row 1).

Series jobs need the rows of a symbol side by side.  Read from plain files
that is an exchange for every job; the store pays it once, when bars are
written.  Windows per symbol (``segment=None``), and windows per symbol and
segment, then plan no exchange, and a date bound skips the years outside it.

Rows without symbol or date are left out and prices that are not finite become
null, as ``prepare_bars`` does.  Repeated rows stay.  An empty table gives an
empty store.  Further columns are kept; one named like the year column is
refused.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.sources.bars import filter_universe, prepare_bars

YEAR = "bar_year"
BUCKETS = 64


def write_bar_store(bars: DataFrame, table: str, buckets: int = BUCKETS, mode: str = "errorifexists", path: str | None = None) -> None:
    """Write bars to catalog table ``table`` (at ``path``, or in the warehouse).

    ``mode`` is the writer's: ``append`` adds a day's bars to a store with the
    same ``buckets``.  Rows are dealt by year and bucket, so a write makes one
    file for each, and a symbol with very many rows is one task a year.
    """
    if YEAR in bars.columns:
        raise ValueError(f"column {YEAR} is the store's own")
    ready = prepare_bars(bars).withColumn(YEAR, F.year("date"))
    dealt = ready.repartition(YEAR, F.pmod(F.hash("symbol"), F.lit(buckets)))      # as Spark's bucket of a row
    writer = (dealt.sortWithinPartitions(YEAR, F.pmod(F.hash("symbol"), F.lit(buckets)), "symbol", "date")
              .write.format("parquet").mode(mode).partitionBy(YEAR).bucketBy(buckets, "symbol").sortBy("symbol", "date"))
    (writer.option("path", path) if path else writer).saveAsTable(table)


def read_bar_store(spark: SparkSession, table: str, since: dt.date | None = None, until: dt.date | None = None,
                   universe: Sequence[str] | None = None) -> DataFrame:
    """The store's bars, of the days from ``since`` to ``until`` (both included)
    and the symbols of ``universe`` where given.

    A bound becomes a filter on the year column too, which leaves out whole
    folders, and on the day, which goes to the scan; ``universe`` reads only
    the buckets of its symbols.  A task gets a bucket of all years read: series
    of more rows than a task can hold want ``symbol`` split first
    (``repartition("symbol", YEAR)`` and the default segment).
    """
    df = spark.table(table)
    if since is not None:
        df = df.where((F.col(YEAR) >= since.year) & (F.to_date("date") >= F.lit(since)))
    if until is not None:
        df = df.where((F.col(YEAR) <= until.year) & (F.to_date("date") <= F.lit(until)))
    return filter_universe(df, list(universe) if universe else None).drop(YEAR)
