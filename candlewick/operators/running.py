"""Running quantiles over whole histories (row 49, at every row).

The quantile of all values up to a row moves slowly: while a block of B rows
passes, its rank moves by at most B places.  So a block needs only a slice of
about 2 B neighbouring order statistics of what came before, its own values,
and the number of earlier values below the slice:

1. rows are cut into blocks by their position, values into buckets by their
   rank in the series (equal values are one, counted per block);
2. counts by (block, bucket), summed over earlier blocks and then over lower
   buckets, tell which buckets hold each block's slice: (n / B)^2 small rows
   for a series of n values;
3. only those buckets are opened, and cut to the slice's ranks;
4. a block and its slice meet in one task, which inserts the block's values
   in time order into the sorted slice and reads the quantile by position.

No task holds more than a block and its slice, and no row sorts its history
anew.  The steps between are written tables, so jobs run while the result is
built; only the result stays.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Callable, Sequence
from math import ceil, floor

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.columns import finite_or_null, return_from_price
from candlewick.operators.models import MIN_CONTEXT, QUANTILE, pick_price_col
from candlewick.operators.splits import global_position
from candlewick.plans.prefix import running_offsets
from candlewick.plans.segments import DEFAULT_SEGMENT, HALO, SEG, segment_of, total_order, with_halo
from candlewick.session import Saved, save

#: Rows of a block: a task holds about three times as many values.
BLOCK_ROWS = 8192


def running_quantile(rows: DataFrame, q: float, group_col: str = "symbol", value: str = "value", pos: str = "pos",
                     block_rows: int = BLOCK_ROWS) -> Saved:
    """``(pos, quantile)``: the linearly interpolated ``q`` quantile of the
    group's values up to each row; NULL before the first one.

    ``pos`` is a unique position by which every group's rows are contiguous
    (``splits.global_position``); ``rows`` should be a stored table, as it is
    read several times.  NULL and NaN values take no part.  An empty table
    gives an empty one.
    """
    v = F.nanvl(F.col(value).cast("double"), F.lit(None))
    src = rows.select(F.col(group_col).alias("_g"), F.col(pos).alias("_pos"), F.expr(f"`{pos}` div {int(block_rows)}").alias("_t"), v.alias("_v"))
    tallies = src.where("_v is not null").groupBy("_g", "_t", "_v").agg(F.count(F.lit(1)).alias("_c"))
    ranks = running_offsets(tallies.groupBy("_g", "_v").agg(F.sum("_c").alias("_c")), ["_g", "_v"], "_c", "_off")
    bucket = ranks.df.select("_g", "_v", F.expr(f"_off div {int(block_rows)}").alias("_b"))
    cells = save(tallies.join(bucket, ["_g", "_v"]), "running-cells")
    ranks.table.drop()

    blocks = save(_with_slice_ranks(src, q), "running-blocks")
    opened = _slices(blocks.df, cells.df)
    own = src.join(blocks.df.select("_g", "_t", "_first", "_before", "_lo"), ["_g", "_t"])
    both = own.select("_t", "_pos", "_first", "_before", "_lo", "_v", F.lit(1).cast("long").alias("_n")).unionByName(
        opened.select("_t", F.lit(-1).cast("long").alias("_pos"), *[F.lit(0).cast("long").alias(c) for c in ("_first", "_before", "_lo")], "_v", "_n"))
    found = both.groupBy("_t").applyInPandas(_quantiles_of_block(q), "_pos long, _q double")
    out = save(found.select(F.col("_pos").alias(pos), F.nanvl("_q", F.lit(None).cast("double")).alias("quantile")), "running-quantile")
    cells.drop(), blocks.drop()
    return out


def _with_slice_ranks(src: DataFrame, q: float) -> DataFrame:
    """(group, block) with its first position, the number of earlier values
    and the ranks ``_lo`` to ``_hi`` among them that its rows may ask for."""
    before = F.coalesce(F.sum("_m").over(Window.partitionBy("_g").orderBy("_t").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per = src.groupBy("_g", "_t").agg(F.min("_pos").alias("_first"), F.count("_v").alias("_m")).withColumn("_before", before)
    # own values below the slice shift its ranks by up to _m; one more place for rounding
    lo = F.floor(F.lit(float(q)) * F.greatest(F.col("_before") - 1, F.lit(0))) - F.col("_m") - 1
    hi = F.ceil(F.lit(float(q)) * (F.col("_before") + F.col("_m") - 1)) + 1
    return per.withColumns({"_lo": F.greatest(lo, F.lit(0)).cast("long"), "_hi": F.least(hi, F.col("_before") - 1).cast("long")})


def _slices(blocks: DataFrame, cells: DataFrame) -> DataFrame:
    """(block, value, times): the earlier values of ranks ``_lo`` to ``_hi``."""
    counts = cells.groupBy("_g", "_t", "_b").agg(F.sum("_c").alias("_k"))
    span = counts.groupBy("_g").agg(F.min("_b").alias("_b0"), F.max("_b").alias("_b1"))
    grid = blocks.join(span, "_g").select("_g", "_t", "_lo", "_hi", F.explode(F.sequence("_b0", "_b1")).alias("_b"))
    earlier = Window.partitionBy("_g", "_b").orderBy("_t").rowsBetween(Window.unboundedPreceding, -1)
    lower = Window.partitionBy("_g", "_t").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    grid = (grid.join(counts, ["_g", "_t", "_b"], "left")
            .withColumn("_past", F.coalesce(F.sum("_k").over(earlier), F.lit(0)))
            .withColumn("_start", F.coalesce(F.sum("_past").over(lower), F.lit(0))))
    wanted = (F.col("_past") > 0) & (F.col("_start") <= F.col("_hi")) & (F.col("_start") + F.col("_past") > F.col("_lo"))
    hits = grid.where(wanted).select("_g", "_b", F.col("_t").alias("_to"), "_start", "_lo", "_hi")
    values = (hits.join(cells, ["_g", "_b"]).where(F.col("_t") < F.col("_to"))
              .groupBy("_g", "_to", "_b", "_start", "_lo", "_hi", "_v").agg(F.sum("_c").alias("_c")))
    upto = F.col("_start") + F.sum("_c").over(Window.partitionBy("_g", "_to", "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    inside = F.least(upto, F.col("_hi") + 1) - F.greatest(upto - F.col("_c"), F.col("_lo"))
    return values.withColumn("_n", inside.cast("long")).where("_n > 0").select(F.col("_to").alias("_t"), "_v", "_n")


def _quantiles_of_block(q: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(block: pd.DataFrame) -> pd.DataFrame:
        is_slice = block["_pos"].to_numpy() < 0
        past = np.sort(np.repeat(block["_v"].to_numpy()[is_slice], block["_n"].to_numpy()[is_slice])).tolist()
        own = block[~is_slice].sort_values("_pos")
        out, held, low, count, series = [], [], 0, 0, None
        for first, before, lo, value in zip(*[own[c].tolist() for c in ("_first", "_before", "_lo", "_v")]):
            if first != series:       # only a block's first series has earlier values
                series, count, low, held = first, before, lo, past if before else []
            if value == value:
                insort(held, value)
                count += 1
            if not count:
                out.append(float("nan"))
                continue
            at = q * (count - 1)
            i, j = floor(at), ceil(at)
            x, y = held[i - low], held[j - low]
            out.append(x if i == j else x * (j - at) + y * (at - i))
        return pd.DataFrame({"_pos": own["_pos"].to_numpy(), "_q": np.array(out, dtype=float)})

    return run


def running_forecast_rows(df: DataFrame, horizon: int = 1, quantile: float = QUANTILE, min_context: int = MIN_CONTEXT,
                          group_col: str = "symbol", segment: str | Column | None = DEFAULT_SEGMENT,
                          price_col: str | None = None, keep: Sequence[str] = (), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``quantile_forecast_rows`` of the whole history up to every row, for
    series of any length: same columns and values, by ``running_quantile``.

    Paths replayed from a row's price scale with it, so its forecast is the
    price times the running quantile of ``exp`` of all h-step log returns."""
    keep = [c for c in keep if c not in (group_col, "date")]
    pc = price_col or pick_price_col(df)
    df, full, _ = total_order(df, ["date"])
    valid = df.select(group_col, *full, *[c for c in keep if c not in full], finite_or_null(pc).alias("_p")).where(F.col("_p").isNotNull())
    halo = with_halo(valid, [group_col], full, segment_of("date", segment), back=max(horizon, min_context - 1))
    w = Window.partitionBy(group_col, SEG).orderBy(*full)
    lp = F.ln(F.col("_p"))
    step = halo.select(
        "*", F.exp(lp - F.lag(lp, horizon).over(w)).alias("_move"),
        (F.count(F.lit(1)).over(w.rowsBetween(-(min_context - 1), 0)) == min_context).alias("accepted"),
    ).where(F.col(HALO) == 0).drop(HALO, SEG)
    stored = save(step, "running-steps")
    placed = save(global_position(stored.df, group_col, full, segment, out="_pos").df, "running-rows")
    stored.drop()
    quantiles = running_quantile(placed.df, quantile, group_col, "_move", "_pos", block_rows)
    price = F.when(F.col("accepted"), F.col("_p") * F.col("quantile"))
    out = placed.df.join(quantiles.df, "_pos").select(group_col, "date", *keep, F.col("_p").alias("last_price"), "accepted", price.alias("pred_price"))
    result = save(out.withColumn("pred_return", return_from_price("pred_price", "last_price")), "running-forecast")
    placed.drop(), quantiles.drop()
    return result.df
