"""Split long series into time segments with an exact row halo.

A window ``partitionBy(symbol).orderBy(date)`` puts a whole series into one
task; if one symbol holds a third of the data that task holds a third of the
data.  Instead every series is cut into segments (by default the calendar
year of the date) and windows are partitioned by ``(symbol, segment)``.  To
keep results exact, each segment receives copies of

* the ``back`` rows that precede it in its series (its *look-back halo*), and
* the ``fwd`` rows that follow it (its *look-ahead halo*),

which is all a ``lag``/``lead``/``rowsBetween(-back, fwd)`` window needs.  A
segment with fewer rows than the halo width is handled exactly: the halo is
taken from as many earlier (later) segments as needed.

Only *tails* and *heads* of segments (at most ``back``/``fwd`` rows per
segment, pre-limited on the map side by Spark's ``WindowGroupLimit``) and a
per-segment count table are shuffled besides the data itself, so the extra
cost is O(segments x halo), independent of how hot a symbol is.

Tables whose series are all short need none of it: ``has_long_series`` is a
scalar subquery, counted from the keys alone, under which ``with_halo`` cuts
and copies, or leaves every series whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEG = "_seg"
HALO = "_halo"  # 0 = own row, 1 = look-back copy, 2 = look-ahead copy


#: Longest piece of one series that a window holds.  Nothing is counted to
#: choose it; intraday bars take "hour" or "minute", any other cut a Column.
DEFAULT_SEGMENT = "year"


#: Rows of a series that one window takes whole where the cut is the default one.
LONG_SERIES = 25_000


def has_long_series(df: DataFrame, keys: Sequence[str]) -> Column:
    """Whether a series of ``df`` has more than ``LONG_SERIES`` rows, found
    when the plan runs."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg((F.coalesce(F.max("_n"), F.lit(0)) > LONG_SERIES).alias("_long")).scalar()


def has_keys(keys: Sequence[str], seg: Column) -> Column:
    out = seg.isNotNull()
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def only_if(df: DataFrame, whole: Column, row: Column) -> DataFrame:
    """The rows that meet ``row`` if the table meets ``whole``, else none: one
    condition on the rows' keys, so that it reaches the scan below an aggregate."""
    return df.where(F.when(whole, row).otherwise(F.lit(False)))


def segment_of(date_col: str, unit: str | Column | None) -> Column | None:
    """Segment id (bigint) that never decreases along a series' date order;
    ``None`` when the series should not be split."""
    if isinstance(unit, Column):
        return unit.cast("long")
    if unit is None or unit == "none":
        return None
    d = F.col(date_col)
    if unit == "year":
        return F.year(d).cast("long")
    if unit == "quarter":
        return (F.year(d) * 4 + F.quarter(d)).cast("long")
    if unit == "month":
        return (F.year(d) * 12 + F.month(d)).cast("long")
    if unit == "week":
        return F.floor(F.unix_date(F.to_date(d)) / 7).cast("long")
    if unit == "day":
        return F.unix_date(F.to_date(d)).cast("long")
    if unit in SECONDS:
        return F.floor(F.unix_seconds(d.cast("timestamp")) / SECONDS[unit]).cast("long")
    raise ValueError(f"unknown segment unit: {unit!r}")


SECONDS = {"hour": 3600, "minute": 60}


TIE = "_tb"


def total_order(df: DataFrame, order: Sequence[str]) -> tuple[DataFrame, list[str], list[str]]:
    """``df`` with a tie-breaker, the order with it, and the columns added.

    The tie-breaker is a hash of the whole row (kept if the frame has one
    already), so rows that still tie are equal and interchangeable."""
    if TIE in df.columns:
        return df, [*[c for c in order if c != TIE], TIE], []
    return df.withColumn(TIE, F.xxhash64(*[F.col(c) for c in df.columns])), [*order, TIE], [TIE]


def _order_cols(order: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order]


def with_halo(df: DataFrame, keys: Sequence[str], order: Sequence[str], segment: Column | None,
              back: int, fwd: int = 0, cut: Column | None = None) -> DataFrame:
    """Return ``df`` plus halo copies, with columns ``_seg`` and ``_halo``.

    ``order`` must be a total order inside each key (add a tie-breaker).
    Rows with ``_halo = 0`` are the input rows, each exactly once.  Unless
    ``cut`` (a condition on the whole table) holds, series stay whole; rows
    without a key or a segment, which have no halo, keep theirs either way.
    """
    keys = list(keys)
    if segment is None:  # one segment per key: nothing to copy
        return df.withColumn(SEG, F.lit(0).cast("long")).withColumn(HALO, F.lit(0))
    seg = segment.cast("long")
    if cut is not None and (back > 0 or fwd > 0):
        keyed = has_keys(keys, seg)
        base = only_if(df, cut, keyed).withColumn(SEG, seg)
        own = df.withColumn(SEG, F.when(keyed & ~cut, F.lit(0).cast("long")).otherwise(seg)).withColumn(HALO, F.lit(0))
    else:
        base = df.withColumn(SEG, seg)
        own = base.withColumn(HALO, F.lit(0))
    if back <= 0 and fwd <= 0:
        return own

    part = keys + [SEG]
    cols = df.columns

    def edge(n: int, descending: bool) -> DataFrame:
        w = Window.partitionBy(*part).orderBy(*_order_cols(order, descending))
        return base.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)

    tails = edge(back, True) if back > 0 else None
    heads = edge(fwd, False) if fwd > 0 else None

    # Per-segment table.  Every segment is non-empty, so its tail / head holds
    # least(n, back) / least(n, fwd) rows: one partial aggregate gives both.
    # The windows below run over segments, not rows.
    counts = base.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"))
    ws = Window.partitionBy(*keys).orderBy(SEG)

    def reach(n: int, before: bool) -> DataFrame:
        """(keys, source segment, target segment, rows between them) for the
        sources whose edge rows can lie within ``n`` rows of a target: only
        those reached, found in the target's own row."""
        rows = F.least(F.col("_n"), F.lit(n))
        upto = F.sum(rows).over(ws.rowsBetween(Window.unboundedPreceding, 0))
        seg = counts.select(*keys, F.col(SEG), rows.alias("_e"), upto.alias("_c"))
        near = ws.rowsBetween(-n, -1) if before else ws.rowsBetween(1, n)
        others = F.collect_list(F.struct(F.col(SEG).alias("s"), F.col("_c").alias("c"), F.col("_e").alias("e"))).over(near)
        gap = ((lambda x: F.col("_c") - F.col("_e") - x["c"]) if before else (lambda x: x["c"] - x["e"] - F.col("_c")))
        reached = F.filter(F.transform(others, lambda x: F.struct(x["s"].alias("s"), gap(x).alias("gap"))), lambda x: x["gap"] < n)
        return (seg.select(*keys, F.col(SEG).alias("_to"), reached.alias("_x"))
                .select(*keys, "_to", F.explode("_x").alias("_x"))
                .select(*keys, F.col("_x.s").alias(SEG), "_to", F.col("_x.gap").alias("_gap")))

    pieces = [own.select(*cols, SEG, HALO)]
    for edges, n, before, kind in ((tails, back, True, 1), (heads, fwd, False, 2)):
        if edges is not None:
            pieces.append(edges.join(reach(n, before), part).where(F.col("_r") - 1 + F.col("_gap") < n)
                          .select(*cols, F.col("_to").alias(SEG), F.lit(kind).alias(HALO)))
    out = pieces[0]
    for p in pieces[1:]:
        out = out.unionByName(p)
    return out
