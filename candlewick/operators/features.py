"""Per-series window features (inventory rows 12, 20-31).

All features share one window spec ``partitionBy(symbol, segment)
.orderBy(date, tie-breaker)`` and are produced by two window selects: one
for the shifted log price, price and volume, from which the log return and
its rolling statistics are plain arithmetic, one for the lags and the forward
target.  That is one exchange, one sort and two Window operators for the
whole feature frame, and no window frame that is summed anew at every row.

Rolling statistics follow the full-window rule: NULL unless all ``n`` rows
of the frame are present and non-NULL, like a rolling window with
``min_periods = n``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.columns import candle_columns, safe_ln
from candlewick.plans.segments import DEFAULT_SEGMENT, HALO, SEG, has_long_series, segment_of, total_order, with_halo
from candlewick.session import compiled_methods

# Fixed values that must equal the reference's for the same features.
RETURN_LAGS = (1, 2, 5)
RETURN_WINDOWS = (3, 5, 10)
VOLUME_WINDOWS = (5, 10)
PRICE_WINDOWS = (5, 10)
MSG_NO_FEATURES = "No numeric feature columns found after filtering."
# Longest look-back any feature needs (rolling 10 over returns needs 10 prior prices).
FEATURE_LOOKBACK = 10
# Raw bars needed for one complete feature row.
MIN_FEATURE_ROWS = FEATURE_LOOKBACK + 1


def series_window(group_col: str | Sequence[str] = "symbol", order: Sequence[str] = ("date",)) -> Window:
    groups = [group_col] if isinstance(group_col, str) else list(group_col)
    return Window.partitionBy(*groups, SEG).orderBy(*order)


def guarded(fn: Callable[[Column], Column], c: str, n: int, w: Window) -> Column:
    """Rolling ``fn`` over the last ``n`` rows, NULL unless the frame is full."""
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(F.col(c)).over(frame) == n, fn(F.col(c)).over(frame))


def _log_return(price_col: str, w: Window) -> Column:
    lp = safe_ln(price_col)
    return lp - F.lag(lp, 1).over(w)


def rolling_mean(x: Sequence[Column], n: int) -> Column:
    """Mean of ``x[0]`` (the row itself) to ``x[n - 1]``, summed oldest first
    as ``avg`` does; NULL if one of them is."""
    return sum(x[n - 2::-1], x[n - 1]) / n


def rolling_std(x: Sequence[Column], n: int) -> Column:
    """Sample deviation of ``x[0]`` to ``x[n - 1]``, from their distances to
    ``x[0]``: a value of the frame is at most n times as far from the others as
    their spread, so the subtraction loses no digits that matter."""
    d = [v - x[0] for v in x[1:n]]
    total, squares = sum(d[1:], d[0]), sum((v * v for v in d[1:]), d[0] * d[0])
    ss = squares - total * total / n
    return F.sqrt(F.when(ss < 0, F.lit(0.0)).otherwise(ss) / (n - 1))


def rolling_extreme(fn: Callable[..., Column], x: Sequence[Column], windows: Sequence[int]) -> dict[int, Column]:
    """``least`` or ``greatest`` of ``x[0]`` to ``x[n - 1]`` by ``n`` (ascending),
    each from the one before; they skip NULL, so the caller guards."""
    out, held, done = {}, [], 0
    for n in windows:
        held = [fn(*held, *x[done:n])]
        out[n], done = held[0], n
    return out


def _shifted(c: str, n: int, w: Window) -> list[Column]:
    """Column ``c`` of the row itself and of the ``n`` rows before it."""
    return [F.col(c), *[F.lag(c, k).over(w) for k in range(1, n + 1)]]


def _in_doubles(df: DataFrame, c: str) -> bool:
    """Whether ``avg`` of the column is taken in doubles (decimals are not)."""
    return isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType, T.IntegralType))


def rolling_features(df: DataFrame, price_col: str, w: Window) -> DataFrame:
    """``df`` with ``log_return_1`` and the rolling statistics (row 30).

    Every value a statistic needs is brought to its row by an offset, which
    costs a row no more for a wider frame, and combined by built-in arithmetic.
    """
    shifts: dict[str, int] = {"_at_log": FEATURE_LOOKBACK}
    base = df.withColumn("_at_log", safe_ln(price_col))
    windows = {c: ws for c, ws in (("volume", VOLUME_WINDOWS), (price_col, PRICE_WINDOWS)) if c in df.columns}
    names = {"volume": "vol", price_col: "price"}
    for c, ws in windows.items():
        if _in_doubles(df, c):
            base = base.withColumn(f"_at_{names[c]}", F.col(c).cast("double"))
            shifts[f"_at_{names[c]}"] = max(ws) - 1
    lagged = base.select("*", *[x.alias(f"{c}_{k}") for c, n in shifts.items() for k, x in enumerate(_shifted(c, n, w)) if k])
    at = {c: [F.col(c), *[F.col(f"{c}_{k}") for k in range(1, n + 1)]] for c, n in shifts.items()}
    r = [now - before for now, before in zip(at["_at_log"], at["_at_log"][1:])]
    out = [r[0].alias("log_return_1")]
    low, high = rolling_extreme(F.least, r, RETURN_WINDOWS), rolling_extreme(F.greatest, r, RETURN_WINDOWS)
    for n in RETURN_WINDOWS:
        mean = rolling_mean(r, n)
        out += [mean.alias(f"r_mean_{n}"), rolling_std(r, n).alias(f"r_std_{n}"),
                F.when(mean.isNotNull(), low[n]).alias(f"r_min_{n}"), F.when(mean.isNotNull(), high[n]).alias(f"r_max_{n}")]
    for c, ws in windows.items():
        x = at.get(f"_at_{names[c]}")
        for n in ws:
            out += [(rolling_mean(x, n) if x else guarded(F.avg, c, n, w)).alias(f"{names[c]}_mean_{n}"),
                    (rolling_std(x, n) if x else guarded(F.stddev_samp, c, n, w)).alias(f"{names[c]}_std_{n}")]
    return lagged.select(*df.columns, *out)


def feature_columns(cols: Sequence[str], price_col: str, w: Window) -> list[tuple[str, Column]]:
    """Named feature expressions (row 30) in the reference's creation order,
    on a frame of :func:`rolling_features`."""
    out: list[tuple[str, Column]] = []
    r = "log_return_1"
    for k in RETURN_LAGS:
        out.append((f"r_lag_{k}", F.lag(r, k).over(w)))
    held = [f"r_{s}_{n}" for n in RETURN_WINDOWS for s in ("mean", "std", "min", "max")]
    out += [(c, F.col(c)) for c in held]
    if "volume" in cols:
        out.append(("vol_lag_1", F.lag("volume", 1).over(w)))
        out += [(c, F.col(c)) for n in VOLUME_WINDOWS for c in (f"vol_mean_{n}", f"vol_std_{n}")]
    if {"open", "high", "low", "close"}.issubset(cols):
        out.extend(candle_columns().items())
    if price_col in cols:
        out.append(("price_lag_1", F.lag(price_col, 1).over(w)))
        out += [(c, F.col(c)) for n in PRICE_WINDOWS for c in (f"price_mean_{n}", f"price_std_{n}")]
    return out


def _prepare(bars: DataFrame, tiebreak: str | None) -> tuple[DataFrame, list[str]]:
    """Volume as double (row 13) and a total order inside every series (quirk Q10)."""
    df = bars
    if "volume" in df.columns:
        df = df.withColumn("volume", F.col("volume").try_cast("double"))
    if tiebreak is None:
        df, order, _ = total_order(df, ["date"])
        return df, order
    return df, ["date", tiebreak]


def tabular_features(bars: DataFrame, group_col: str = "symbol", price_col: str = "adj_close",
                     horizon: int | None = None, segment: str | Column | None = DEFAULT_SEGMENT,
                     tiebreak: str | None = None, keep_internal: bool = False) -> DataFrame:
    """Rows 20-31: returns, lags, guarded rolling stats, candle features, and
    (if ``horizon`` is given) the forward target ``lead(log_return_1, h)``.

    ``segment`` cuts long series into parallel pieces with an exact halo;
    ``None`` partitions by symbol only; the default leaves series whole if all
    are short (``segments.LONG_SERIES``).  ``keep_internal`` keeps the segment
    id ``_seg`` and the tie-breaker, so a later window with the same spec
    (``series_window``) reuses this plan's partitioning and sort order.
    """
    compiled_methods(bars.sparkSession)
    df, order = _prepare(bars, tiebreak)
    fwd = int(horizon) if horizon else 0
    cut = has_long_series(df, [group_col]) if isinstance(segment, str) and segment == DEFAULT_SEGMENT else None
    halo = with_halo(df, [group_col], order, segment_of("date", segment), back=FEATURE_LOOKBACK, fwd=fwd, cut=cut)
    w = series_window(group_col, order)
    extra = [e.alias(n) for n, e in feature_columns(df.columns, price_col, w)]
    if fwd:
        extra.append(F.lead("log_return_1", fwd).over(w).alias("target"))
    rolled = rolling_features(halo, price_col, w)
    out = rolled.select(*halo.columns, "log_return_1", *extra).where(F.col(HALO) == 0).drop(HALO)
    if not keep_internal:
        out = out.drop(SEG)
        if tiebreak is None:
            out = out.drop("_tb")
    return out


def add_returns(bars: DataFrame, price_col: str = "adj_close", group_col: str = "symbol",
                segment: str | Column | None = DEFAULT_SEGMENT, tiebreak: str | None = None) -> DataFrame:
    """Row 20: log_return_1 = ln(p_t) - ln(p_{t-1}) per series."""
    df, order = _prepare(bars, tiebreak)
    halo = with_halo(df, [group_col], order, segment_of("date", segment), back=1)
    w = series_window(group_col, order)
    out = halo.select("*", _log_return(price_col, w).alias("log_return_1")).where(F.col(HALO) == 0).drop(SEG, HALO)
    return out.drop("_tb") if tiebreak is None else out


def forward_target(features: DataFrame, horizon: int = 1, group_col: str = "symbol",
                   segment: str | Column | None = DEFAULT_SEGMENT, tiebreak: str | None = None,
                   drop_missing: bool = True) -> DataFrame:
    """Row 31: target = log_return_1 of the row ``horizon`` steps ahead; rows
    without a target are dropped (as the reference does)."""
    df, order = _prepare(features, tiebreak)
    halo = with_halo(df, [group_col], order, segment_of("date", segment), back=0, fwd=horizon)
    w = series_window(group_col, order)
    out = (
        halo.select("*", F.lead("log_return_1", horizon).over(w).alias("target"))
        .where(F.col(HALO) == 0)
        .drop(SEG, HALO)
    )
    if tiebreak is None:
        out = out.drop("_tb")
    return out.dropna(subset=["target"]) if drop_missing else out


def model_feature_names(df: DataFrame) -> list[str]:
    """Row 16 (first half): every numeric column except date/symbol/target, sorted."""
    from candlewick.functions.columns import NON_FEATURE_COLUMNS
    from pyspark.sql import types as T

    names = [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in NON_FEATURE_COLUMNS and not f.name.startswith("_")
    ]
    if not names:
        raise ValueError(MSG_NO_FEATURES)
    return sorted(names)
