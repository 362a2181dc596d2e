"""Scalar column expressions (all JVM-side built-ins, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's for the same results.
# Columns that never count as model inputs.
NON_FEATURE_COLUMNS = ("date", "symbol", "target")
# Candidate price columns, in order of preference, for the sample-path model.
PRICE_COLUMN_PREFERENCE = ("adj_close", "close", "price")
# Floor applied to both prices before a log return is taken from them.
PRICE_FLOOR = 1e-12


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite_or_null(c: str | Column) -> Column:
    """NaN and +-inf become NULL (Spark would order NaN above every number)."""
    x = _c(c)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(x)


def inf_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Row 14: +-inf (and NaN) -> NULL on the given (default: all double) columns."""
    cols = cols if cols is not None else [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    keep = set(cols)
    return df.select([finite_or_null(c).alias(c) if c in keep else F.col(c) for c in df.columns])


def to_double(c: str | Column) -> Column:
    """Text that is not a number -> NULL; numbers -> double (ANSI-safe)."""
    return F.expr(f"try_cast({c} as double)") if isinstance(c, str) else c.try_cast("double")


def coerce_double(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Row 13: numeric (and numeric-looking text) columns -> double in one select.

    Without ``cols`` every numeric column is converted (the reference's
    "all numeric columns to float64").
    """
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    keep = set(cols)
    return df.select([F.col(c).try_cast("double").alias(c) if c in keep else F.col(c) for c in df.columns])


def zero_fill(df: DataFrame, cols: list[str]) -> DataFrame:
    """Row 15: missing model inputs -> 0.0."""
    return df.na.fill(0.0, subset=cols)


def safe_ln(c: str | Column) -> Column:
    """ln(p) for p > 0, NULL otherwise (Spark's ln is already NULL for p <= 0)."""
    x = _c(c)
    return F.when(x > 0, F.ln(x))


def candle_columns(open_="open", high="high", low="low", close="close") -> dict[str, Column]:
    """Row 12: range and body, absolute and relative to the open (open 0 -> NULL)."""
    o, h, l, c = _c(open_), _c(high), _c(low), _c(close)
    denom = F.when(o != 0, o)
    hl = (h - l).cast("double")
    oc = (c - o).cast("double")
    return {
        "hl_range": hl,
        "oc_body": oc,
        "hl_range_pct": hl / denom,
        "oc_body_pct": oc / denom,
    }


def price_from_return(last_price: str | Column, pred_return: str | Column) -> Column:
    """Row 17: pred_price = last_price * exp(pred_return)."""
    return _c(last_price) * F.exp(_c(pred_return))


def return_from_price(pred_price: str | Column, last_price: str | Column) -> Column:
    """Row 18: ln(max(pred, floor) / max(last, floor)); NULL if either is NULL
    (Spark's ``greatest`` would otherwise skip the NULL and return the floor)."""
    floor = F.lit(PRICE_FLOOR)
    pred, last = _c(pred_price), _c(last_price)
    return F.when(pred.isNotNull() & last.isNotNull(),
                  F.ln(F.greatest(pred, floor) / F.greatest(last, floor)))


def canonical(c: str | Column) -> Column:
    """Comparison form of a double: 9 decimals, then single precision.

    Two engines that sum in different orders differ in the last bits; an
    absolute rounding is fragile for large magnitudes (prices ~1e5) and a
    relative one for values that cancel to ~0.  Rounding to 9 places and
    then to float (about 7 significant digits) is stable for both.  The
    oracle SQL applies the same ``CAST(CAST(round(x, 9) AS FLOAT) AS DOUBLE)``.

    ``round`` goes through the decimal text of the number, which costs more than
    all the features.  Below 1e5 the nearest whole number of 1e-9 is the same,
    unless the rest is so near a half that the last bits could decide.
    """
    x = _c(c)
    y = x * 1e9
    plain = (F.abs(x) < 1e5) & (F.abs(y - F.floor(y) - 0.5) > 0.05)
    return F.when(plain, F.floor(y + 0.5) / 1e9).otherwise(F.round(x, 9)).cast("float").cast("double")


def round_doubles(df: DataFrame) -> DataFrame:
    """Canonical form of every double column (checked queries and their oracles)."""
    return df.select(
        [
            canonical(f.name).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
