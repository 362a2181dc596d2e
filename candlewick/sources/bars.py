"""Bar sources: load/validate/clean daily bars, plus adapters from the test tables.

A bar table is ``symbol string, date date|timestamp, open, high, low, close,
adj_close double, volume bigint|double`` (extra columns kept).  Everything
here is a lazy plan; nothing is sorted globally (series order lives in the
window specs downstream).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.columns import finite_or_null

# The bar columns every input must carry.
REQUIRED_BAR_COLUMNS = ("symbol", "date", "open", "high", "low", "close", "volume", "adj_close")
PRICE_COLUMNS = ("open", "high", "low", "close", "adj_close")
MSG_MISSING_COLUMNS = "Dataset missing required columns: {missing}. Found columns: {found}"


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, cols) -> None:
    """Fail listing missing and found columns when a required one is absent."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise MissingColumnsError(MSG_MISSING_COLUMNS.format(missing=sorted(missing), found=df.columns))


# Text date layouts tried after the ISO forms, in this order (our choice;
# month-first for slashed dates, as a lenient date parser reads them).
DATE_FALLBACK_FORMATS = ("MM/dd/yyyy", "MM/dd/yyyy HH:mm:ss", "yyyy/MM/dd", "yyyyMMdd", "dd-MMM-yyyy")


def coerce_date(df: DataFrame, col: str = "date") -> DataFrame:
    """Row 2: parse the date; a value that does not parse becomes NULL.

    Temporal columns are kept as they are; text goes through
    ``try_to_timestamp`` (a plain cast raises under ANSI mode): ISO forms
    first, then the fixed fallback layouts, first match wins.
    """
    dt = df.schema[col].dataType
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return df
    return df.withColumn(col, parse_date(F.col(col)))


def parse_date(value: Column) -> Column:
    """The expression behind :func:`coerce_date`, for text."""
    text = F.trim(value.cast("string"))
    return F.coalesce(F.try_to_timestamp(text), *[F.try_to_timestamp(text, F.lit(fmt)) for fmt in DATE_FALLBACK_FORMATS])


def drop_missing_keys(df: DataFrame, cols=("date", "symbol")) -> DataFrame:
    """Row 3: drop rows missing any key (NaN in a double key counts as missing)."""
    cols = list(cols)
    fixed = df
    doubles = [c for c in cols if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))]
    if doubles:
        fixed = df.select([finite_or_null(c).alias(c) if c in doubles else F.col(c) for c in df.columns])
    return fixed.dropna(subset=cols)


def clean_prices(df: DataFrame) -> DataFrame:
    """NaN / +-inf prices -> NULL at the boundary (see SURVEY missing-value rules)."""
    return df.select([finite_or_null(c).alias(c) if c in PRICE_COLUMNS else F.col(c) for c in df.columns])


def load_bars(spark: SparkSession, path: str, fmt: str = "parquet", options: dict | None = None,
              universe: list[str] | None = None) -> DataFrame:
    """Row 1: read bars from any Spark source, check columns, coerce date, drop keyless rows.

    ``universe`` (row 6) is applied right after the scan so it is pushed to
    the source as ``In(symbol, ...)``.
    """
    reader = spark.read.format(fmt)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    df = reader.load(path)
    return prepare_bars(df, universe)


def numeric_text_to_double(df: DataFrame, cols=PRICE_COLUMNS + ("volume",)) -> DataFrame:
    """Row 13 at load: value columns that arrive as text (CSV without schema
    inference, JSON strings) become double; text that is not a number -> NULL."""
    text = {c for c in cols if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)}
    if not text:
        return df
    return df.select([F.col(c).try_cast("double").alias(c) if c in text else F.col(c) for c in df.columns])


def prepare_bars(df: DataFrame, universe: list[str] | None = None) -> DataFrame:
    require_columns(df, REQUIRED_BAR_COLUMNS)
    df = filter_universe(df, universe)
    df = numeric_text_to_double(df)
    df = coerce_date(df, "date")
    df = drop_missing_keys(df, ("date", "symbol"))
    return clean_prices(df)


def filter_universe(df: DataFrame, universe: list[str] | None) -> DataFrame:
    """Row 6: keep listed symbols; an empty/None list keeps all."""
    if not universe:
        return df
    return df.where(F.col("symbol").isin(list(universe)))


# ---------------------------------------------------------------------------
# Fixture adapters (not reference operators): derive bar tables from the
# supplied TPC-H-like tables.  Both aggregate with partial (map-side)
# aggregation, so a hot symbol is pre-reduced before the shuffle.
# ---------------------------------------------------------------------------

def bars_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol = o_orderpriority, date = day of o_orderdate, one bar per (symbol, day)."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    return (
        o.groupBy(F.col("o_orderpriority").alias("symbol"), F.to_date("o_orderdate").alias("date"))
        .agg(
            F.min_by("o_totalprice", "o_orderkey").alias("open"),
            F.max("o_totalprice").alias("high"),
            F.min("o_totalprice").alias("low"),
            F.max_by("o_totalprice", "o_orderkey").alias("close"),
            F.max_by("o_totalprice", "o_orderkey").alias("adj_close"),
            F.count(F.lit(1)).alias("volume"),
        )
        .select("symbol", "date", "open", "high", "low", "close", "adj_close", "volume")
    )


def bars_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol = l_suppkey (as text), date = day of l_shipdate, price = l_extendedprice."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    # one number orders the lines, so the aggregate needs no sort
    key = F.col("l_orderkey") * F.lit(1 << 16) + F.col("l_linenumber")
    return (
        li.groupBy(F.col("l_suppkey").cast("string").alias("symbol"), F.to_date("l_shipdate").alias("date"))
        .agg(
            F.min_by("l_extendedprice", key).alias("open"),
            F.max("l_extendedprice").alias("high"),
            F.min("l_extendedprice").alias("low"),
            F.max_by("l_extendedprice", key).alias("close"),
            F.max_by("l_extendedprice", key).alias("adj_close"),
            F.count(F.lit(1)).alias("volume"),
        )
        .select("symbol", "date", "open", "high", "low", "close", "adj_close", "volume")
    )


def bar_table(spark: SparkSession, sf_dir: str, source: str = "orders") -> DataFrame:
    if source == "orders":
        return bars_from_orders(spark, sf_dir)
    if source == "lineitem":
        return bars_from_lineitem(spark, sf_dir)
    raise ValueError(f"unknown bar source: {source}")

