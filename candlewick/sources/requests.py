"""Scoring requests: schema, JSON source, and a fixture derived from bars.

A request nests its own bar window, so it is one record; tables (batch) or
JSON file streams (``score_stream``) of requests are scored in parallel,
each record being a series of its own (``request_id`` is the sender's, and may
be absent or repeated).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAR_STRUCT = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("adj_close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
])

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("horizon", T.IntegerType()),
    T.StructField("as_of", T.StringType()),
    T.StructField("last_close", T.DoubleType()),
    T.StructField("last_returns", T.ArrayType(T.DoubleType())),
    T.StructField("ohlcv_window", T.ArrayType(BAR_STRUCT)),
])


#: What a record of a wrong type is rejected with, and the record as it came.
ERROR, RAW = "record_error", "raw_record"
_NUMBERS = [f.name for f in BAR_STRUCT.fields if f.name != "date"]


def parse_requests(lines: DataFrame, value: str = "value") -> DataFrame:
    """Requests from a column of JSON text, each field tested for its own type.

    Text is needed where text is meant; a number may be sent as text that
    reads as one; a horizon is whole and, if given, not null.  A record with
    a field of another type keeps the fields that are right, its first
    ``record_error`` and the text it came as (``raw_record``); both are null
    for the others.  Unknown fields are ignored.
    """
    df = lines.select(F.col(value).alias(RAW)).withColumn("_v", F.try_parse_json(RAW))

    def part(path: str, kind: str) -> Column:
        return F.try_variant_get("_v", path, kind)

    def kind_of(field: str) -> Column:
        """Type of a field, null if it was left out, VOID for a JSON null."""
        return F.schema_of_variant(part(f"$.{field}", "variant"))

    def given(field: str) -> Column:
        return F.coalesce(kind_of(field) != "VOID", F.lit(False))

    def is_a(field: str, kind: str) -> Column:
        return kind_of(field).startswith(kind)

    def number(x: Column) -> Column:
        return F.try_variant_get(x, "$", "double")

    lists = {c: F.when(is_a(c, "ARRAY"), part(f"$.{c}", "array<variant>")) for c in ("last_returns", "ohlcv_window")}
    horizon = part("$.horizon", "double")
    bar_date = lambda b: F.schema_of_variant(F.try_variant_get(b, "$.date", "variant"))
    bar = lambda b: F.struct(
        F.when(bar_date(b) == "STRING", F.try_variant_get(b, "$.date", "string")).alias("date"),
        *[F.try_variant_get(b, f"$.{c}", "double").alias(c) for c in _NUMBERS])
    wrong = [
        (F.col("_v").isNull() | ~F.schema_of_variant("_v").startswith("OBJECT"), "not a JSON record"),
        *[(given(c) & ~is_a(c, "STRING"), f"{c} must be text") for c in ("request_id", "symbol", "as_of")],
        (kind_of("horizon").isNotNull() & ~F.coalesce(given("horizon") & (horizon == F.floor(horizon)), F.lit(False)), "horizon must be a whole number"),
        (given("last_close") & part("$.last_close", "double").isNull(), "last_close must be a number"),
        *[(given(c) & ~is_a(c, "ARRAY"), f"{c} must be a list") for c in lists],
        (F.exists("_last_returns", lambda x: number(x).isNull()), "last_returns must be numbers"),
        (F.exists("_ohlcv_window", lambda b: ~F.coalesce(F.schema_of_variant(b).startswith("OBJECT"), F.lit(False))), "ohlcv_window must hold records"),
        (F.exists("_ohlcv_window", lambda b: ~F.coalesce(bar_date(b).isin("STRING", "VOID"), F.lit(True))), "the date of a bar must be text"),
    ]
    df = df.withColumns({f"_{c}": x for c, x in lists.items()})
    error = F.coalesce(*[F.when(cond, F.lit(text)) for cond, text in wrong])
    small = F.when(F.abs(horizon) < 2 ** 31, horizon.cast("int")).otherwise(F.lit(-1))      # out of the range either way
    return df.select(
        *[F.when(is_a(c, "STRING"), part(f"$.{c}", "string")).alias(c) for c in ("request_id", "symbol")],
        F.when(horizon.isNotNull(), small).alias("horizon"),
        F.when(is_a("as_of", "STRING"), part("$.as_of", "string")).alias("as_of"), part("$.last_close", "double").alias("last_close"),
        F.transform("_last_returns", number).alias("last_returns"), F.transform("_ohlcv_window", bar).alias("ohlcv_window"),
        error.alias(ERROR), F.when(error.isNotNull(), F.col(RAW)).alias(RAW))


def read_requests(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Requests from JSON, each field's type tested (:func:`parse_requests`):
    one request per line, or with ``multi_line`` one (pretty-printed) request
    or array of them per file."""
    lines = spark.read.text(path, wholetext=multi_line)
    return parse_requests(records_of(lines) if multi_line else lines.where(F.trim("value") != ""))


def records_of(files: DataFrame, value: str = "value") -> DataFrame:
    """One row of JSON text per record of files that hold one or an array."""
    whole = F.try_parse_json(value)
    many = F.transform(F.try_variant_get(whole, "$", "array<variant>"), lambda x: F.to_json(x))
    is_array = F.coalesce(F.schema_of_variant(whole).startswith("ARRAY"), F.lit(False))
    return files.select(F.explode(F.when(is_array, many).otherwise(F.array(value))).alias(value))


def requests_from_bars(bars: DataFrame) -> DataFrame:
    """Fixture adapter: one request per (symbol, calendar month).

    Odd months send the month's bars as ``ohlcv_window`` (window mode);
    even months send ``last_close`` + the month's daily log returns
    (minimal mode).  December asks for horizon 31, which validation
    rejects.  Groups are bounded by the days of one month.
    """
    month = F.date_format("date", "yyyy-MM")
    bar = F.struct(
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close", "adj_close", "volume")],
    )
    g = bars.groupBy(F.concat_ws(":", "symbol", month).alias("request_id"), "symbol").agg(
        F.max(F.month("date")).alias("_m"),
        F.max("date").alias("_last"),
        F.array_sort(F.collect_list(bar)).alias("_bars"),
    )
    prices = F.transform("_bars", lambda b: b["adj_close"])
    rets = F.when(
        F.size(prices) >= 2,
        F.transform(F.sequence(F.lit(1), F.size(prices) - 1), lambda i: F.ln(prices[i]) - F.ln(prices[i - 1])),
    ).otherwise(F.array().cast("array<double>"))
    minimal = F.col("_m") % 2 == 0
    return g.select(
        "request_id", "symbol",
        F.when(F.col("_m") == 12, 31).otherwise(1).cast("int").alias("horizon"),
        F.date_format("_last", "yyyy-MM-dd").alias("as_of"),
        F.when(minimal, F.element_at(prices, -1)).alias("last_close"),
        F.when(minimal, rets).alias("last_returns"),
        F.when(~minimal, F.col("_bars")).alias("ohlcv_window"),
    )


def write_requests_json(requests: DataFrame, path: str) -> None:
    requests.write.mode("overwrite").json(path)
