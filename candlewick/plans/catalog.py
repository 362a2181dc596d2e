"""Registered queries: every inventory row, each over the whole test tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame; the
matching DuckDB statement (when the operator is SQL-expressible) lives in
``ORACLES`` under the same key.  Doubles are put in the canonical comparison
form on both sides (``round(x, 9)`` then single precision, see
``functions.columns.canonical``); every computed column carries the same
alias and type on both sides, and every column is a scalar.
"""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.columns import round_doubles
from candlewick.operators import features as feat
from candlewick.plans import oracle_sql as o
from candlewick.sources import bars as src

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


#: Where the queries take their bars from; ``_on_lineitem`` runs some on the many symbols of lineitem.
_BARS: ContextVar[Query] = ContextVar("bars", default=src.bars_from_orders)


def orders_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _BARS.get()(spark, sf_dir)


# --------------------------------------------------------------------------
# 2.1 sources
# --------------------------------------------------------------------------

@register("load_bars", f"""
SELECT symbol, date, {o.r6(["open", "high", "low", "close", "adj_close"])}, CAST(volume AS DOUBLE) AS volume
FROM ({o.BARS_ORDERS}) b WHERE volume <> 2""")
def q_load_bars(spark, sf_dir):
    """Row 1 on files: text dates in two layouts, dates that don't parse, keyless rows, text volumes, an extra column."""
    bars = orders_bars(spark, sf_dir)
    text = F.when(F.col("volume") % 3 == 0, F.date_format("date", "MM/dd/yyyy")).otherwise(F.date_format("date", "yyyy-MM-dd"))
    bad = bars.where("volume = 2")
    files = (bars.where("volume <> 2").withColumn("date", text)
             .unionByName(bad.withColumn("date", F.lit("not a date")))
             .unionByName(bad.withColumn("date", text).withColumn("symbol", F.lit(None).cast("string")))
             .withColumn("volume", F.col("volume").cast("string")).withColumn("note", F.lit("x")))
    path = _scratch(spark, "bars")
    files.write.json(path)
    return round_doubles(src.load_bars(spark, path, fmt="json").withColumn("date", F.to_date("date")).drop("note"))


_STORE_DAYS = ("1996-06-01", "1998-02-28")


def _bar_store(spark, sf_dir, **kw) -> DataFrame:
    """Bars written to a store of their own and read from it."""
    from candlewick.sources.store import read_bar_store, write_bar_store

    path = _scratch(spark, "store")
    table = "bars_" + "".join(c for c in path.rsplit("/", 1)[-1] if c.isalnum())
    write_bar_store(orders_bars(spark, sf_dir), table, buckets=8, path=path)
    return read_bar_store(spark, table, **kw)


@register("bar_store", f"""
SELECT symbol, date, {o.r6(["open", "high", "low", "close", "adj_close"])}, volume
FROM ({o.BARS_ORDERS}) b WHERE date BETWEEN DATE '{_STORE_DAYS[0]}' AND DATE '{_STORE_DAYS[1]}'""")
def q_bar_store(spark, sf_dir):
    """Row 1 from the bucketed store: a date bound skips the years outside it."""
    import datetime as dt

    since, until = (dt.date.fromisoformat(d) for d in _STORE_DAYS)
    return round_doubles(_bar_store(spark, sf_dir, since=since, until=until))


def _scratch(spark, name: str) -> str:
    from candlewick.streaming.scoring_stream import scratch_dir

    return scratch_dir(spark, name)


# --------------------------------------------------------------------------
# 2.4 window features
# --------------------------------------------------------------------------

@register("log_returns", f"""
WITH {o.features_ctes()}
SELECT symbol, date, {o.r6(["log_return_1"])} FROM r""")
def q_log_returns(spark, sf_dir):
    df = feat.add_returns(orders_bars(spark, sf_dir))
    return round_doubles(df.select("symbol", "date", "log_return_1"))


@register("tabular_features", f"""
WITH {o.features_ctes()}
SELECT symbol, date, {o.r6(o.ALL_FEATURES)} FROM f""")
def q_tabular_features(spark, sf_dir):
    df = feat.tabular_features(orders_bars(spark, sf_dir))
    return round_doubles(df.select("symbol", "date", *o.ALL_FEATURES))


@register("tabular_features_from_store", f"""
WITH {o.features_ctes()}
SELECT symbol, date, {o.r6(o.ALL_FEATURES)} FROM f""")
def q_tabular_features_from_store(spark, sf_dir):
    """Rows 20-30 on the bucketed store, without an exchange."""
    df = feat.tabular_features(_bar_store(spark, sf_dir), segment=None)
    return round_doubles(df.select("symbol", "date", *o.ALL_FEATURES))


def _select(df: DataFrame, *cols: str) -> DataFrame:
    return round_doubles(df.select(*cols))


def _features(spark, sf_dir, horizon=None):
    return feat.tabular_features(orders_bars(spark, sf_dir), horizon=horizon)


def _feature_query(name: str, cols: list[str]):
    @register(name, f"""
WITH {o.features_ctes()}
SELECT symbol, date, {o.r6(cols)} FROM f""")
    def q(spark, sf_dir):
        return _select(_features(spark, sf_dir), "symbol", "date", *cols)
    q.__name__ = f"q_{name}"
    return q


_feature_query("return_lags", ["r_lag_1", "r_lag_2", "r_lag_5"])
_feature_query("return_rolling_mean", ["r_mean_3", "r_mean_5", "r_mean_10"])
_feature_query("return_rolling_std", ["r_std_3", "r_std_5", "r_std_10"])
_feature_query("return_rolling_min", ["r_min_3", "r_min_5", "r_min_10"])
_feature_query("return_rolling_max", ["r_max_3", "r_max_5", "r_max_10"])
_feature_query("volume_lag", ["vol_lag_1"])
_feature_query("volume_rolling", ["vol_mean_5", "vol_std_5", "vol_mean_10", "vol_std_10"])
_feature_query("price_lag", ["price_lag_1"])
_feature_query("price_rolling", ["price_mean_5", "price_std_5", "price_mean_10", "price_std_10"])


@register("candle_features", f"""
WITH {o.features_ctes()}
SELECT symbol, date, {o.r6(["hl_range", "oc_body", "hl_range_pct", "oc_body_pct"])} FROM f""")
def q_candle_features(spark, sf_dir):
    from candlewick.functions.columns import candle_columns

    bars = orders_bars(spark, sf_dir)
    return _select(bars.select("symbol", "date", *[e.alias(n) for n, e in candle_columns().items()]),
                   "symbol", "date", "hl_range", "oc_body", "hl_range_pct", "oc_body_pct")


@register("forward_target", f"""
WITH {o.features_ctes(horizon=1)}
SELECT symbol, date, {o.r6(["target"])} FROM f WHERE target IS NOT NULL""")
def q_forward_target(spark, sf_dir):
    r = feat.add_returns(orders_bars(spark, sf_dir))
    return _select(feat.forward_target(r, 1), "symbol", "date", "target")


@register("forward_target_h5", f"""
WITH {o.features_ctes(horizon=5)}
SELECT symbol, date, {o.r6(["log_return_1", "target"])} FROM f WHERE target IS NOT NULL""")
def q_forward_target_h5(spark, sf_dir):
    df = feat.tabular_features(orders_bars(spark, sf_dir), horizon=5, segment="month").dropna(subset=["target"])
    return _select(df, "symbol", "date", "log_return_1", "target")


# --------------------------------------------------------------------------
# 2.1-2.3 load path, filters, scalar functions
# --------------------------------------------------------------------------

_DATE_TEXT_SQL = ("CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y-%m-%d') || 'x' "
                  "ELSE strftime(o_orderdate, '%Y-%m-%d') END")


def _orders_with_text_dates(spark, sf_dir):
    o_ = spark.read.parquet(f"{sf_dir}/orders.parquet")
    txt = F.date_format("o_orderdate", "yyyy-MM-dd")
    return o_.select("o_orderkey", F.col("o_orderpriority").alias("symbol"),
                     F.when(F.col("o_orderstatus") == "P", F.concat(txt, F.lit("x"))).otherwise(txt).alias("date"))


@register("coerce_date", f"""
SELECT o_orderkey, CAST(TRY_CAST({_DATE_TEXT_SQL} AS TIMESTAMP) AS DATE) AS date FROM orders""")
def q_coerce_date(spark, sf_dir):
    df = src.coerce_date(_orders_with_text_dates(spark, sf_dir), "date")
    return df.select("o_orderkey", F.to_date("date").alias("date"))


@register("drop_missing_keys", f"""
SELECT o_orderkey, CAST(TRY_CAST({_DATE_TEXT_SQL} AS TIMESTAMP) AS DATE) AS date, o_orderpriority AS symbol
FROM orders WHERE TRY_CAST({_DATE_TEXT_SQL} AS TIMESTAMP) IS NOT NULL AND o_orderpriority IS NOT NULL""")
def q_drop_missing_keys(spark, sf_dir):
    df = src.drop_missing_keys(src.coerce_date(_orders_with_text_dates(spark, sf_dir), "date"), ("date", "symbol"))
    return df.select("o_orderkey", F.to_date("date").alias("date"), "symbol")


UNIVERSE = ["1-URGENT", "3-MEDIUM", "5-LOW"]


@register("filter_universe", f"""
SELECT symbol, date, {o.r6(["open", "high", "low", "close", "adj_close"])}, volume
FROM ({o.BARS_ORDERS}) b WHERE symbol IN ('1-URGENT', '3-MEDIUM', '5-LOW')""")
def q_filter_universe(spark, sf_dir):
    return round_doubles(src.filter_universe(orders_bars(spark, sf_dir), UNIVERSE))


@register("coerce_double", """
SELECT o_orderkey, TRY_CAST(o_custkey AS DOUBLE) AS o_custkey, TRY_CAST(o_orderstatus AS DOUBLE) AS o_orderstatus,
       CAST(CAST(round(TRY_CAST(o_totalprice AS DOUBLE), 9) AS FLOAT) AS DOUBLE) AS o_totalprice,
       TRY_CAST(CAST(o_orderkey AS VARCHAR) AS DOUBLE) AS key_text
FROM orders""")
def q_coerce_double(spark, sf_dir):
    from candlewick.functions.columns import coerce_double

    o_ = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderkey").cast("string").alias("key_text"))
    out = coerce_double(o_, ["o_custkey", "o_orderstatus", "o_totalprice", "key_text"])
    return round_doubles(out)


@register("inf_to_null", f"""
SELECT o_orderkey, {o.cn("CASE WHEN isinf(exp(o_totalprice / 500.0)) THEN NULL ELSE ln(exp(o_totalprice / 500.0)) END")} AS v
FROM orders""")
def q_inf_to_null(spark, sf_dir):
    from candlewick.functions.columns import inf_to_null

    o_ = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.exp(F.col("o_totalprice") / 500.0).alias("v"))
    out = inf_to_null(o_, ["v"]).select("o_orderkey", F.ln("v").alias("v"))
    return round_doubles(out)


_ZF = ["r_lag_5", "r_mean_10", "r_std_10", "vol_std_10", "price_std_10"]


@register("zero_fill", f"""
WITH {o.features_ctes()}
SELECT symbol, date, {", ".join(f"{o.cn(f'coalesce({c}, 0.0)')} AS {c}" for c in _ZF)} FROM f""")
def q_zero_fill(spark, sf_dir):
    from candlewick.functions.columns import zero_fill

    return _select(zero_fill(_features(spark, sf_dir), _ZF), "symbol", "date", *_ZF)


@register("align_features", f"""
WITH {o.features_ctes()}
SELECT symbol, date, {", ".join(f"{o.cn(c)} AS {c}" if c in o.BAR_VALUE_COLUMNS + ["log_return_1"] else f"CAST(0.0 AS DOUBLE) AS {c}" for c in o.ALL_FEATURES)}
FROM r""")
def q_align_features(spark, sf_dir):
    from candlewick.operators.guards import align_features

    r = feat.add_returns(orders_bars(spark, sf_dir)).withColumn("extra_column", F.lit(1.0))
    return round_doubles(align_features(r, o.ALL_FEATURES, keep=["symbol", "date"]))


@register("price_from_return", f"""
WITH {o.features_ctes()}
SELECT symbol, date, {o.cn("price_lag_1 * exp(log_return_1)")} AS pred_price FROM f""")
def q_price_from_return(spark, sf_dir):
    from candlewick.functions.columns import price_from_return

    f = _features(spark, sf_dir)
    return _select(f.select("symbol", "date", price_from_return("price_lag_1", "log_return_1").alias("pred_price")),
                   "symbol", "date", "pred_price")


@register("return_from_price", f"""
WITH {o.features_ctes()}
SELECT symbol, date,
       {o.cn("CASE WHEN adj_close IS NOT NULL AND price_lag_1 IS NOT NULL THEN ln(greatest(adj_close, 1e-12) / greatest(price_lag_1, 1e-12)) END")} AS pred_return
FROM f""")
def q_return_from_price(spark, sf_dir):
    from candlewick.functions.columns import return_from_price

    f = _features(spark, sf_dir)
    return _select(f.select("symbol", "date", return_from_price("adj_close", "price_lag_1").alias("pred_return")),
                   "symbol", "date", "pred_return")


# --------------------------------------------------------------------------
# Training rows, positions and splits
# --------------------------------------------------------------------------

def _training_rows(spark, sf_dir, by="position", inputs=None):
    from candlewick.operators.train import training_rows

    return training_rows(orders_bars(spark, sf_dir), horizon=1, by=by, inputs=inputs)


_T = o.training_rows_ctes()
_P = _T + ",\np AS (SELECT *, CAST(row_number() OVER (ORDER BY symbol, date) - 1 AS BIGINT) AS pos FROM t)"
_N = _P + ",\nnn AS (SELECT count(*) AS n, count(*) // 6 AS tsz FROM p)"


@register("drop_incomplete", f"""
WITH {_T}
SELECT symbol, date, {o.r6(["target", "r_std_10", "price_std_10"])} FROM t""")
def q_drop_incomplete(spark, sf_dir):
    from candlewick.operators.guards import drop_incomplete

    f = _features(spark, sf_dir, horizon=1)
    rows = drop_incomplete(f, feat.model_feature_names(f), "target")
    return _select(rows, "symbol", "date", "target", "r_std_10", "price_std_10")


@register("min_rows_guard", f"""
WITH {_T}
SELECT count(*) AS n_rows, 500 AS min_rows, count(*) >= 500 AS passed FROM t""")
def q_min_rows_guard(spark, sf_dir):
    from candlewick.operators.guards import MIN_TRAINING_ROWS, min_rows_guard

    rows = _training_rows(spark, sf_dir)
    min_rows_guard(rows.df, known_rows=rows.n)
    return rows.df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(MIN_TRAINING_ROWS).alias("min_rows"), (F.col("n_rows") >= MIN_TRAINING_ROWS).alias("passed"))


@register("global_position", f"""
WITH {_P}
SELECT symbol, date, pos FROM p""")
def q_global_position(spark, sf_dir):
    return _training_rows(spark, sf_dir).df.select("symbol", "date", "pos")


@register("walk_forward_folds", f"""
WITH {_N}
SELECT symbol, date, pos,
       CAST(CASE WHEN pos >= n - 5 * tsz THEN (pos - (n - 5 * tsz)) // tsz END AS INTEGER) AS fold
FROM p, nn""")
def q_walk_forward_folds(spark, sf_dir):
    from candlewick.operators.splits import walk_forward_folds

    rows = _training_rows(spark, sf_dir)
    df, _ = walk_forward_folds(rows.df, rows.n, 5)
    return df.select("symbol", "date", "pos", "fold")


@register("chronological_holdout", f"""
WITH {_N}
SELECT symbol, date, pos, pos < CAST(floor(n * 0.8) AS BIGINT) AS is_train FROM p, nn""")
def q_chronological_holdout(spark, sf_dir):
    from candlewick.operators.splits import chronological_holdout

    rows = _training_rows(spark, sf_dir)
    return chronological_holdout(rows.df, rows.n).select("symbol", "date", "pos", "is_train")


@register("date_folds", f"""
WITH {_T},
d AS (SELECT *, CAST(rank() OVER (ORDER BY date) - 1 AS BIGINT) AS dpos FROM t),
nn AS (SELECT count(*) AS n, count(*) // 6 AS tsz FROM t)
SELECT symbol, date, dpos,
       CAST(CASE WHEN dpos >= n - 5 * tsz THEN (dpos - (n - 5 * tsz)) // tsz END AS INTEGER) AS fold,
       dpos < CAST(floor(n * 0.8) AS BIGINT) AS is_train
FROM d, nn""")
def q_date_folds(spark, sf_dir):
    from candlewick.operators.splits import date_folds

    f = _features(spark, sf_dir, horizon=1)
    from candlewick.operators.guards import drop_incomplete

    rows = drop_incomplete(f, feat.model_feature_names(f), "target")
    df, _ = date_folds(rows, 5)
    return df.select("symbol", "date", "dpos", "fold", "is_train")


# --------------------------------------------------------------------------
# 2.6 aggregates (baseline predictor p = r_mean_5 on the walk-forward folds)
# --------------------------------------------------------------------------

_FOLDED = _N + """,
fp AS (SELECT *, CAST(CASE WHEN pos >= n - 5 * tsz THEN (pos - (n - 5 * tsz)) // tsz END AS INTEGER) AS fold FROM p, nn)"""


def _baseline_preds(spark, sf_dir):
    from candlewick.operators.splits import walk_forward_folds

    rows = _training_rows(spark, sf_dir)
    df, _ = walk_forward_folds(rows.df, rows.n, 5)
    return df.where(F.col("fold").isNotNull()).withColumn("prediction", F.col("r_mean_5"))


@register("mae", f"""
WITH {_FOLDED}
SELECT fold, {o.cn("avg(abs(target - r_mean_5))")} AS mae FROM fp WHERE fold IS NOT NULL GROUP BY fold""")
def q_mae(spark, sf_dir):
    from candlewick.operators.metrics import mae

    return round_doubles(mae(_baseline_preds(spark, sf_dir), by=["fold"]))


@register("directional_accuracy", f"""
WITH {_FOLDED}
SELECT fold, {o.cn("avg(CASE WHEN (target >= 0) = (r_mean_5 >= 0) THEN 1.0 ELSE 0.0 END)")} AS diracc
FROM fp WHERE fold IS NOT NULL GROUP BY fold""")
def q_directional_accuracy(spark, sf_dir):
    from candlewick.operators.metrics import directional_accuracy

    return round_doubles(directional_accuracy(_baseline_preds(spark, sf_dir), by=["fold"]))


@register("run_summary", f"""
WITH {_T}
SELECT count(*) AS rows, count(DISTINCT symbol) AS universe_size, CAST(36 AS BIGINT) AS num_features FROM t""")
def q_run_summary(spark, sf_dir):
    from candlewick.operators.metrics import run_summary

    rows = _training_rows(spark, sf_dir)
    return run_summary(rows.df, rows.feature_cols)


# One-feature ridge (x = log_return_1 -> next-day return): closed form in SQL.
_RIDGE_FOLDS = _FOLDED + """,
folds AS (SELECT CAST(i AS INTEGER) AS fold, n - (5 - i) * tsz AS start FROM nn, range(5) r(i)),
st AS (SELECT folds.fold, avg(p.log_return_1) AS mx, avg(p.target) AS my,
              covar_pop(p.log_return_1, p.target) * count(*) / (var_pop(p.log_return_1) * count(*) + 1.0) AS b
       FROM folds JOIN p ON p.pos < folds.start GROUP BY folds.fold),
pr AS (SELECT fp.fold, fp.target, st.my - st.b * st.mx + st.b * fp.log_return_1 AS prediction
       FROM fp JOIN st ON fp.fold = st.fold)"""


def _ridge1_cv(spark, sf_dir):
    from candlewick.operators.train import cross_validate

    rows = _training_rows(spark, sf_dir, inputs=["log_return_1"])
    metrics, _ = cross_validate(rows, "ridge", 5, 1.0)
    return metrics


@register("cross_validate", f"""
WITH {_RIDGE_FOLDS}
SELECT 'ridge' AS family, fold, {o.cn("avg(abs(target - prediction))")} AS mae,
       {o.cn("avg(CASE WHEN (target >= 0) = (prediction >= 0) THEN 1.0 ELSE 0.0 END)")} AS diracc,
       count(*) AS n
FROM pr GROUP BY fold""")
def q_cross_validate(spark, sf_dir):
    return round_doubles(_ridge1_cv(spark, sf_dir))


@register("cv_summary", f"""
WITH {_RIDGE_FOLDS},
fm AS (SELECT fold, avg(abs(target - prediction)) AS mae,
              avg(CASE WHEN (target >= 0) = (prediction >= 0) THEN 1.0 ELSE 0.0 END) AS diracc FROM pr GROUP BY fold)
SELECT 'ridge' AS family, {o.cn("avg(mae)")} AS mae_cv_mean, {o.cn("avg(diracc)")} AS diracc_cv_mean,
       count(*) AS folds FROM fm""")
def q_cv_summary(spark, sf_dir):
    from candlewick.operators.metrics import cv_summary

    return round_doubles(cv_summary(_ridge1_cv(spark, sf_dir)))


@register("metrics_table", f"""
WITH {_RIDGE_FOLDS},
fm AS (SELECT fold, avg(abs(target - prediction)) AS mae,
              avg(CASE WHEN (target >= 0) = (prediction >= 0) THEN 1.0 ELSE 0.0 END) AS diracc FROM pr GROUP BY fold),
lng AS (SELECT fold, 'mae_fold_' || fold AS metric, mae AS value FROM fm
        UNION ALL SELECT fold, 'diracc_fold_' || fold, diracc FROM fm
        UNION ALL SELECT NULL, 'mae_cv_mean', avg(mae) FROM fm
        UNION ALL SELECT NULL, 'diracc_cv_mean', avg(diracc) FROM fm)
SELECT 'ridge_one_feature' AS run, 'ridge' AS family, CAST(fold AS INTEGER) AS fold, metric, {o.cn("value")} AS value
FROM lng""")
def q_metrics_table(spark, sf_dir):
    from candlewick.operators.metrics import cv_summary, metrics_long

    fm = _ridge1_cv(spark, sf_dir)
    return round_doubles(metrics_long(fm, cv_summary(fm), "ridge_one_feature"))


_RIDGE_HOLDOUT = _N + """,
st AS (SELECT avg(log_return_1) AS mx, avg(target) AS my,
              covar_pop(log_return_1, target) * count(*) / (var_pop(log_return_1) * count(*) + 1.0) AS b
       FROM p, nn WHERE pos < CAST(floor(n * 0.8) AS BIGINT))"""


def _ridge1_holdout(spark, sf_dir):
    from candlewick.operators.models import ridge_fit
    from candlewick.operators.splits import chronological_holdout

    rows = _training_rows(spark, sf_dir)
    split = chronological_holdout(rows.df, rows.n)
    model = ridge_fit(split.where("is_train"), ["log_return_1"], 1.0)
    return model, split


@register("ridge_fit", f"""
WITH {_RIDGE_HOLDOUT}
SELECT {o.cn("b")} AS coefficient, {o.cn("my - b * mx")} AS intercept FROM st""")
def q_ridge_fit(spark, sf_dir):
    model, _ = _ridge1_holdout(spark, sf_dir)
    lr = model.model.stages[-1]
    return round_doubles(spark.createDataFrame(
        [(float(lr.coefficients[0]), float(lr.intercept))], "coefficient double, intercept double"))


@register("ridge_score", f"""
WITH {_RIDGE_HOLDOUT}
SELECT symbol, date, {o.cn("my - b * mx + b * log_return_1")} AS prediction
FROM p, nn, st WHERE pos >= CAST(floor(n * 0.8) AS BIGINT)""")
def q_ridge_score(spark, sf_dir):
    from candlewick.operators.models import ridge_score

    model, split = _ridge1_holdout(spark, sf_dir)
    return round_doubles(ridge_score(model, split.where("NOT is_train"), keep=["symbol", "date"]))


# --------------------------------------------------------------------------
# 2.2 / 2.3 / 2.8 request path
# --------------------------------------------------------------------------

def _requests(spark, sf_dir):
    from candlewick.sources.requests import requests_from_bars

    return requests_from_bars(orders_bars(spark, sf_dir))


_REQ = f"req AS ({o.REQUESTS})"


_VALIDATION_REASON = """nullif(concat_ws('; ',
               CASE WHEN symbol IS NULL THEN 'symbol is required' END,
               CASE WHEN horizon < 1 OR horizon > 30 THEN 'horizon must be between 1 and 30' END,
               CASE WHEN last_close IS NOT NULL AND NOT (last_close > 0) THEN 'last_close must be > 0' END,
               CASE WHEN last_returns IS NOT NULL AND (len(last_returns) < 5 OR len(last_returns) > 240)
                    THEN 'last_returns must hold 5 to 240 values' END,
               CASE WHEN len(list_filter(last_returns, lambda x: x IS NULL OR isnan(x))) > 0 THEN 'last_returns must be numbers' END,
               CASE WHEN ohlcv_window IS NOT NULL AND NOT list_bool_and(list_transform(ohlcv_window, lambda b:
                      coalesce(NOT isnan(b.open) AND NOT isnan(b.high) AND NOT isnan(b.low) AND NOT isnan(b.close)
                               AND NOT isnan(b.adj_close) AND NOT isnan(b.volume), false)))
                    THEN 'every ohlcv_window bar needs numeric open, high, low, close, adj_close and volume' END),
             '')"""


@register("validate_requests", f"""
WITH {_REQ},
v AS (SELECT request_id, {_VALIDATION_REASON} AS reject_reason FROM req)
SELECT request_id, reject_reason IS NULL AS accepted, reject_reason FROM v""")
def q_validate_requests(spark, sf_dir):
    from candlewick.operators.scoring import validate_requests

    return validate_requests(_requests(spark, sf_dir)).select("request_id", "accepted", "reject_reason")


_TYPE_ERRORS = {1: "symbol must be text", 2: "horizon must be a whole number", 3: "horizon must be a whole number", 4: "ohlcv_window must be a list",
                6: "last_returns must be numbers", 8: "horizon must be a whole number", 9: "as_of must be text", 10: "last_close must be a number",
                11: "not a JSON record", 12: "the date of a bar must be text"}


@register("validate_typed_requests", f"""
WITH {_REQ},
m AS (SELECT request_id, symbol, month(CAST(as_of AS DATE)) AS m FROM req),
e AS (SELECT *, CASE m {" ".join(f"WHEN {k} THEN '{v}'" for k, v in _TYPE_ERRORS.items())} END AS reject_reason FROM m)
SELECT CASE WHEN m <> 11 THEN request_id END AS request_id, CASE WHEN m NOT IN (1, 11) THEN symbol END AS symbol,
       CAST(CASE m WHEN 5 THEN 12.5 WHEN 7 THEN 3.0 END AS DOUBLE) AS last_close, reject_reason IS NULL AS accepted, reject_reason,
       reject_reason IS NOT NULL AS kept_raw FROM e""")
def q_validate_typed_requests(spark, sf_dir):
    """Row 9 on records as text, with a field of a wrong type in ten months of
    twelve, and numbers sent as text (which are right) in two."""
    from candlewick.operators.scoring import validate_requests
    from candlewick.sources.requests import parse_requests

    req = _requests(spark, sf_dir)
    ident = F.concat(F.lit('{"request_id":"'), "request_id", F.lit('",'))
    symbol = F.concat(F.lit('"symbol":"'), "symbol", F.lit('"'))
    rest = {1: '"symbol":5,"horizon":1', 2: '"horizon":"abc"', 3: '"horizon":1.5', 4: '"ohlcv_window":"none"', 5: '"last_close":"12.5"',
            6: '"last_returns":[0.1,0.1,"x",0.1,0.1]', 7: '"last_close":3,"last_returns":["0.1",0.1,0.1,0.1,1e-1]', 8: '"horizon":null',
            9: '"as_of":20240101', 10: '"last_close":{"a":1}', 12: '"ohlcv_window":[{"date":20240101,"open":1,"high":1,"low":1,"close":1,"adj_close":1,"volume":1}]'}
    text = F.lit('{"request_id":')
    for k, v in rest.items():
        line = F.concat(ident, F.lit(v + "}")) if k == 1 else F.concat(ident, symbol, F.lit(f",{v}}}"))
        text = F.when(F.month("as_of") == k, line).otherwise(text)
    out = validate_requests(parse_requests(req.select(text.alias("value"))))
    return out.select("request_id", "symbol", "last_close", "accepted", "reject_reason", F.col("raw_record").isNotNull().alias("kept_raw"))


@register("min_window_guard", f"""
WITH {_REQ}
SELECT request_id, CAST(len(ohlcv_window) AS INTEGER) AS n_bars,
       ohlcv_window IS NULL OR len(ohlcv_window) >= 11 AS window_ok FROM req""")
def q_min_window_guard(spark, sf_dir):
    from candlewick.operators.scoring import min_window_guard

    return min_window_guard(_requests(spark, sf_dir)).select("request_id", "n_bars", "window_ok")


@register("route_mode", f"""
WITH {_REQ}
SELECT request_id,
       CASE WHEN ohlcv_window IS NOT NULL THEN 'window'
            WHEN last_close IS NOT NULL AND last_returns IS NOT NULL THEN 'minimal' ELSE 'rejected' END AS route,
       CASE WHEN ohlcv_window IS NOT NULL AND len(ohlcv_window) < 11
              THEN 'ohlcv_window must contain at least 11 rows (needed for rolling features).'
            WHEN ohlcv_window IS NOT NULL THEN NULL
            WHEN last_close IS NULL OR last_returns IS NULL THEN 'Provide last_close + last_returns.' END AS route_reason
FROM req""")
def q_route_mode(spark, sf_dir):
    from candlewick.operators.scoring import route_mode

    return route_mode(_requests(spark, sf_dir), allow_minimal=True).select("request_id", "route", "route_reason")


@register("explode_window", f"""
WITH {_REQ},
x AS (SELECT request_id, symbol, CAST(i - 1 AS INTEGER) AS bar_index, ohlcv_window[i] AS bar
      FROM req, range(1, len(ohlcv_window) + 1) r(i) WHERE ohlcv_window IS NOT NULL)
SELECT request_id, symbol, bar_index, CAST(TRY_CAST(bar.date AS TIMESTAMP) AS DATE) AS date,
       {", ".join(f"{o.cn(f'bar.{c}')} AS {c}" for c in ("open", "high", "low", "close", "adj_close", "volume"))}
FROM x""")
def q_explode_window(spark, sf_dir):
    from candlewick.operators.scoring import explode_window

    df = explode_window(_requests(spark, sf_dir))
    return round_doubles(df.withColumn("date", F.to_date("date")))


_MINIMAL_STATS = f"""
WITH {_REQ},
m AS (SELECT request_id, symbol, last_close, last_returns AS r,
             list_slice(last_returns, greatest(len(last_returns) - 4, 1), len(last_returns)) AS s5,
             list_slice(last_returns, greatest(len(last_returns) - 9, 1), len(last_returns)) AS s10
      FROM req WHERE last_returns IS NOT NULL AND len(last_returns) > 0)
SELECT request_id, symbol,
       {o.cn("list_avg(s5)")} AS r_mean_5,
       {o.cn("CASE WHEN len(s5) > 1 THEN list_stddev_samp(s5) ELSE 0.0 END")} AS r_std_5,
       {o.cn("list_avg(s10)")} AS r_mean_10,
       {o.cn("CASE WHEN len(s10) > 1 THEN list_stddev_samp(s10) ELSE 0.0 END")} AS r_std_10,
       {o.cn("r[len(r)]")} AS r_last, {o.cn("last_close")} AS last_close
FROM m"""


@register("minimal_return_stats", _MINIMAL_STATS)
def q_minimal_return_stats(spark, sf_dir):
    from candlewick.operators.scoring import minimal_return_stats

    req = _requests(spark, sf_dir).where(F.col("last_returns").isNotNull() & (F.size("last_returns") > 0))
    return round_doubles(minimal_return_stats(req))


def _request_feature_ctes_text() -> str:
    """CTEs qx -> qbars -> qr -> qf -> qc over a CTE named ``req``."""
    part = "PARTITION BY request_id ORDER BY date, bar_index"
    feats = ",\n       ".join(f"{e} AS {n}" for n, e in o.feature_exprs(part=part))
    cond = " AND ".join(f"{c} IS NOT NULL" for c in o.ALL_FEATURES)
    return f"""qx AS (SELECT request_id, symbol, CAST(i - 1 AS INTEGER) AS bar_index, ohlcv_window[i] AS bar
      FROM req, range(1, len(ohlcv_window) + 1) r(i) WHERE ohlcv_window IS NOT NULL),
qbars AS (SELECT request_id, symbol, bar_index, CAST(TRY_CAST(bar.date AS TIMESTAMP) AS DATE) AS date,
                bar.open AS open, bar.high AS high, bar.low AS low, bar.close AS close,
                bar.adj_close AS adj_close, bar.volume AS volume
         FROM qx WHERE bar.adj_close IS NOT NULL AND TRY_CAST(bar.date AS TIMESTAMP) IS NOT NULL),
qr AS ({o.returns_cte(src="qbars", part=part)}),
qf AS (SELECT *, {feats} FROM qr),
qc AS (SELECT * FROM qf WHERE {cond})"""


@register("features_for_requests", f"""
WITH {_REQ},
{_request_feature_ctes_text()}
SELECT request_id, date, {o.r6(o.ALL_FEATURES)} FROM qc""")
def q_features_for_requests(spark, sf_dir):
    from candlewick.operators.scoring import features_for_requests

    df = features_for_requests(_requests(spark, sf_dir))
    return _select(df.withColumn("date", F.to_date("date")), "request_id", "date", *o.ALL_FEATURES)


@register("tail_rows", f"""
SELECT symbol, date, CAST(rn AS INTEGER) AS rn
FROM (SELECT symbol, date, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rn FROM ({o.BARS_ORDERS}) b)
WHERE rn <= 11""")
def q_tail_rows(spark, sf_dir):
    from candlewick.operators.scoring import tail_rows

    return tail_rows(orders_bars(spark, sf_dir), 11).select("symbol", "date", "rn")


def _full_ridge(spark, sf_dir):
    """36-feature ridge on the 80 % holdout of the orders bars."""
    from candlewick.operators.models import ridge_fit
    from candlewick.operators.splits import chronological_holdout

    rows = _training_rows(spark, sf_dir)
    split = chronological_holdout(rows.df, rows.n)
    return ridge_fit(split.where("is_train"), rows.feature_cols, 1.0)


@register("score_windows_full")
def q_score_windows_full(spark, sf_dir):
    from candlewick.operators.scoring import score_windows

    res = score_windows(_requests(spark, sf_dir), _full_ridge(spark, sf_dir), model_uri="ridge:holdout")
    return round_doubles(res.scored)


@register("score_windows_rejected", f"""
WITH req AS ({o.REQUESTS}),
{_request_feature_ctes_text()},
rr AS (SELECT request_id, symbol,
              coalesce({_VALIDATION_REASON},
                       CASE WHEN ohlcv_window IS NOT NULL AND len(ohlcv_window) < 11
                              THEN 'ohlcv_window must contain at least 11 rows (needed for rolling features).'
                            WHEN ohlcv_window IS NOT NULL THEN NULL
                            ELSE 'This deployed model requires ohlcv_window with adj_close. Minimal mode is disabled.'
                       END) AS reason
       FROM req)
SELECT request_id, symbol, reason FROM rr WHERE reason IS NOT NULL
UNION ALL
SELECT request_id, symbol,
       'After feature engineering, no usable rows remain. Provide a longer ohlcv_window.' AS reason
FROM rr WHERE reason IS NULL AND request_id NOT IN (SELECT request_id FROM qc)""")
def q_score_windows_rejected(spark, sf_dir):
    from candlewick.operators.scoring import score_windows

    return score_windows(_requests(spark, sf_dir), _full_ridge(spark, sf_dir)).rejected


@register("score_minimal_full")
def q_score_minimal_full(spark, sf_dir):
    from candlewick.operators.scoring import score_minimal

    return round_doubles(score_minimal(_requests(spark, sf_dir), _full_ridge(spark, sf_dir)).scored)


@register("score_latest_bars_full")
def q_score_latest_bars_full(spark, sf_dir):
    from candlewick.operators.scoring import score_latest_bars

    return round_doubles(score_latest_bars(orders_bars(spark, sf_dir), _full_ridge(spark, sf_dir)))


# --------------------------------------------------------------------------
# 2.4 / 2.6 / 2.7 sequence windows, price context, sample quantiles
# --------------------------------------------------------------------------

@register("sequence_windows", f"""
WITH {_T},
s AS (SELECT symbol, date, target,
             list(log_return_1) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS seq
      FROM t)
SELECT symbol, date, {o.cn("target")} AS target, CAST(k - 1 AS INTEGER) AS k, {o.cn("seq[k]")} AS value
FROM s, range(1, 31) r(k) WHERE len(seq) = 30""")
def q_sequence_windows(spark, sf_dir):
    """Row 33, one row per window element (k = 0 is the oldest of the 30)."""
    from candlewick.operators.models import sequence_windows

    rows = _training_rows(spark, sf_dir)
    sw = sequence_windows(rows.df, ["log_return_1"], 30)
    return round_doubles(sw.select("symbol", "date", "target", F.posexplode("seq").alias("k", "value")))


_VALID = f"""bars AS ({o.BARS_ORDERS}),
v AS (SELECT symbol, date, adj_close AS p FROM bars WHERE adj_close IS NOT NULL AND NOT isnan(adj_close) AND NOT isinf(adj_close)),
cnt AS (SELECT symbol, count(*) AS n_context FROM v GROUP BY symbol),
tl AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS r FROM v)"""


@register("price_context", f"""
WITH {_VALID}
SELECT symbol, date, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS k, {o.cn("p")} AS price, n_context,
       n_context >= 64 AS accepted FROM v JOIN cnt USING (symbol)""")
def q_price_context(spark, sf_dir):
    """Row 35, one row per valid price (k = 0 is the oldest)."""
    from candlewick.operators.models import price_context

    return round_doubles(price_context(orders_bars(spark, sf_dir), min_context=64))


def _paths_sql(h: int) -> str:
    steps = ", ".join([f"lag(ln(p), {h - s}) OVER (PARTITION BY symbol ORDER BY date)" for s in range(1, h)] + ["ln(p)"])
    return f"""{_VALID},
pw AS (SELECT symbol, r, p, first_value(p) OVER (PARTITION BY symbol ORDER BY date DESC) AS last_price,
              lag(ln(p), {h}) OVER (PARTITION BY symbol ORDER BY date) AS base, [{steps}] AS steps FROM tl),
s AS (SELECT symbol, r - 1 AS sample_id, step, last_price, last_price * exp(steps[step] - base) AS price
      FROM pw, range(1, {h + 1}) z(step) WHERE base IS NOT NULL),
q AS (SELECT symbol, step, quantile_cont(price, 0.5) AS qv FROM s GROUP BY symbol, step),
qq AS (SELECT symbol, arg_max(qv, step) AS q_value, CAST(max(step) AS INTEGER) AS last_step FROM q GROUP BY symbol),
lp AS (SELECT symbol, arg_max(p, date) AS last_price FROM v GROUP BY symbol)"""


@register("sample_quantile", f"""
WITH {_paths_sql(2)}
SELECT symbol, {o.cn("q_value")} AS q_value, last_step FROM qq""")
def q_sample_quantile(spark, sf_dir):
    from candlewick.operators.metrics import sample_quantile
    from candlewick.operators.models import sample_paths

    paths = sample_paths(orders_bars(spark, sf_dir), horizon=2)
    return round_doubles(sample_quantile(paths, 0.5, ["symbol"], "step", "price"))


@register("sample_quantile_negative", f"""
WITH bars AS ({o.BARS_ORDERS}),
v AS (SELECT symbol, -1000 * adj_close + 1e8 * (CASE WHEN day(date) = 1 THEN 1 ELSE 0 END) AS x FROM bars)
SELECT symbol, {o.cn("quantile_cont(x, 0.3)")} AS q_value, 1 AS last_step FROM v GROUP BY symbol""")
def q_sample_quantile_negative(spark, sf_dir):
    """Row 43 on values of both signs, most of them far below zero."""
    from candlewick.operators.metrics import sample_quantile

    high = F.when(F.dayofmonth("date") == 1, F.lit(1e8)).otherwise(F.lit(0.0))
    values = orders_bars(spark, sf_dir).select("symbol", F.lit(1).alias("step"), (F.lit(-1000) * F.col("adj_close") + high).alias("value"))
    return round_doubles(sample_quantile(values, 0.3))


@register("quantile_forecast", f"""
WITH {_paths_sql(1)}
SELECT cnt.symbol, cnt.n_context, cnt.n_context >= 64 AS accepted, {o.cn("lp.last_price")} AS last_price,
       {o.cn("CASE WHEN cnt.n_context >= 64 THEN qq.q_value END")} AS pred_price,
       {o.cn("CASE WHEN cnt.n_context >= 64 THEN ln(greatest(qq.q_value, 1e-12) / greatest(lp.last_price, 1e-12)) END")} AS pred_return
FROM cnt LEFT JOIN qq ON cnt.symbol = qq.symbol LEFT JOIN lp ON cnt.symbol = lp.symbol""")
def q_quantile_forecast(spark, sf_dir):
    from candlewick.operators.models import quantile_forecast

    return round_doubles(quantile_forecast(orders_bars(spark, sf_dir), horizon=1, quantile=0.5, min_context=64))


# --------------------------------------------------------------------------
# 2.7 model jobs with no SQL oracle (rows-only check)
# --------------------------------------------------------------------------

@register("select_model_full")
def q_select_model_full(spark, sf_dir):
    from candlewick.operators.models import select_model
    from candlewick.operators.splits import chronological_holdout

    rows = _training_rows(spark, sf_dir)
    split = chronological_holdout(rows.df, rows.n)
    res = select_model(split.where("is_train"), split.where("NOT is_train"), rows.feature_cols)
    best = res.best.params.get("estimator")
    out = [(t["estimator"], float(t["val_mae"]), t["estimator"] == best and float(t["val_mae"]) == res.best.params["val_mae"])
           for t in res.trials]
    return round_doubles(spark.createDataFrame(out, "estimator string, val_mae double, best boolean"))


@register("sequence_regressor_full")
def q_sequence_regressor_full(spark, sf_dir):
    from candlewick.operators.metrics import fold_metrics
    from candlewick.operators.models import sequence_model, sequence_predict
    from candlewick.operators.splits import chronological_holdout

    rows = _training_rows(spark, sf_dir)
    split = chronological_holdout(rows.df, rows.n)
    model, _ = sequence_model(split.where("is_train"), rows.feature_cols, seq_len=30)
    val_keys = split.where("NOT is_train").select("symbol", "date")
    preds = sequence_predict(model, rows.df, rows.feature_cols, 30).join(val_keys, ["symbol", "date"])
    m = fold_metrics(preds.withColumn("family", F.lit("custom_transformer")).withColumn("fold", F.lit(None).cast("int")),
                     by=("family",))
    return round_doubles(m.withColumn("iterations", F.lit(model.params["iterations"])))


@register("compare_families_full")
def q_compare_families_full(spark, sf_dir):
    from candlewick.operators.models import ridge_fit, select_model
    from candlewick.operators.scoring import compare_families
    from candlewick.operators.splits import chronological_holdout

    rows = _training_rows(spark, sf_dir)
    split = chronological_holdout(rows.df, rows.n)
    tr, va = split.where("is_train"), split.where("NOT is_train")
    models = {"ridge": ridge_fit(tr, rows.feature_cols),
              "ridge_one_feature": ridge_fit(tr, ["log_return_1"]),
              "automl": select_model(tr, va, rows.feature_cols).best}
    _, metrics = compare_families(va, models)
    return round_doubles(metrics)


@register("write_model_full")
def q_write_model_full(spark, sf_dir):
    from candlewick.operators.models import read_model, write_model
    from candlewick.streaming.scoring_stream import scratch_dir

    model = _full_ridge(spark, sf_dir)
    path = scratch_dir(spark, "model")
    write_model(model, path)
    again = read_model(path)
    rows = _training_rows(spark, sf_dir)
    a = model.transform(rows.df, keep=["symbol", "date"])
    b = again.transform(rows.df, keep=["symbol", "date"]).withColumnRenamed("prediction", "reloaded")
    return round_doubles(a.join(b, ["symbol", "date"]).withColumn(
        "same", F.col("prediction") == F.col("reloaded")).withColumn(
        "same_features", F.lit(again.feature_cols == model.feature_cols)))




@register("train_pipeline_full")
def q_train_pipeline_full(spark, sf_dir):
    from candlewick.operators.train import train_pipeline

    res = train_pipeline(orders_bars(spark, sf_dir), family="ridge", horizon=1, n_splits=5, run="ridge_full")
    return round_doubles(res.metrics)


@register("score_stream_full")
def q_score_stream_full(spark, sf_dir):
    from candlewick.sources.requests import write_requests_json
    from candlewick.streaming.scoring_stream import score_stream, scratch_dir

    base = scratch_dir(spark, "stream")
    write_requests_json(_requests(spark, sf_dir).repartition(4, "request_id"), f"{base}/in")
    scored, rejected = score_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", _full_ridge(spark, sf_dir),
                                    allow_minimal=True, max_files_per_trigger=2)
    return round_doubles(scored.unionByName(
        rejected.select("request_id", "symbol", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("pred_return", "double"), ("pred_price", "double"), ("model_uri", "string"),
            ("loaded_at_unix", "double"))], F.concat(F.lit("rejected: "), F.col("reason")).alias("used_mode"))))


# --------------------------------------------------------------------------
# Flagship: orders -> bars -> complete training rows (36 features + target)
# --------------------------------------------------------------------------

@register("training_rows", f"""
WITH {_T}
SELECT symbol, date, {o.r6(o.ALL_FEATURES + ["target"])} FROM t""")
def flagship(spark, sf_dir):
    from candlewick.operators.guards import drop_incomplete

    f = feat.tabular_features(orders_bars(spark, sf_dir), horizon=1)
    rows = drop_incomplete(f, feat.model_feature_names(f), "target")
    return _select(rows, "symbol", "date", *o.ALL_FEATURES, "target")


@register("tabular_features_by_week", f"""
WITH {o.features_ctes(horizon=2)}
SELECT symbol, date, {o.r6(o.ALL_FEATURES + ["target"])} FROM f""")
def q_tabular_features_by_week(spark, sf_dir):
    """Row 30 with explicit weekly segments (exercises the multi-hop halo)."""
    df = feat.tabular_features(orders_bars(spark, sf_dir), horizon=2, segment="week")
    return _select(df, "symbol", "date", *o.ALL_FEATURES, "target")


@register("training_rows_by_month", f"""
WITH {_P}
SELECT symbol, date, pos, {o.r6(["target", "r_std_10"])} FROM p""")
def q_training_rows_by_month(spark, sf_dir):
    """Rows 30-32 on monthly segments: features, complete rows and positions."""
    from candlewick.operators.train import training_rows

    rows = training_rows(orders_bars(spark, sf_dir), horizon=1, segment="month")
    return _select(rows.df, "symbol", "date", "pos", "target", "r_std_10")


# --------------------------------------------------------------------------
# Scoring with a one-feature ridge (closed form in SQL) so rows 4 and 53-56
# get value oracles; the 36-feature runs are the ``*_full`` keys, rows-only.
# --------------------------------------------------------------------------

def _holdout_ridge_ctes(x: str, name: str) -> str:
    return f"""{name} AS (SELECT avg({x}) AS mx, avg(target) AS my,
              covar_pop({x}, target) * count(*) / (var_pop({x}) * count(*) + 1.0) AS b
       FROM p, nn WHERE pos < CAST(floor(n * 0.8) AS BIGINT))"""


_ONE_FEATURE_BASE = _N + ",\n" + _holdout_ridge_ctes("log_return_1", "st") + ",\n" + \
    _holdout_ridge_ctes("r_mean_5", "st5") + f",\nreq AS ({o.REQUESTS}),\n" + _request_feature_ctes_text()

_WINDOW_SCORED_SQL = f"""
ok AS (SELECT * FROM req WHERE symbol IS NOT NULL AND coalesce(horizon, 1) BETWEEN 1 AND 30 AND ohlcv_window IS NOT NULL
              AND len(ohlcv_window) >= 11),
ql AS (SELECT request_id, symbol, log_return_1,
              row_number() OVER (PARTITION BY request_id ORDER BY date DESC, bar_index DESC) AS rn FROM qc),
ws AS (SELECT ql.request_id, ql.symbol, st.my - st.b * st.mx + st.b * ql.log_return_1 AS pred,
              ok.ohlcv_window[len(ok.ohlcv_window)].adj_close AS last_price
       FROM ql JOIN ok ON ql.request_id = ok.request_id, st WHERE rn = 1)"""

_MINIMAL_SCORED_SQL = """
mk AS (SELECT request_id, symbol, last_close,
              list_slice(last_returns, greatest(len(last_returns) - 4, 1), len(last_returns)) AS s5
       FROM req WHERE ohlcv_window IS NULL AND symbol IS NOT NULL AND coalesce(horizon, 1) BETWEEN 1 AND 30
             AND last_close IS NOT NULL AND last_close > 0
             AND last_returns IS NOT NULL AND len(last_returns) BETWEEN 5 AND 240)"""


def _one_feature_models(spark, sf_dir):
    from candlewick.operators.models import ridge_fit
    from candlewick.operators.splits import chronological_holdout

    rows = _training_rows(spark, sf_dir)
    tr = chronological_holdout(rows.df, rows.n).where("is_train")
    return ridge_fit(tr, ["log_return_1"], 1.0), ridge_fit(tr, ["r_mean_5"], 1.0)


_SCORED_COLS = f"""{o.cn("pred")} AS pred_return, {o.cn("last_price * exp(pred)")} AS pred_price"""


@register("score_windows", f"""
WITH {_ONE_FEATURE_BASE},{_WINDOW_SCORED_SQL}
SELECT request_id, symbol, {_SCORED_COLS}, 'ridge:log_return_1' AS model_uri, CAST(0.0 AS DOUBLE) AS loaded_at_unix,
       'tabular_from_window_adj_close' AS used_mode FROM ws""")
def q_score_windows(spark, sf_dir):
    from candlewick.operators.scoring import score_windows

    m1, _ = _one_feature_models(spark, sf_dir)
    return round_doubles(score_windows(_requests(spark, sf_dir), m1, model_uri="ridge:log_return_1").scored)


@register("score_minimal", f"""
WITH {_ONE_FEATURE_BASE},{_MINIMAL_SCORED_SQL},
ms AS (SELECT request_id, symbol, st5.my - st5.b * st5.mx + st5.b * list_avg(s5) AS pred, last_close AS last_price
       FROM mk, st5)
SELECT request_id, symbol, {_SCORED_COLS}, 'ridge:r_mean_5' AS model_uri, CAST(0.0 AS DOUBLE) AS loaded_at_unix,
       'tabular_minimal' AS used_mode FROM ms""")
def q_score_minimal(spark, sf_dir):
    from candlewick.operators.scoring import score_minimal

    _, m5 = _one_feature_models(spark, sf_dir)
    return round_doubles(score_minimal(_requests(spark, sf_dir), m5, model_uri="ridge:r_mean_5").scored)


@register("score_latest_bars", f"""
WITH {_ONE_FEATURE_BASE},
fc AS (SELECT symbol, date, adj_close, log_return_1,
              row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rn
       FROM f WHERE {" AND ".join(f"{c} IS NOT NULL" for c in o.ALL_FEATURES)}),
ls AS (SELECT symbol, date, st.my - st.b * st.mx + st.b * log_return_1 AS pred, adj_close AS last_price
       FROM fc, st WHERE rn = 1)
SELECT symbol, date, {_SCORED_COLS} FROM ls""")
def q_score_latest_bars(spark, sf_dir):
    from candlewick.operators.scoring import score_latest_bars

    m1, _ = _one_feature_models(spark, sf_dir)
    return round_doubles(score_latest_bars(orders_bars(spark, sf_dir), m1))


@register("read_model", f"""
WITH {_ONE_FEATURE_BASE}
SELECT symbol, date, {o.cn("st.my - st.b * st.mx + st.b * log_return_1")} AS prediction
FROM p, nn, st WHERE pos >= CAST(floor(n * 0.8) AS BIGINT)""")
def q_read_model(spark, sf_dir):
    """Row 4: write the model, read it back, score the holdout rows with the copy."""
    from candlewick.operators.models import read_model, ridge_score, write_model
    from candlewick.operators.splits import chronological_holdout
    from candlewick.streaming.scoring_stream import scratch_dir

    m1, _ = _one_feature_models(spark, sf_dir)
    path = scratch_dir(spark, "model-1f")
    write_model(m1, path)
    again = read_model(path)
    rows = _training_rows(spark, sf_dir)
    va = chronological_holdout(rows.df, rows.n).where("NOT is_train")
    return round_doubles(ridge_score(again, va, keep=["symbol", "date"]))


@register("write_model", f"""
WITH {_ONE_FEATURE_BASE}
SELECT symbol, date, {o.cn("st5.my - st5.b * st5.mx + st5.b * r_mean_5")} AS prediction, true AS same_features, 'ridge' AS family
FROM p, st5""")
def q_write_model(spark, sf_dir):
    """Row 4: a written model holds its family, features and coefficients."""
    from candlewick.operators.models import read_model, write_model

    _, m5 = _one_feature_models(spark, sf_dir)
    path = _scratch(spark, "model-w")
    write_model(m5, path)
    again = read_model(path)
    out = again.transform(_training_rows(spark, sf_dir).df, keep=["symbol", "date"])
    return round_doubles(out.select("*", F.lit(again.feature_cols == m5.feature_cols).alias("same_features"), F.lit(again.family).alias("family")))


@register("score_stream", f"""
WITH {_ONE_FEATURE_BASE},{_WINDOW_SCORED_SQL},{_MINIMAL_SCORED_SQL},
ms AS (SELECT request_id, symbol, st.my - st.b * st.mx AS pred, last_close AS last_price FROM mk, st)
SELECT request_id, symbol, {_SCORED_COLS}, 'tabular_from_window_adj_close' AS used_mode FROM ws
UNION ALL
SELECT request_id, symbol, {_SCORED_COLS}, 'tabular_minimal' AS used_mode FROM ms""")
def q_score_stream(spark, sf_dir):
    """Row 56 with a one-feature model: JSON request files -> micro-batches ->
    scored rows (minimal mode has no log return, so it predicts the intercept)."""
    from candlewick.sources.requests import write_requests_json
    from candlewick.streaming.scoring_stream import score_stream, scratch_dir

    m1, _ = _one_feature_models(spark, sf_dir)
    base = scratch_dir(spark, "stream-1f")
    write_requests_json(_requests(spark, sf_dir).repartition(4, "request_id"), f"{base}/in")
    scored, _ = score_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", m1, allow_minimal=True,
                             max_files_per_trigger=2)
    return round_doubles(scored.select("request_id", "symbol", "pred_return", "pred_price", "used_mode"))


@register("quantile_forecast_rows", f"""
WITH bars AS ({o.BARS_ORDERS}),
v AS (SELECT symbol, date, adj_close AS p FROM bars WHERE adj_close IS NOT NULL AND NOT isnan(adj_close) AND NOT isinf(adj_close)),
rh AS (SELECT symbol, date, p, ln(p) - lag(ln(p), 1) OVER (PARTITION BY symbol ORDER BY date) AS r FROM v),
w AS (SELECT symbol, date, p,
             count(*) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 63 PRECEDING AND CURRENT ROW) AS nc,
             quantile_cont(exp(r), 0.5) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS qe
      FROM rh)
SELECT symbol, date, {o.cn("p")} AS last_price, nc = 64 AS accepted,
       {o.cn("CASE WHEN nc = 64 THEN p * qe END")} AS pred_price,
       {o.cn("CASE WHEN nc = 64 THEN ln(greatest(p * qe, 1e-12) / greatest(p, 1e-12)) END")} AS pred_return
FROM w""")
def q_quantile_forecast_rows(spark, sf_dir):
    """Row 49 per row (quirk Q8): the forecast a request ending at each bar would get."""
    from candlewick.operators.models import quantile_forecast_rows

    return round_doubles(quantile_forecast_rows(orders_bars(spark, sf_dir), horizon=1, quantile=0.5, min_context=64))


@register("running_forecast_rows", f"""
WITH bars AS ({o.BARS_ORDERS}),
v AS (SELECT symbol, date, adj_close AS p FROM bars WHERE adj_close IS NOT NULL AND NOT isnan(adj_close) AND NOT isinf(adj_close)),
rh AS (SELECT symbol, date, p, ln(p) - lag(ln(p), 5) OVER (PARTITION BY symbol ORDER BY date) AS r FROM v),
w AS (SELECT symbol, date, p,
             count(*) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 63 PRECEDING AND CURRENT ROW) AS nc,
             quantile_cont(exp(r), 0.3) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS qe
      FROM rh)
SELECT symbol, date, {o.cn("p")} AS last_price, nc = 64 AS accepted,
       {o.cn("CASE WHEN nc = 64 THEN p * qe END")} AS pred_price,
       {o.cn("CASE WHEN nc = 64 THEN ln(greatest(p * qe, 1e-12) / greatest(p, 1e-12)) END")} AS pred_return
FROM w""")
def q_running_forecast_rows(spark, sf_dir):
    """Row 49 per row over whole histories of any length, five steps ahead: blocks and rank slices in place of a growing window."""
    from candlewick.operators.running import running_forecast_rows

    return round_doubles(running_forecast_rows(orders_bars(spark, sf_dir), horizon=5, quantile=0.3, min_context=64, block_rows=256))


@register("compare_families", f"""
WITH {_ONE_FEATURE_BASE},
va AS (SELECT * FROM p, nn WHERE pos >= CAST(floor(n * 0.8) AS BIGINT)),
pr AS (SELECT 'ridge_log_return_1' AS family, target, st.my - st.b * st.mx + st.b * log_return_1 AS prediction FROM va, st
       UNION ALL
       SELECT 'ridge_r_mean_5', target, st5.my - st5.b * st5.mx + st5.b * r_mean_5 FROM va, st5)
SELECT family, {o.cn("avg(abs(target - prediction))")} AS mae,
       {o.cn("avg(CASE WHEN (target >= 0) = (prediction >= 0) THEN 1.0 ELSE 0.0 END)")} AS diracc, count(*) AS n
FROM pr GROUP BY family""")
def q_compare_families(spark, sf_dir):
    """Row 57 with closed-form-checkable models: two one-feature ridges side by side."""
    from candlewick.operators.scoring import compare_families
    from candlewick.operators.splits import chronological_holdout

    m1, m5 = _one_feature_models(spark, sf_dir)
    rows = _training_rows(spark, sf_dir)
    va = chronological_holdout(rows.df, rows.n).where("NOT is_train")
    _, metrics = compare_families(va, {"ridge_log_return_1": m1, "ridge_r_mean_5": m5})
    return round_doubles(metrics)


@register("train_pipeline", f"""
WITH {_RIDGE_FOLDS},
""" + _holdout_ridge_ctes("log_return_1", "sth") + f""",
fm AS (SELECT fold, avg(abs(target - prediction)) AS mae,
              avg(CASE WHEN (target >= 0) = (prediction >= 0) THEN 1.0 ELSE 0.0 END) AS diracc FROM pr GROUP BY fold),
vm AS (SELECT avg(abs(target - (sth.my - sth.b * sth.mx + sth.b * log_return_1))) AS v
       FROM p, nn, sth WHERE pos >= CAST(floor(n * 0.8) AS BIGINT)),
lng AS (SELECT fold, 'mae_fold_' || fold AS metric, mae AS value FROM fm
        UNION ALL SELECT fold, 'diracc_fold_' || fold, diracc FROM fm
        UNION ALL SELECT NULL, 'mae_cv_mean', avg(mae) FROM fm
        UNION ALL SELECT NULL, 'diracc_cv_mean', avg(diracc) FROM fm
        UNION ALL SELECT NULL, 'val_mae', v FROM vm
        UNION ALL SELECT NULL, 'param_rows', n FROM nn
        UNION ALL SELECT NULL, 'param_universe_size', count(DISTINCT symbol) FROM p
        UNION ALL SELECT NULL, 'param_holdout_cut', floor(n * 0.8) FROM nn
        UNION ALL SELECT NULL, k, x FROM (VALUES ('param_num_features', 1), ('param_horizon', 1), ('param_n_splits', 5), ('param_alpha', 1)) c(k, x))
SELECT 'ridge_one_feature' AS run, 'ridge' AS family, CAST(fold AS INTEGER) AS fold, metric, {o.cn("value")} AS value
FROM lng""")
def q_train_pipeline(spark, sf_dir):
    """Row 51 end to end with one model input: CV metrics, holdout fit, val_mae."""
    from candlewick.operators.train import train_pipeline

    res = train_pipeline(orders_bars(spark, sf_dir), family="ridge", horizon=1, n_splits=5, run="ridge_one_feature",
                         feature_cols=["log_return_1"])
    return round_doubles(res.metrics)


_DATE_RIDGE_FOLDS = _T + """,
p AS (SELECT *, CAST(rank() OVER (ORDER BY date) - 1 AS BIGINT) AS pos FROM t),
nn AS (SELECT count(*) AS n, count(*) // 6 AS tsz FROM p),
fp AS (SELECT *, CAST(CASE WHEN pos >= n - 5 * tsz THEN (pos - (n - 5 * tsz)) // tsz END AS INTEGER) AS fold FROM p, nn),
folds AS (SELECT CAST(i AS INTEGER) AS fold, n - (5 - i) * tsz AS start FROM nn, range(5) r(i)),
st AS (SELECT folds.fold, avg(p.log_return_1) AS mx, avg(p.target) AS my,
              covar_pop(p.log_return_1, p.target) * count(*) / (var_pop(p.log_return_1) * count(*) + 1.0) AS b
       FROM folds JOIN p ON p.pos < folds.start GROUP BY folds.fold),
pr AS (SELECT fp.fold, fp.target, st.my - st.b * st.mx + st.b * fp.log_return_1 AS prediction
       FROM fp JOIN st ON fp.fold = st.fold)"""


@register("cross_validate_by_date", f"""
WITH {_DATE_RIDGE_FOLDS}
SELECT 'ridge' AS family, fold, {o.cn("avg(abs(target - prediction))")} AS mae,
       {o.cn("avg(CASE WHEN (target >= 0) = (prediction >= 0) THEN 1.0 ELSE 0.0 END)")} AS diracc,
       count(*) AS n
FROM pr GROUP BY fold""")
def q_cross_validate_by_date(spark, sf_dir):
    """Rows 38 + 50: walk-forward ridge CV on date cuts (every symbol shares each cut)."""
    from candlewick.operators.train import cross_validate, training_rows

    rows = training_rows(orders_bars(spark, sf_dir), horizon=1, by="date")
    metrics, _ = cross_validate(rows, "ridge", 5, 1.0, feature_cols=["log_return_1"])
    return round_doubles(metrics)


# --------------------------------------------------------------------------
# Model rows whose winner, row set or counts SQL can state
# --------------------------------------------------------------------------

def _holdout_lr_ctes(reg: float, name: str) -> str:
    return f"""{name} AS (SELECT avg(log_return_1) AS mx, avg(target) AS my, covar_pop(log_return_1, target) * count(*)
              / (var_pop(log_return_1) * count(*) + {reg} * count(*) / stddev_pop(target)) AS b
       FROM p, nn WHERE pos < CAST(floor(n * 0.8) AS BIGINT))"""


_GRID = (0.0, 0.5, 5.0)


@register("select_model", f"""
WITH {_N}, {", ".join(_holdout_lr_ctes(r, f"m{i}") for i, r in enumerate(_GRID))},
e AS ({" UNION ALL ".join(f"SELECT {r} AS reg_param, avg(abs(target - (my - b * mx + b * log_return_1))) AS val_mae FROM p, nn, m{i} "
                          "WHERE pos >= CAST(floor(n * 0.8) AS BIGINT)" for i, r in enumerate(_GRID))})
SELECT CAST(reg_param AS DOUBLE) AS reg_param, {o.cn("val_mae")} AS val_mae, val_mae = min(val_mae) OVER () AS best FROM e""")
def q_select_model(spark, sf_dir):
    """Row 47 on a grid of three one-feature linear models: every trial's error and the winner."""
    from pyspark.ml.regression import LinearRegression

    from candlewick.operators.models import select_model
    from candlewick.operators.splits import chronological_holdout

    rows = _training_rows(spark, sf_dir)
    split = chronological_holdout(rows.df, rows.n)
    tr = split.where("is_train")
    grid = [("linear", {"regParam": r}, LinearRegression(featuresCol="features", labelCol="target", solver="normal", regParam=r,
                                                         standardization=False, elasticNetParam=0.0)) for r in _GRID]
    res = select_model(tr, split.where("NOT is_train"), ["log_return_1"], grid=grid)
    out = [(float(t["regParam"]), float(t["val_mae"]), t["regParam"] == res.best.params["regParam"]) for t in res.trials]
    return round_doubles(spark.createDataFrame(out, "reg_param double, val_mae double, best boolean"))


_HALVING_GRID = (5.0, 0.0, 0.5, 0.05)


def _halving_sql() -> str:
    """Rungs of 4, 2 and 1 points; each rung has a third of as many rows as the training set."""
    ctes = ["c AS (SELECT CAST(floor(n * 0.8) AS BIGINT) AS c FROM nn)"]
    for j, k in enumerate((4, 2, 1)):
        fits = " UNION ALL ".join(
            f"SELECT {i} AS i, {r}::DOUBLE AS reg_param, c // {3 * k} AS train_rows, c, avg(log_return_1) AS mx, avg(target) AS my, "
            f"covar_pop(log_return_1, target) / (var_pop(log_return_1) + {r} / stddev_pop(target)) AS b "
            f"FROM p, c WHERE pos < c // {3 * k} GROUP BY c" for i, r in enumerate(_HALVING_GRID))
        alive = "" if j == 0 else f" WHERE m.i IN (SELECT i FROM k{j - 1} WHERE kept)"
        ctes.append(f"f{j} AS ({fits}), e{j} AS (SELECT m.i, m.reg_param, m.train_rows, avg(abs(target - (my - b * mx + b * log_return_1))) AS val_mae "
                    f"FROM f{j} m JOIN p ON pos >= m.c{alive} GROUP BY m.i, m.reg_param, m.train_rows), "
                    f"k{j} AS (SELECT *, row_number() OVER (ORDER BY val_mae, i) <= {max(1, k // 2)} AS kept FROM e{j})")
    parts = [f"SELECT {j} AS rung, reg_param, train_rows, {o.cn('val_mae')} AS val_mae, kept FROM k{j}" for j in range(3)]
    return f"WITH {_N}, " + ",\n".join(ctes) + "\n" + "\nUNION ALL ".join(parts)


@register("successive_halving", _halving_sql())
def q_successive_halving(spark, sf_dir):
    """Row 47 under a budget of as many rows as the training set has: the rung table."""
    from pyspark.ml.regression import LinearRegression

    from candlewick.operators.halving import select_by_halving
    from candlewick.operators.splits import chronological_holdout, holdout_cut

    rows = _training_rows(spark, sf_dir)
    split = chronological_holdout(rows.df, rows.n)
    grid = [("linear", {"regParam": r}, LinearRegression(featuresCol="features", labelCol="target", solver="normal", regParam=r,
                                                         standardization=False, elasticNetParam=0.0)) for r in _HALVING_GRID]
    res = select_by_halving(split.where("is_train"), split.where("NOT is_train"), ["log_return_1"], holdout_cut(rows.n), grid=grid)
    rows.release()
    out = [(t["rung"], float(t["regParam"]), t["rows"], float(t["val_mae"]), t["kept"]) for t in res.trials]
    return round_doubles(spark.createDataFrame(out, "rung int, reg_param double, train_rows long, val_mae double, kept boolean"))


_SEQ_ROWS = """
sq AS (SELECT symbol, date, pos, count(*) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS k FROM p)"""


@register("sequence_regressor", f"""
WITH {_N},{_SEQ_ROWS}
SELECT symbol, date, pos, true AS predicted FROM sq, nn WHERE k = 30 AND pos >= CAST(floor(n * 0.8) AS BIGINT)""")
def q_sequence_regressor(spark, sf_dir):
    """Row 48: which validation rows get a (finite) prediction from their 30 rows before."""
    from candlewick.operators.models import sequence_model, sequence_windows
    from candlewick.operators.splits import chronological_holdout, holdout_cut
    from pyspark.ml.functions import array_to_vector

    rows = _training_rows(spark, sf_dir)
    tr = chronological_holdout(rows.df, rows.n).where("is_train")
    model, _ = sequence_model(tr, ["log_return_1", "r_mean_5"], seq_len=30, max_iter=10)
    seqs = sequence_windows(rows.df, model.feature_cols, 30, keep=["pos"]).withColumn("features", array_to_vector("seq"))
    out = model.model.transform(seqs).where(F.col("pos") >= holdout_cut(rows.n))
    return out.select("symbol", "date", "pos", (F.abs("prediction") < float("inf")).alias("predicted"))


def _epochs_sql(lags: int, epochs: int, rate: float) -> str:
    """Adam on the mean absolute error of ``lags`` earlier returns, an epoch a
    pair of CTEs: gradients at the parameters, then the step."""
    names = ["b", *[f"w{j}" for j in range(lags)]]
    xs = ", ".join(f"lag((log_return_1 - mx) / sx, {lags - j}) OVER (PARTITION BY symbol ORDER BY date) AS x{j}" for j in range(lags))
    ctes = [f"""mo AS (SELECT avg(log_return_1) AS mx, stddev_pop(log_return_1) AS sx, avg(target) AS my, stddev_pop(target) AS sy FROM t)""",
            f"wn AS (SELECT * FROM (SELECT (target - my) / sy AS y, {xs} FROM t, mo) WHERE x0 IS NOT NULL)",
            "a0 AS (SELECT " + ", ".join(f"0.0::DOUBLE AS {n}, 0.0::DOUBLE AS m_{n}, 0.0::DOUBLE AS v_{n}" for n in names) + ")"]
    for i in range(1, epochs + 1):
        fit = " + ".join(["b", *[f"w{j} * x{j}" for j in range(lags)]])
        grads = ", ".join([f"avg(sign(r) * {'1' if n == 'b' else 'x' + n[1:]}) AS g_{n}" for n in names])
        ctes.append(f"g{i} AS (SELECT avg(abs(r)) AS e, {grads} FROM (SELECT wn.*, {fit} - y AS r FROM wn, a{i - 1}))")
        step = ", ".join(f"0.9 * m_{n} + 0.1::DOUBLE * g_{n} AS m_{n}, 0.999 * v_{n} + 0.001::DOUBLE * g_{n} * g_{n} AS v_{n}" for n in names)
        move = ", ".join(f"{n} - {rate}::DOUBLE * (m_{n} / (1 - pow(0.9::DOUBLE, {i}))) / (sqrt(v_{n} / (1 - pow(0.999::DOUBLE, {i}))) + 1e-8) AS {n}, "
                         f"m_{n}, v_{n}" for n in names)
        ctes.append(f"h{i} AS (SELECT {', '.join(names)}, {step} FROM a{i - 1}, g{i}), a{i} AS (SELECT {move} FROM h{i})")
    last = f"a{epochs}"
    weights = " + ".join(f"w{j}" for j in range(lags))
    parts = [f"SELECT 'train_mae' AS metric, {i - 1} AS i, {o.cn('sy * e')} AS value FROM g{i}, mo" for i in range(1, epochs + 1)]
    parts += [f"SELECT 'weight', {j}, {o.cn(f'sy * w{j} / sx')} FROM {last}, mo" for j in range(lags)]
    parts.append(f"SELECT 'intercept', 0, {o.cn(f'my + sy * b - sy * mx / sx * ({weights})')} FROM {last}, mo")
    return f"WITH {_T},\n" + ",\n".join(ctes) + "\n" + "\nUNION ALL ".join(parts)


@register("sequence_epochs", _epochs_sql(lags=5, epochs=6, rate=0.05))
def q_sequence_epochs(spark, sf_dir):
    """Row 48: the training error of each epoch, and the coefficients reached."""
    from candlewick.operators.sequence import sequence_fit

    rows = _training_rows(spark, sf_dir)
    model, errors = sequence_fit(rows.df, ["log_return_1"], seq_len=5, epochs=6, rate=0.05)
    rows.release()
    stage = model.model.stages[0]
    out = [("train_mae", i, e) for i, e in enumerate(errors)]
    out += [("weight", j, w) for j, w in enumerate(stage.getOrDefault("weights"))] + [("intercept", 0, stage.getOrDefault("intercept"))]
    return round_doubles(spark.createDataFrame(out, "metric string, i int, value double"))


_FORECAST = """
fr AS (SELECT *, ln(adj_close) - lag(ln(adj_close), 1) OVER (PARTITION BY symbol ORDER BY date) AS rh FROM p),
fc AS (SELECT *, count(*) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 63 PRECEDING AND CURRENT ROW) AS nc,
              ln(quantile_cont(exp(rh), 0.5) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS fpred
       FROM fr)"""
_ERRORS = ("avg(abs(target - prediction)) AS mae, avg(CASE WHEN (target >= 0) = (prediction >= 0) THEN 1.0 ELSE 0.0 END) AS diracc, "
           "count(*) AS n")


def _forecaster(cols):
    from candlewick.operators.models import ForecastModel

    return ForecastModel(None, cols, "hf_finetune", {"horizon": 1, "num_samples": None, "quantile": 0.5, "min_context": 64, "price_col": "adj_close"})


@register("compare_four_families", f"""
WITH {_ONE_FEATURE_BASE}, {_holdout_lr_ctes(0.0, "ols")}, {_FORECAST},
sq AS (SELECT target, count(*) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS k FROM p),
pr AS (SELECT 'ridge' AS family, target, st.my - st.b * st.mx + st.b * log_return_1 AS prediction FROM p, st
       UNION ALL SELECT 'automl', target, ols.my - ols.b * ols.mx + ols.b * log_return_1 FROM p, ols
       UNION ALL SELECT 'hf_finetune', target, fpred FROM fc WHERE nc = 64
       UNION ALL SELECT 'custom_transformer', target, NULL FROM sq WHERE k = 30),
m AS (SELECT family, {_ERRORS} FROM pr GROUP BY family)
SELECT family, n, {o.cn("mae")} AS mae, CASE WHEN family <> 'custom_transformer' THEN {o.cn("diracc")} END AS diracc FROM m""")
def q_compare_four_families(spark, sf_dir):
    """Row 57: all four families on one input (the sequence family's error has no closed form: its rows are counted)."""
    from pyspark.ml.regression import LinearRegression

    from candlewick.operators.models import ridge_fit, select_model, sequence_model
    from candlewick.operators.scoring import compare_families
    from candlewick.operators.splits import chronological_holdout

    rows = _training_rows(spark, sf_dir)
    split = chronological_holdout(rows.df, rows.n)
    tr, va, one = split.where("is_train"), split.where("NOT is_train"), ["log_return_1"]
    grid = [("linear", {"regParam": 0.0}, LinearRegression(featuresCol="features", labelCol="target", solver="normal", regParam=0.0))]
    models = {"ridge": ridge_fit(tr, one, 1.0), "automl": select_model(tr, va, one, grid=grid).best,
              "custom_transformer": sequence_model(tr, one, 30, max_iter=5)[0], "hf_finetune": _forecaster(one)}
    _, metrics = compare_families(rows.df, models)
    seq = F.col("family") == "custom_transformer"
    return round_doubles(metrics.select("family", "n", F.when(~seq, F.col("mae")).alias("mae"), F.when(~seq, F.col("diracc")).alias("diracc")))


@register("cross_validate_sample_paths", f"""
WITH {_N}, {_FORECAST},
pr AS (SELECT CAST((pos - (n - 5 * tsz)) // tsz AS INTEGER) AS fold, target, fpred AS prediction FROM fc, nn
       WHERE nc = 64 AND pos >= n - 5 * tsz),
m AS (SELECT fold, {_ERRORS} FROM pr GROUP BY fold)
SELECT 'hf_finetune' AS family, fold, {o.cn("mae")} AS mae, {o.cn("diracc")} AS diracc, n FROM m""")
def q_cross_validate_sample_paths(spark, sf_dir):
    """Row 50 for the sample-path forecaster: every test row with enough context is forecast."""
    from candlewick.operators.train import _cv_sequence

    fp = {"num_samples": None, "quantile": 0.5, "min_context": 64}
    return round_doubles(_cv_sequence(_training_rows(spark, sf_dir), "hf_finetune", 5, fp, 1, "adj_close"))


# --------------------------------------------------------------------------
# Requests without or with repeated ids, ties, many symbols
# --------------------------------------------------------------------------

def _requests_with_poor_ids(spark, sf_dir):
    """Ids absent for one month, equal for another; horizons omitted in window mode."""
    month = F.month("as_of")
    poor = F.when(month % 3 == 0, F.lit(None).cast("string")).when(month % 3 == 1, F.lit("same")).otherwise(F.col("request_id"))
    horizon = F.when(F.col("ohlcv_window").isNotNull() & (F.col("horizon") == 1), F.lit(None).cast("int")).otherwise(F.col("horizon"))
    req = _requests(spark, sf_dir)
    return req.select(*[poor.alias(c) if c == "request_id" else horizon.alias(c) if c == "horizon" else F.col(c) for c in req.columns])


_POOR = """pid AS (SELECT request_id AS own, symbol AS s, CASE WHEN month(CAST(as_of AS DATE)) % 3 = 0 THEN NULL
                       WHEN month(CAST(as_of AS DATE)) % 3 = 1 THEN 'same' ELSE request_id END AS poor FROM req)"""


@register("score_requests_without_ids", f"""
WITH {_ONE_FEATURE_BASE},{_WINDOW_SCORED_SQL},{_POOR}
SELECT poor AS request_id, symbol, {_SCORED_COLS} FROM ws JOIN pid ON own = request_id""")
def q_score_requests_without_ids(spark, sf_dir):
    """Row 53: absent and repeated ids and omitted horizons change no prediction."""
    from candlewick.operators.scoring import score_windows

    m1, _ = _one_feature_models(spark, sf_dir)
    return round_doubles(score_windows(_requests_with_poor_ids(spark, sf_dir), m1).scored.select("request_id", "symbol", "pred_return", "pred_price"))


@register("request_outcomes_without_ids", f"""
WITH req AS ({o.REQUESTS})
SELECT symbol, count(*) AS records FROM req GROUP BY symbol""")
def q_request_outcomes_without_ids(spark, sf_dir):
    """Row 53: every record is in exactly one of scored and rejected."""
    from candlewick.operators.scoring import score_requests

    m1, _ = _one_feature_models(spark, sf_dir)
    res = score_requests(_requests_with_poor_ids(spark, sf_dir), m1, allow_minimal=True)
    both = res.scored.select("symbol").unionByName(res.rejected.select("symbol"))
    return both.groupBy("symbol").agg(F.count(F.lit(1)).alias("records"))


@register("global_position_ties", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, CAST(o_orderdate AS DATE), o_orderkey) - 1 AS pos,
       row_number() OVER (PARTITION BY o_orderpriority ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) <= 7 AS newest
FROM orders""")
def q_global_position_ties(spark, sf_dir):
    """Rows 32, 34 on many rows per (symbol, date), ordered by date and order key."""
    from candlewick.operators.scoring import tail_rows
    from candlewick.operators.splits import global_position

    df = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", F.col("o_orderpriority").alias("symbol"), F.to_date("o_orderdate").alias("date"))
    placed = global_position(df, order=["date", "o_orderkey"]).df.select("o_orderkey", "pos")
    newest = tail_rows(df, 7, order=["date", "o_orderkey"]).select("o_orderkey", F.lit(True).alias("newest"))
    return placed.join(newest, "o_orderkey", "left").select("o_orderkey", "pos", F.coalesce("newest", F.lit(False)).alias("newest"))


def _on_lineitem(name: str):
    """The query and oracle of ``name`` again on the many symbols of lineitem."""
    @register(f"{name}_lineitem", ORACLES[name].replace(o.BARS_ORDERS, o.BARS_LINEITEM))
    def q(spark, sf_dir):
        held = _BARS.set(src.bars_from_lineitem)
        try:
            return QUERIES[name](spark, sf_dir)
        finally:
            _BARS.reset(held)
    return q


for _name in ("tabular_features", "training_rows", "walk_forward_folds", "cross_validate", "price_context", "quantile_forecast",
              "score_windows"):
    _on_lineitem(_name)
