"""Scoring jobs (inventory rows 9-11, 17, 19, 34, 44, 52-55, 57).

The reference answers one HTTP request at a time; here a table (or a
micro-batch) of requests flows through validation, routing, per-request
feature rebuild and ``transform``.  Requests that the service would answer
with an error come out in a *rejected* frame with a reason instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.columns import finite_or_null, price_from_return
from candlewick.operators.features import MIN_FEATURE_ROWS, model_feature_names, tabular_features
from candlewick.operators.guards import drop_incomplete
from candlewick.operators.models import FittedModel
from candlewick.plans.segments import DEFAULT_SEGMENT, total_order
from candlewick.sources.bars import parse_date
from candlewick.sources.requests import ERROR

# Fixed values that must equal the reference's.
HORIZON_MIN, HORIZON_MAX = 1, 30
RETURNS_MIN, RETURNS_MAX = 5, 240
MODE_WINDOW = "tabular_from_window_adj_close"
MODE_MINIMAL = "tabular_minimal"
BAR_FIELDS = ("open", "high", "low", "close", "adj_close", "volume")
# Rejection texts a caller of the service would have seen.
MSG_WINDOW_TOO_SHORT = "ohlcv_window must contain at least {min_rows} rows (needed for rolling features)."
MSG_MINIMAL_DISABLED = "This deployed model requires ohlcv_window with adj_close. Minimal mode is disabled."
MSG_MINIMAL_INPUTS = "Provide last_close + last_returns."
MSG_NO_USABLE_ROWS = "After feature engineering, no usable rows remain. Provide a longer ohlcv_window."

RESULT_COLUMNS = ("request_id", "symbol", "pred_return", "pred_price", "model_uri", "loaded_at_unix", "used_mode")


def _reason(cond: Column, text: str) -> Column:
    return F.when(cond, F.lit(text))


def _join_reasons(*reasons: Column) -> Column:
    arr = F.array_compact(F.array(*reasons))
    return F.when(F.size(arr) > 0, F.array_join(arr, "; "))


def validate_requests(req: DataFrame) -> DataFrame:
    """Row 9: the request schema rules -> ``accepted`` and ``reject_reason``.
    A record whose fields are of a wrong type (``parse_requests``) is
    rejected for that alone."""
    def bar_ok(b: Column) -> Column:
        ok = F.lit(True)
        for f in BAR_FIELDS:
            ok = ok & b[f].isNotNull() & ~F.isnan(b[f])
        return ok

    bars_ok = F.forall("ohlcv_window", bar_ok)
    reason = _join_reasons(
        _reason(F.col("symbol").isNull(), "symbol is required"),
        # an omitted horizon is HORIZON_MIN
        _reason((F.col("horizon") < HORIZON_MIN) | (F.col("horizon") > HORIZON_MAX),
                f"horizon must be between {HORIZON_MIN} and {HORIZON_MAX}"),
        _reason(F.col("last_close").isNotNull() & ~(F.col("last_close") > 0), "last_close must be > 0"),
        _reason(F.col("last_returns").isNotNull()
                & ((F.size("last_returns") < RETURNS_MIN) | (F.size("last_returns") > RETURNS_MAX)),
                f"last_returns must hold {RETURNS_MIN} to {RETURNS_MAX} values"),
        _reason(F.exists("last_returns", lambda x: x.isNull() | F.isnan(x)), "last_returns must be numbers"),
        _reason(F.col("ohlcv_window").isNotNull() & ~bars_ok,
                "every ohlcv_window bar needs numeric open, high, low, close, adj_close and volume"),
    )
    if ERROR in req.columns:
        reason = F.coalesce(F.col(ERROR), reason)
    return req.withColumn("reject_reason", reason).withColumn("accepted", F.col("reject_reason").isNull())


def min_window_guard(req: DataFrame, min_rows: int = MIN_FEATURE_ROWS) -> DataFrame:
    """Row 10: a window must carry at least ``min_rows`` raw bars (checked before cleaning)."""
    n = F.size("ohlcv_window")
    return req.withColumn("n_bars", F.when(F.col("ohlcv_window").isNotNull(), n)).withColumn(
        "window_ok", F.col("ohlcv_window").isNull() | (n >= min_rows))


def route_mode(req: DataFrame, allow_minimal: bool = False, min_rows: int = MIN_FEATURE_ROWS) -> DataFrame:
    """Row 11: window given -> window mode; else minimal mode when allowed and
    both inputs exist; else rejected (with the reason)."""
    has_window = F.col("ohlcv_window").isNotNull()
    has_minimal = F.col("last_close").isNotNull() & F.col("last_returns").isNotNull()
    route = (
        F.when(has_window, F.lit("window"))
        .when(F.lit(allow_minimal) & has_minimal, F.lit("minimal"))
        .otherwise(F.lit("rejected"))
    )
    why = (
        F.when(has_window & (F.size("ohlcv_window") < min_rows),
               F.lit(MSG_WINDOW_TOO_SHORT.format(min_rows=min_rows)))
        .when(has_window, F.lit(None).cast("string"))
        .when(~F.lit(allow_minimal),
              F.lit(MSG_MINIMAL_DISABLED))
        .when(~has_minimal, F.lit(MSG_MINIMAL_INPUTS))
    )
    return req.withColumn("route", route).withColumn("route_reason", why)


def triage(req: DataFrame, allow_minimal: bool = False, min_rows: int = MIN_FEATURE_ROWS) -> DataFrame:
    """Rows 9-11 together: ``route`` in {window, minimal, rejected} and one reason."""
    v = route_mode(validate_requests(req), allow_minimal, min_rows)
    reason = F.coalesce(F.col("reject_reason"), F.col("route_reason"))
    route = F.when(reason.isNotNull(), F.lit("rejected")).otherwise(F.col("route"))
    return v.select(*req.columns, route.alias("route"), reason.alias("reason"))


def explode_window(req: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Row 19: one row per bar (position kept as the tie-breaker), date parsed.
    ``carry`` columns of the request are repeated on every bar row."""
    from candlewick.sources.bars import coerce_date

    carry = list(carry)
    flat = req.select("request_id", "symbol", *carry, F.posexplode("ohlcv_window").alias("bar_index", "bar")).select(
        "request_id", "symbol", *carry, "bar_index", "bar.*")
    return coerce_date(flat, "date")


def distinct_records(req: DataFrame) -> DataFrame:
    """One row per distinct record, with ``_rid`` (a digest of the whole
    record, the only key of its series) and ``_copies``.

    The sender's ``request_id`` may be absent or repeated, so it is data; the
    digest is the same when a task runs again.  Records are shuffled once,
    nested, and everything after is partitioned by ``_rid`` already.
    """
    whole = F.struct(*[F.col(c) for c in req.columns])
    return (req.withColumn("_rid", F.md5(F.to_json(whole)))
            .groupBy("_rid").agg(F.first(whole).alias("_r"), F.count(F.lit(1)).alias("_copies"))
            .select("_rid", "_copies", "_r.*"))


def _each_copy(df: DataFrame) -> DataFrame:
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copy", "_copies", "_rid")


def _usable_bars(window: Column) -> Column:
    """Bars with a price and a date, with their place in the window."""
    def bar(b: Column, i: Column) -> Column:
        return F.struct(i.cast("int").alias("bar_index"), parse_date(b["date"]).alias("date"),
                        *[finite_or_null(b[c]).alias(c) for c in ("open", "high", "low", "close", "adj_close")],
                        b["volume"].alias("volume"), b["adj_close"].isNotNull().alias("_priced"))

    return F.filter(F.transform(window, bar), lambda b: b["_priced"] & b["date"].isNotNull())


def _record_features(records: DataFrame, window: Column, carry: Sequence[str], price_col: str) -> tuple[DataFrame, list[str]]:
    """Feature rows of every record (a record without a usable bar has one
    row of nulls) and the feature names."""
    bars = records.select("_rid", "_copies", *carry, F.explode_outer(_usable_bars(window)).alias("_b"))
    bars = bars.select("_rid", "_copies", *carry, "_b.bar_index", "_b.date",
                       *[F.col(f"_b.{c}") for c in BAR_FIELDS])
    feats = tabular_features(bars, group_col="_rid", price_col=price_col, segment=None, tiebreak="bar_index")
    return feats, [c for c in model_feature_names(feats) if c not in ("bar_index", *carry)]


def features_for_requests(req: DataFrame, price_col: str = "adj_close", carry: Sequence[str] = ()) -> DataFrame:
    """Row 52: per-request feature rebuild; complete rows only.

    Every record is its own series, whatever its ``request_id``.  ``carry``
    request columns ride along.
    """
    carry = ["request_id", "symbol", *carry]
    feats, cols = _record_features(distinct_records(req), F.col("ohlcv_window"), carry, price_col)
    return _each_copy(drop_incomplete(feats, cols, target=None))


def tail_rows(df: DataFrame, n: int, group_col: str = "symbol", order: Sequence[str] = ("date",)) -> DataFrame:
    """Row 34: the newest ``n`` rows of every group, ``rn`` = 1 for the newest
    (ties in ``order`` by the tie-breaker, quirk Q10).

    ``row_number() <= n`` is planned as a group limit, pre-applied before the
    shuffle, so a hot group never ships more than ``n`` rows per map task.
    """
    df, full, added = total_order(df, order)
    w = Window.partitionBy(group_col).orderBy(*[F.col(c).desc() for c in full])
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n).drop(*added)


def minimal_columns() -> dict[str, Column]:
    """Row 44: features from ``last_returns`` (mean / sample std of the last 5
    and 10 values, 0.0 std for one value), plus ``r_last`` and ``last_close``."""
    r = F.col("last_returns")

    def last_k(k: int) -> Column:
        m = F.least(F.size(r), F.lit(k))
        return F.slice(r, -m, m)

    def mean(a: Column) -> Column:
        return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x) / F.size(a)

    def std(a: Column) -> Column:
        mu = mean(a)
        ss = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + (x - mu) * (x - mu))
        return F.when(F.size(a) > 1, F.sqrt(ss / (F.size(a) - 1))).otherwise(F.lit(0.0))

    s5, s10 = last_k(5), last_k(10)
    return {"r_mean_5": mean(s5), "r_std_5": std(s5), "r_mean_10": mean(s10), "r_std_10": std(s10),
            "r_last": F.element_at(r, -1), "last_close": F.col("last_close")}


def minimal_return_stats(req: DataFrame) -> DataFrame:
    return req.select("request_id", "symbol", *[c.alias(n) for n, c in minimal_columns().items()])


@dataclass
class ScoreResult:
    """``outcomes`` has one row per record: the response, or a ``reason``.
    ``scored`` and ``rejected`` are its two halves."""

    outcomes: DataFrame

    @property
    def scored(self) -> DataFrame:
        return self.outcomes.where(F.col("reason").isNull()).select(*RESULT_COLUMNS)

    @property
    def rejected(self) -> DataFrame:
        return self.outcomes.where(F.col("reason").isNotNull()).select("request_id", "symbol", "reason")


def _outcomes(req: DataFrame, model: FittedModel, allow_minimal: bool, windows: bool, min_rows: int, row: str,
              model_uri: str, loaded_at: float) -> ScoreResult:
    """Validation, routing, features and prediction in one pass: a record is
    shuffled once and comes out in one row, so it is in one half only."""
    t = triage(distinct_records(req), allow_minimal, min_rows)
    by_window = (F.col("route") == "window") & F.lit(windows)
    price = F.coalesce(F.element_at("ohlcv_window", -1)["adj_close"], F.col("last_close"))   # the last bar *as sent* (quirk Q3)
    stats = {c: F.when(F.col("route") == "minimal", x) for c, x in minimal_columns().items()}
    t = t.select("_rid", "_copies", "request_id", "symbol", "route", "reason", price.alias("_price"),
                 F.struct(*[x.alias(c) for c, x in stats.items()]).alias("_minimal"),
                 F.when(by_window, F.col("ohlcv_window")).alias("_window"))
    carry = ["request_id", "symbol", "route", "reason", "_price", "_minimal"]
    feats, cols = _record_features(t, F.col("_window"), carry, "adj_close")
    complete = F.lit(True)
    for c in cols:
        complete = complete & finite_or_null(F.col(c).cast("double")).isNotNull()
    inputs = F.array(*[F.coalesce(finite_or_null(F.col(c).cast("double")), F.lit(0.0)) if c in feats.columns else F.lit(0.0)
                       for c in model.feature_cols])
    kept = F.when(complete, F.struct("date", "bar_index", inputs.alias("x"), F.col("adj_close").alias("p")))
    # a record's complete rows in date order: no more than the bars it was sent with
    one = feats.groupBy("_rid", "_copies").agg(F.first(F.struct(*carry)).alias("_c"),
                                               F.array_sort(F.collect_list(kept)).alias("_rows"))
    one = one.select("_rid", "_copies", "_c.*", "_rows")
    no_rows = F.when((F.col("route") == "window") & (F.size("_rows") == 0), F.lit(MSG_NO_USABLE_ROWS))
    one = model.predict_records(one.withColumn("reason", F.coalesce("reason", no_rows)), min_rows, row)
    done = F.col("reason").isNull()
    out = one.select(
        "_rid", "_copies", "request_id", "symbol", "reason",
        F.when(done, F.col("prediction")).alias("pred_return"),
        F.when(done, price_from_return("_price", "prediction")).alias("pred_price"),
        F.lit(model_uri).alias("model_uri"), F.lit(float(loaded_at)).alias("loaded_at_unix"),
        F.when(F.col("route") == "window", MODE_WINDOW).otherwise(MODE_MINIMAL).alias("used_mode"))
    return ScoreResult(_each_copy(out))


def score_windows(req: DataFrame, model: FittedModel, min_rows: int = MIN_FEATURE_ROWS, row: str = "last",
                  model_uri: str = "", loaded_at: float = 0.0) -> ScoreResult:
    """Row 53: window-mode requests -> features -> tail of ``min_rows`` complete
    rows -> predict.  ``row='last'`` scores the newest row; ``row='first'``
    the oldest row of the tail (the reference's ``y_hat[0]``, quirk Q2).
    The last price is the last bar *as sent* (quirk Q3)."""
    return _outcomes(req, model, False, True, min_rows, row, model_uri, loaded_at)


def score_minimal(req: DataFrame, model: FittedModel, model_uri: str = "", loaded_at: float = 0.0) -> ScoreResult:
    """Row 54: minimal-mode requests -> return stats -> align -> predict.
    Requests with a window are in neither half."""
    return _outcomes(req.where(F.col("ohlcv_window").isNull()), model, True, False, MIN_FEATURE_ROWS, "last", model_uri, loaded_at)


def score_requests(req: DataFrame, model: FittedModel, allow_minimal: bool = False, min_rows: int = MIN_FEATURE_ROWS,
                   row: str = "last", model_uri: str = "", loaded_at: float = 0.0) -> ScoreResult:
    """Both modes over one request table, triaged once; every request ends up
    in exactly one of ``scored`` / ``rejected``."""
    return _outcomes(req, model, allow_minimal, True, min_rows, row, model_uri, loaded_at)


def score_latest_bars(bars: DataFrame, model: FittedModel, segment: str | Column | None = DEFAULT_SEGMENT,
                      since=None) -> DataFrame:
    """Row 55: the newest complete feature row of every symbol, scored.

    ``since`` (a date) prunes the scan to newer bars; only symbols without a
    complete row there are looked up in their whole history.
    """
    recent = _latest_rows(bars if since is None else bars.where(F.col("date") >= F.lit(since)), segment)
    if since is not None:
        missing = bars.join(recent.select("symbol"), "symbol", "left_anti")
        recent = recent.unionByName(_latest_rows(missing, segment))
    preds = model.transform(recent, keep=["symbol", "date", "adj_close"])
    return preds.select("symbol", "date", F.col("prediction").alias("pred_return"),
                        price_from_return("adj_close", "prediction").alias("pred_price"))


def _latest_rows(bars: DataFrame, segment: str | Column | None) -> DataFrame:
    feats = tabular_features(bars, segment=segment)
    return tail_rows(drop_incomplete(feats, model_feature_names(feats), target=None), 1, "symbol", ["date"])


def compare_families(df: DataFrame, models: dict[str, FittedModel], keep: Sequence[str] = ("symbol", "date", "target")
                     ) -> tuple[DataFrame, DataFrame]:
    """Row 57: score one input with every family side by side, plus grouped
    metrics per family."""
    from candlewick.operators.metrics import fold_metrics

    preds = None
    for fam, m in models.items():
        p = m.transform(df, keep=list(keep)).withColumn("family", F.lit(fam))
        preds = p if preds is None else preds.unionByName(p)
    # equal keys stay apart: each copy of a key is numbered within its family
    keys = [c for c in keep if c != "target"]
    nth = F.row_number().over(Window.partitionBy("family", *keys).orderBy(*[c for c in keep if c not in keys], "prediction"))
    wide = preds.withColumn("_nth", nth).groupBy(*keys, "_nth").pivot("family", list(models)).agg(F.first("prediction")).drop("_nth")
    metrics = fold_metrics(preds.withColumn("fold", F.lit(None).cast("int")), by=("family",))
    return wide, metrics
