"""Model jobs on Spark ML (inventory rows 4, 18, 33, 35, 43, 45-49).

Every family returns a ``FittedModel``: a fitted ``PipelineModel``
(VectorAssembler -> regressor) whose assembler carries the ordered feature
list, so model and feature order travel together when saved (row 4).
Scoring aligns inputs to that list (absent -> 0.0, extra dropped), fills
missing values with 0.0 and calls ``transform``: no Python in the hot path.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Model, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.columns import PRICE_COLUMN_PREFERENCE, finite_or_null, return_from_price
from candlewick.operators.metrics import mae, sample_quantile
from candlewick.plans.segments import DEFAULT_SEGMENT, HALO, SEG, has_keys, has_long_series, only_if, segment_of, total_order, with_halo
from candlewick.sources.versions import commit_version, current_version, new_version

# Model defaults that must equal the reference's.
RIDGE_ALPHA = 1.0
SEQ_LEN = 30
QUANTILE = 0.5
MIN_CONTEXT = 64
MSG_NO_PRICE_COLUMN = "No price column found (expected adj_close/close/price)."


@dataclass
class FittedModel:
    model: PipelineModel
    feature_cols: list[str]
    family: str
    params: dict = field(default_factory=dict)

    def prepare(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Rows 13-16 for model input: exact columns in order, double, absent
        or non-finite -> 0.0, in one projection (``abs(x) < inf`` is false for
        NULL, NaN and +-inf)."""
        keep = [c for c in keep if c not in self.feature_cols]
        types = {f.name: f.dataType for f in df.schema.fields}
        inf = F.lit(float("inf"))
        cols = []
        for c in self.feature_cols:
            if c not in types:
                cols.append(F.lit(0.0).alias(c))
                continue
            x = F.col(c) if isinstance(types[c], T.DoubleType) else F.col(c).try_cast("double")
            cols.append(F.when(F.abs(x) < inf, x).otherwise(F.lit(0.0)).alias(c))
        return df.select(*keep, *cols)

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Align, zero-fill, predict; output = ``keep`` columns + ``prediction``."""
        out = self.model.transform(self.prepare(df, keep))
        return out.select(*keep, "prediction")

    def predict_records(self, records: DataFrame, min_rows: int, row: str) -> DataFrame:
        """Add ``prediction`` to records with ``_rows`` (complete rows, oldest
        first: date, bar_index, x = model inputs, p = price) or ``_minimal``."""
        n = F.size("_rows")
        pick = F.when(n > 0, F.element_at("_rows", n if row == "last" else F.greatest(n - (min_rows - 1), F.lit(1))))["x"]
        minimal = records.schema["_minimal"].dataType.names
        inputs = [F.coalesce(pick[i], F.col("_minimal")[c] if c in minimal else F.lit(None).cast("double"), F.lit(0.0)).alias(c)
                  for i, c in enumerate(self.feature_cols)]
        kept = [c for c in records.columns if c not in ("_rows", "_minimal")]
        clash = {c: f"_in_{c}" for c in kept if c in self.feature_cols}
        flat = records.select(*[F.col(c).alias(clash.get(c, c)) for c in kept], *inputs)
        out = self.model.transform(flat)
        return out.select(*[F.col(clash.get(c, c)).alias(c) for c in kept], "prediction")


MSG_SEQUENCE_TOO_SHORT = "Need at least seq_len={n} rows."
MSG_CONTEXT_TOO_SHORT = "Need at least min_context={n} valid prices."
MSG_NEEDS_WINDOW = "This model needs an ohlcv_window."


class SequenceModel(FittedModel):
    """Row 48's regressor on flattened windows of ``params["seq_len"]`` rows."""

    @property
    def seq_len(self) -> int:
        return int(self.params["seq_len"])

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Predictions of the rows whose window (the rows up to them) is full."""
        df, _, _ = total_order(df, ["date"])
        seqs = sequence_windows(df, self.feature_cols, self.seq_len, label=None, include_current=True, keep=keep)
        return self.model.transform(seqs.withColumn("features", array_to_vector("seq"))).select(*keep, "prediction")

    def predict_records(self, records: DataFrame, min_rows: int, row: str) -> DataFrame:
        n = self.seq_len
        short = F.when(F.col("route") == "minimal", MSG_NEEDS_WINDOW).when(F.size("_rows") < n, MSG_SEQUENCE_TOO_SHORT.format(n=n))
        seq = F.flatten(F.transform(F.slice("_rows", F.greatest(F.size("_rows") - n + 1, F.lit(1)), n), lambda r: r["x"]))
        full = F.when(F.size(seq) == n * len(self.feature_cols), seq).otherwise(
            F.array_repeat(F.lit(0.0), n * len(self.feature_cols)))
        out = self.model.transform(records.withColumn("reason", F.coalesce("reason", short)).withColumn("features", array_to_vector(full)))
        return out.select(*[c for c in records.columns if c not in ("_rows", "_minimal")], "prediction")


class ForecastModel(FittedModel):
    """Row 49's sample-path forecaster: nothing is fitted, the parameters
    (horizon, num_samples, quantile, min_context, price_col) are the model."""

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """The forecast at every row whose context is long enough."""
        p = self.params
        if p["num_samples"] is None:
            from candlewick.operators.running import running_forecast_rows

            rows = running_forecast_rows(df, p["horizon"], p["quantile"], p["min_context"], price_col=p["price_col"], keep=keep)
        else:
            rows = quantile_forecast_rows(df, p["horizon"], p["num_samples"], p["quantile"], p["min_context"], price_col=p["price_col"], keep=keep)
        return rows.where("accepted").select(*keep, F.col("pred_return").alias("prediction"))

    def predict_records(self, records: DataFrame, min_rows: int, row: str) -> DataFrame:
        p = self.params
        h, q = int(p["horizon"]), float(p["quantile"])
        prices = F.filter(F.transform("_rows", lambda r: r["p"]), lambda x: x.isNotNull())
        short = F.when(F.col("route") == "minimal", MSG_NEEDS_WINDOW).when(F.size(prices) < p["min_context"], MSG_CONTEXT_TOO_SHORT.format(n=p["min_context"]))
        moves = F.when(F.size(prices) > h, F.transform(F.sequence(F.lit(h + 1), F.size(prices)),
                                                       lambda i: F.element_at(prices, i) / F.element_at(prices, i - h)))
        m = p["num_samples"]
        newest = F.array_sort(moves if m is None else F.slice(moves, F.greatest(F.size(moves) - m + 1, F.lit(1)), m))
        at = (F.size(newest) - 1) * F.lit(q)
        lo, hi = (F.element_at(newest, f(at).cast("int") + 1) for f in (F.floor, F.ceil))
        move = lo + (hi - lo) * (at - F.floor(at))
        out = records.withColumn("reason", F.coalesce("reason", short)).withColumn("prediction", F.when(F.col("reason").isNull(), F.ln(move)))
        return out.drop("_rows", "_minimal")


class LinearExpressionModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted linear model as a Spark ML stage: ``prediction`` is one
    built-in SQL expression over the input columns (no UDF), and the stage
    saves and loads inside a ``PipelineModel`` like any other."""

    inputCols = Param(Params._dummy(), "inputCols", "feature columns, in model order", TypeConverters.toListString)
    weights = Param(Params._dummy(), "weights", "one coefficient per input column", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "intercept", TypeConverters.toFloat)

    def __init__(self, inputCols: list[str] | None = None, weights: list[float] | None = None, intercept: float = 0.0):
        super().__init__()
        self._set(inputCols=list(inputCols or []), weights=[float(w) for w in (weights or [])],
                  intercept=float(intercept))

    def getInputCols(self) -> list[str]:
        return list(self.getOrDefault(self.inputCols))

    def coefficients(self) -> "LinearCoefficients":
        return LinearCoefficients(self.getInputCols(), list(self.getOrDefault(self.weights)),
                                  float(self.getOrDefault(self.intercept)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn("prediction", self.coefficients().predict())


def fitted_from_coefficients(coefs: "LinearCoefficients", family: str, params: dict | None = None) -> FittedModel:
    stage = LinearExpressionModel(coefs.feature_cols, coefs.weights, coefs.intercept)
    return FittedModel(PipelineModel(stages=[stage]), list(coefs.feature_cols), family, params or {})


def _assembler(feature_cols: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="error")


def _assembled(train: DataFrame, feature_cols: Sequence[str], label: str) -> DataFrame:
    """Model input as (features vector, label), cached for the passes of one
    fit (MEMORY_AND_DISK: spills instead of failing when it does not fit)."""
    tmp = FittedModel(None, list(feature_cols), "")  # type: ignore[arg-type]
    data = _assembler(feature_cols).transform(tmp.prepare(train, keep=[label])).select("features", label)
    return data.persist(StorageLevel.MEMORY_AND_DISK)


def _fit(train: DataFrame, feature_cols: Sequence[str], regressor, family: str, label: str = "target",
         params: dict | None = None, assembled: DataFrame | None = None) -> FittedModel:
    feature_cols = list(feature_cols)
    data = assembled if assembled is not None else _assembled(train, feature_cols, label)
    try:
        fitted = regressor.fit(data)
    finally:
        if assembled is None:
            data.unpersist()
    pm = PipelineModel(stages=[_assembler(feature_cols), fitted])
    return FittedModel(pm, feature_cols, family, params or {})


def ridge_reg_param(train: DataFrame, alpha: float, label: str = "target") -> float:
    """Spark's L2 term is scaled by the label deviation; this regParam makes
    ``solver='normal', standardization=False`` minimise ||y - Xw - b||^2 + alpha ||w||^2."""
    st = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("s")).first()
    n, s = int(st["n"]), float(st["s"] or 0.0)
    if n == 0:
        raise ValueError("empty training set")
    return alpha * s / n if s > 0 else 0.0


def ridge_fit(train: DataFrame, feature_cols: Sequence[str], alpha: float = RIDGE_ALPHA, label: str = "target") -> FittedModel:
    """Row 45: L2 regression, intercept unpenalised, no scaling."""
    data = _assembled(train, feature_cols, label)
    try:
        reg = ridge_reg_param(data, alpha, label)
        lr = LinearRegression(featuresCol="features", labelCol=label, predictionCol="prediction", solver="normal",
                              standardization=False, elasticNetParam=0.0, regParam=reg, fitIntercept=True)
        return _fit(train, feature_cols, lr, "ridge", label, {"alpha": alpha, "regParam": reg}, assembled=data)
    finally:
        data.unpersist()


def ridge_score(model: FittedModel, df: DataFrame, keep: Sequence[str] = ("symbol", "date", "target")) -> DataFrame:
    """Row 46: predictions for every row (keys and label carried through)."""
    return model.transform(df, keep=[c for c in keep if c in df.columns])


def validation_mae(model: FittedModel, val: DataFrame, label: str = "target") -> float:
    row = mae(model.transform(val, keep=[label]), y=label).first()
    return float(row["mae"]) if row and row["mae"] is not None else float("nan")


# --------------------------------------------------------------------------
# Row 4: persistence.  The feature list lives in the assembler; a small JSON
# sidecar records family and parameters.
# --------------------------------------------------------------------------

def write_model(model: FittedModel, path: str) -> None:
    """Any family: the fitted pipeline (if it has one) and a JSON sidecar, as
    a new version that readers see once all of it is written."""
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    folder = new_version(spark, path)
    if model.model is not None:
        model.model.write().save(f"{folder}/pipeline")
    meta = json.dumps({"family": model.family, "feature_cols": model.feature_cols, "params": model.params})
    spark.createDataFrame([(meta,)], "value string").coalesce(1).write.text(f"{folder}/candlewick_meta")
    commit_version(spark, folder)


def read_model(path: str) -> FittedModel:
    """The last committed version of the model at ``path``."""
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    folder = current_version(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no committed model at {path}")
    meta = json.loads(spark.read.text(f"{folder}/candlewick_meta").first()["value"])
    if not meta["feature_cols"]:
        raise RuntimeError(f"model at {path} carries no feature list; refusing to score")
    kind = MODEL_KINDS.get(meta["family"], FittedModel)
    return kind(None if kind is ForecastModel else PipelineModel.load(f"{folder}/pipeline"), meta["feature_cols"], meta["family"], meta["params"])


MODEL_KINDS = {"custom_transformer": SequenceModel, "hf_finetune": ForecastModel}


# --------------------------------------------------------------------------
# Row 47: model selection on a *given* validation frame (fixed grid, so the
# result is reproducible; replaces a wall-clock-budgeted search).
# --------------------------------------------------------------------------

def default_grid(label: str = "target", seed: int = 42) -> list[tuple[str, dict, object]]:
    grid: list[tuple[str, dict, object]] = []
    for reg in (0.0, 0.01, 0.1):
        grid.append(("linear", {"regParam": reg},
                     LinearRegression(featuresCol="features", labelCol=label, solver="normal", regParam=reg,
                                      standardization=True, elasticNetParam=0.0)))
    grid.append(("random_forest", {"numTrees": 20, "maxDepth": 5},
                 RandomForestRegressor(featuresCol="features", labelCol=label, numTrees=20, maxDepth=5, seed=seed)))
    grid.append(("gbt", {"maxIter": 20, "maxDepth": 3},
                 GBTRegressor(featuresCol="features", labelCol=label, maxIter=20, maxDepth=3, seed=seed)))
    return grid


@dataclass
class SelectionResult:
    best: FittedModel
    trials: list[dict]


def select_model(train: DataFrame, val: DataFrame, feature_cols: Sequence[str], label: str = "target",
                 grid: list | None = None, parallelism: int = 4) -> SelectionResult:
    from concurrent.futures import ThreadPoolExecutor

    data = _assembled(train, feature_cols, label)
    points = grid or default_grid(label)

    def trial(point):
        name, params, reg = point
        m = _fit(train, feature_cols, reg, "automl", label, {"estimator": name, **params}, assembled=data)
        return m, {"estimator": name, **params, "val_mae": validation_mae(m, val, label)}

    try:
        # independent fits on one cached input, submitted together (as
        # CrossValidator's ``parallelism``); results keep the grid order
        with ThreadPoolExecutor(max_workers=min(parallelism, len(points))) as pool:
            results = list(pool.map(trial, points))
    finally:
        data.unpersist()
    trials = [t for _, t in results]
    best, best_mae = None, float("inf")
    for m, t in results:
        if t["val_mae"] < best_mae:
            best, best_mae = m, t["val_mae"]
    assert best is not None
    best.params["best_estimator"] = best.params.get("estimator")
    best.params["val_mae"] = best_mae
    return SelectionResult(best, trials)


# --------------------------------------------------------------------------
# Rows 33 + 48: sequence windows and a flattened-sequence Huber regressor.
# --------------------------------------------------------------------------

def sequence_windows(df: DataFrame, feature_cols: Sequence[str], seq_len: int = SEQ_LEN, group_col: str = "symbol",
                     label: str | None = "target", segment: str | Column | None = DEFAULT_SEGMENT,
                     order: Sequence[str] = ("date",), include_current: bool = False,
                     keep: Sequence[str] = ()) -> DataFrame:
    """Row 33: for each row, the ``seq_len`` feature rows before it (flattened,
    oldest first), kept only when the window is full.  Windows never cross
    series; long series are segmented with an exact ``seq_len`` halo.
    ``keep`` columns (e.g. ``pos``) ride along."""
    feats = [F.coalesce(finite_or_null(c), F.lit(0.0)) for c in feature_cols]
    keep = [c for c in keep if c not in (group_col, *order, label)]
    extra = [*([label] if label else []), *keep]
    df, full, _ = total_order(df, order)
    base = df.select(group_col, *full, *extra, F.array(*feats).alias("_x"))
    halo = with_halo(base, [group_col], full, segment_of(order[0], segment), back=seq_len)
    w = Window.partitionBy(group_col, SEG).orderBy(*full)
    hi = 0 if include_current else -1
    frame = w.rowsBetween(-(seq_len - 1) + hi, hi)
    seq = F.flatten(F.collect_list("_x").over(frame))
    out = halo.select(group_col, *order, *extra, seq.alias("seq"), HALO)
    width = seq_len * len(feature_cols)
    return out.where((F.col(HALO) == 0) & (F.size("seq") == width)).drop(HALO)


def sequence_model(df: DataFrame, feature_cols: Sequence[str], seq_len: int = SEQ_LEN, label: str = "target",
                   max_iter: int = 50, group_col: str = "symbol") -> tuple["SequenceModel", list[float]]:
    """Row 48: Huber-loss linear model on the flattened window, with its
    training mean absolute error (the reference logs one per epoch)."""
    # not cached here: LinearRegression persists its own instance RDD for the
    # L-BFGS passes when its input is not cached (measured faster than a
    # columnar cache of the wide vectors)
    seqs = sequence_windows(df, feature_cols, seq_len, group_col, label).select(
        label, array_to_vector("seq").alias("features"))
    lr = LinearRegression(featuresCol="features", labelCol=label, loss="huber", maxIter=max_iter,
                          regParam=0.0, standardization=True)
    fitted = lr.fit(seqs)
    model = SequenceModel(PipelineModel(stages=[fitted]), list(feature_cols), "custom_transformer",
                          {"seq_len": seq_len, "iterations": len(fitted.summary.objectiveHistory)})
    return model, [float(fitted.summary.meanAbsoluteError)]


def sequence_predict(model: "SequenceModel", df: DataFrame, feature_cols: Sequence[str], seq_len: int = SEQ_LEN,
                     group_col: str = "symbol", label: str | None = "target") -> DataFrame:
    seqs = sequence_windows(df, feature_cols, seq_len, group_col, label)
    keep = [group_col, "date"] + ([label] if label else [])
    return model.model.transform(seqs.withColumn("features", array_to_vector("seq"))).select(*keep, "prediction")


# --------------------------------------------------------------------------
# Rows 35, 43, 49, 18: price context and the sample-quantile forecaster.
# --------------------------------------------------------------------------

def pick_price_col(df: DataFrame) -> str:
    for c in PRICE_COLUMN_PREFERENCE:
        if c in df.columns:
            return c
    raise ValueError(MSG_NO_PRICE_COLUMN)


def _valid_prices(df: DataFrame, group_col: str, price_col: str | None = None) -> tuple[DataFrame, list[str]]:
    """(group, date, tie-breaker, price) of the valid prices, and the total order."""
    pc = price_col or pick_price_col(df)
    df, full, _ = total_order(df, ["date"])
    valid = df.select(group_col, *full, finite_or_null(pc).alias("price"))
    return valid.where(F.col("price").isNotNull()), full


def price_context(df: DataFrame, group_col: str = "symbol", min_context: int = MIN_CONTEXT,
                  segment: str | Column | None = DEFAULT_SEGMENT, price_col: str | None = None) -> DataFrame:
    """Row 35: every valid price per symbol, one row each: ``k`` (0 = oldest),
    ``price``, and the context guard ``n_context`` / ``accepted``.

    Positions are counted inside (symbol, segment) and shifted by the sizes
    of earlier segments, so no task holds a whole series.
    """
    valid, full = _valid_prices(df, group_col, price_col)
    seg = segment_of("date", segment)
    if seg is None:     # one window per series
        w = Window.partitionBy(group_col)
        k, n = F.row_number().over(w.orderBy(*full)) - 1, F.count(F.lit(1)).over(w)
        return valid.select(group_col, "date", k.cast("long").alias("k"), "price", n.alias("n_context"), (n >= min_context).alias("accepted"))
    base = valid.withColumn(SEG, seg)
    counts = base.groupBy(group_col, SEG).agg(F.count(F.lit(1)).alias("_n"))
    over = Window.partitionBy(group_col)
    sizes = counts.select(group_col, SEG, F.sum("_n").over(over).alias("n_context"),
                          (F.sum("_n").over(over.orderBy(SEG).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"))
    k = F.row_number().over(Window.partitionBy(group_col, SEG).orderBy(*full)) - 1
    return (base.withColumn("_k", k).join(sizes, [group_col, SEG])
            .select(group_col, "date", (F.col("_before") + F.col("_k")).cast("long").alias("k"), "price", "n_context",
                    (F.col("n_context") >= min_context).alias("accepted")))


def sample_paths(df: DataFrame, horizon: int = 1, num_samples: int | None = None, group_col: str = "symbol",
                 segment: str | Column | None = DEFAULT_SEGMENT, price_col: str | None = None) -> DataFrame:
    """Long table (symbol, sample_id, step, price, last_price): the observed
    ``horizon``-step paths of the whole history (``sample_id`` 0 is the
    newest), replayed from the latest price; ``num_samples`` keeps the newest
    so many."""
    context = price_context(df, group_col, 0, segment, price_col)
    if segment is None:
        newest = Window.partitionBy(group_col).orderBy("k").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        context = context.withColumn("last_price", F.last("price").over(newest))
    else:
        context = context.join(context.groupBy(group_col).agg(F.max_by("price", "k").alias("last_price")), group_col)
    halo = with_halo(context, [group_col], ["k"], segment_of("date", segment), back=horizon)
    w = Window.partitionBy(group_col, SEG).orderBy("k")
    lp = F.ln(F.col("price"))
    steps = halo.select(
        group_col, HALO, "last_price", (F.col("n_context") - 1 - F.col("k")).alias("sample_id"), F.lag(lp, horizon).over(w).alias("_base"),
        # step s (1..h) of the path ending at this row: ln p[t-h+s]
        F.array(*[F.lag(lp, horizon - s).over(w) if s < horizon else lp for s in range(1, horizon + 1)]).alias("_steps"))
    samples = steps.where((F.col(HALO) == 0) & F.col("_base").isNotNull())
    if num_samples is not None:
        samples = samples.where(F.col("sample_id") < num_samples)
    return samples.select(
        group_col, "sample_id", "last_price", F.posexplode("_steps").alias("_s", "_lp"), "_base",
    ).select(group_col, "sample_id", (F.col("_s") + 1).alias("step"),
             (F.col("last_price") * F.exp(F.col("_lp") - F.col("_base"))).alias("price"), "last_price")


def quantile_forecast(df: DataFrame, horizon: int = 1, num_samples: int | None = None, quantile: float = QUANTILE,
                      min_context: int = MIN_CONTEXT, group_col: str = "symbol",
                      segment: str | Column | None = DEFAULT_SEGMENT, price_col: str | None = None) -> DataFrame:
    """Row 49: context guard -> sample paths -> quantile of the last step ->
    log return against the latest price.  The whole history is sampled
    unless ``num_samples`` says how many of the newest paths are.

    With the default cut, tables whose series are all short
    (``segments.LONG_SERIES``) take each series in one window and one sorted
    array; the other form then reads nothing, and the other way round."""
    valid, full = _valid_prices(df, group_col, price_col)
    counts = valid.groupBy(group_col).agg(F.count(F.lit(1)).alias("n_context"),
                                          F.max_by("price", F.struct(*full)).alias("last_price"))
    parts = [(df, segment)]
    if isinstance(segment, str) and segment == DEFAULT_SEGMENT:
        long, seg = has_long_series(df, [group_col]), segment_of("date", segment)
        keyed = has_keys([group_col], F.col("date"))
        # the price in the condition keeps it above an aggregate, whose exchange then serves the counts too
        priced = keyed & F.col(price_col or pick_price_col(df)).isNotNull()
        parts = [(only_if(df, ~long, priced), None), (only_if(df, long, keyed), seg)]
    forms = [
        sample_quantile(sample_paths(part, horizon, num_samples, group_col, cut, price_col).where(F.col("step") == horizon), quantile,
                        group=[group_col], step="step", value="price", whole=cut is None)
        for part, cut in parts
    ]
    q = reduce(DataFrame.unionByName, forms)
    # one row of each table per series, brought together without a condition on the key
    out = (counts.unionByName(q.select(group_col, "q_value"), allowMissingColumns=True).groupBy(group_col)
           .agg(*[F.max(c).alias(c) for c in ("n_context", "last_price", "q_value")]))
    accepted = F.col("n_context") >= min_context
    return out.select(
        group_col, "n_context", accepted.alias("accepted"), "last_price",
        F.when(accepted, F.col("q_value")).alias("pred_price"),
        F.when(accepted, return_from_price("q_value", "last_price")).alias("pred_return"),
    )


# --------------------------------------------------------------------------
# Rows 45 + 50, one-pass form: ridge over expanding folds from block Gram
# matrices.  Fold i trains on blocks 0..i, so every fold's normal equations
# are a prefix sum of per-block sufficient statistics, all gathered in ONE
# pass over the data (for many columns a numpy Gram per partition and block,
# summed per block by Spark).  Only k+1 matrices of (d+2)^2 numbers reach the driver.
# --------------------------------------------------------------------------

#: Features up to which a Gram matrix is summed entry by entry.
FEW_COLUMNS = 6


@dataclass
class LinearCoefficients:
    feature_cols: list[str]
    weights: list[float]
    intercept: float

    def sql(self) -> str:
        """The prediction as SQL text (same input cleaning as
        ``FittedModel.prepare``: non-finite or missing -> 0.0)."""
        terms = [repr(float(self.intercept))]
        for c, w in zip(self.feature_cols, self.weights):
            x = f"CAST(`{c}` AS DOUBLE)"
            terms.append(f"{float(w)!r} * (CASE WHEN abs({x}) < double('inf') THEN {x} ELSE 0.0 END)")
        return " + ".join(terms)

    def predict(self) -> Column:
        """One built-in expression, built from text in a single call."""
        return F.expr(self.sql())


@dataclass
class Moments:
    """Pivot and scale of each column (features, then the label)."""

    pivot: "np.ndarray"
    scale: "np.ndarray"


def _arrow_sums(df: DataFrame, cols: Sequence[str], label: str, block: Column, of) -> dict[int, "np.ndarray"]:
    """Sums by block of the vector ``of(x, y)`` makes of a batch's cleaned
    features and labels: numpy per partition, added up by Spark."""
    import numpy as np
    import pandas as pd
    from pyspark.ml.stat import Summarizer

    cols = list(cols)

    def sums(batches):
        acc: dict[int, np.ndarray] = {}
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype=float, na_value=np.nan)
            x[~np.isfinite(x)] = 0.0
            y, blocks = pdf[label].to_numpy(dtype=float), pdf["_blk"].to_numpy()
            for b in np.unique(blocks):
                own = blocks == b
                acc[int(b)] = acc.get(int(b), 0.0) + of(x[own], y[own])
        if acc:
            yield pd.DataFrame({"_blk": list(acc), "sums": [g.tolist() for g in acc.values()]})

    per_part = df.select(block.cast("int").alias("_blk"), *[F.col(c).cast("double") for c in cols],
                         F.col(label).cast("double")).mapInPandas(sums, "_blk int, sums array<double>")
    total = per_part.groupBy("_blk").agg(Summarizer.sum(array_to_vector("sums")).alias("g"))
    return {int(r["_blk"]): np.asarray(r["g"].toArray()) for r in total.collect()}


def _cleaned(cols: Sequence[str], label: str) -> list[Column]:
    """Features (non-finite or missing -> 0.0), then the label (missing -> NaN)."""
    x = [F.col(c).cast("double") for c in cols]
    return [*[F.when(F.abs(v) < F.lit(float("inf")), v).otherwise(F.lit(0.0)) for v in x],
            F.coalesce(F.col(label).cast("double"), F.lit(float("nan")))]


def column_moments(df: DataFrame, feature_cols: Sequence[str], label: str = "target") -> Moments:
    """Mean and deviation of every cleaned column, one built-in aggregate.
    Grams are taken of pivoted and scaled columns, so that rounding stays far
    below the penalty whatever the number of rows."""
    import numpy as np

    z = _cleaned(feature_cols, label)
    got = df.agg(*[f(v).alias(f"{n}{i}") for i, v in enumerate(z) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean, sd = (np.array([got[f"{n}{i}"] or 0.0 for i in range(len(z))]) for n in "ms")
    return Moments(mean, np.where(sd * sd > 1e-14 * mean * mean, sd, 1.0))


def block_grams(df: DataFrame, feature_cols: Sequence[str], block: Column, moments: Moments,
                label: str = "target") -> dict[int, "np.ndarray"]:
    """Sum of z z^T per block, z = [1, x_1..x_d, y] with pivoted and scaled
    x and y (non-finite x -> 0.0 before that).  Few columns are summed by a
    built-in aggregate, many by numpy per partition."""
    import numpy as np

    if len(feature_cols) <= FEW_COLUMNS:
        z = [F.lit(1.0), *[(v - F.lit(float(p))) / F.lit(float(s)) for v, p, s in zip(_cleaned(feature_cols, label), moments.pivot, moments.scale)]]
        pairs = [(i, j) for i in range(len(z)) for j in range(i, len(z))]
        rows = (df.select(block.cast("int").alias("_blk"), *[v.alias(f"_z{i}") for i, v in enumerate(z)]).groupBy("_blk")
                .agg(*[F.sum(F.col(f"_z{i}") * F.col(f"_z{j}")).alias(f"{i}_{j}") for i, j in pairs]).collect())
        return {int(r["_blk"]): np.array([[r[f"{min(i, j)}_{max(i, j)}"] for j in range(len(z))] for i in range(len(z))]) for r in rows}

    def gram(x, y):
        z = np.column_stack([np.ones(len(x)), (np.column_stack([x, y]) - moments.pivot) / moments.scale])
        return (z.T @ z).reshape(-1)

    m = len(feature_cols) + 2
    return {b: g.reshape(m, m) for b, g in _arrow_sums(df, feature_cols, label, block, gram).items()}


def ridge_from_gram(g: "np.ndarray", feature_cols: Sequence[str], alpha: float, moments: Moments) -> LinearCoefficients:
    """argmin ||y - Xw - b||^2 + alpha ||w||^2 (intercept unpenalised).

    ``g`` is the Gram of pivoted and scaled columns.  The normal equations
    get a unit diagonal and are solved by symmetric eigendecomposition;
    directions that are pure rounding are cut off."""
    import numpy as np

    d = len(feature_cols)
    n = g[0, 0]
    xbar, ybar = g[0, 1:d + 1] / n, g[0, d + 1] / n
    sx, sy = moments.scale[:d], moments.scale[d]
    a = g[1:d + 1, 1:d + 1] - n * np.outer(xbar, xbar) + np.diag(alpha / sx ** 2)     # w = v * sy / sx
    rhs = g[1:d + 1, d + 1] - n * xbar * ybar
    unit = 1 / np.sqrt(np.maximum(np.diag(a), np.finfo(float).tiny))
    values, vectors = np.linalg.eigh(a * np.outer(unit, unit))
    keep = values > max(values[-1], 0.0) * d * np.finfo(float).eps
    inverse = np.where(keep, 1 / np.where(keep, values, 1.0), 0.0)
    v = unit * (vectors @ (inverse * (vectors.T @ (unit * rhs))))
    w = v * sy / sx
    b = moments.pivot[d] + sy * ybar - w @ (moments.pivot[:d] + sx * xbar)
    return LinearCoefficients(list(feature_cols), [float(x) for x in w], float(b))


def quantile_forecast_rows(df: DataFrame, horizon: int = 1, num_samples: int | None = None, quantile: float = QUANTILE,
                           min_context: int = MIN_CONTEXT, group_col: str = "symbol",
                           segment: str | Column | None = DEFAULT_SEGMENT, price_col: str | None = None,
                           keep: Sequence[str] = ()) -> DataFrame:
    """Row 49 for every row (quirk Q8): the forecast that
    ``quantile_forecast(num_samples=...)`` would make of the prices up to it.

    Paths replayed from the row's own price p_t scale with p_t, so the
    quantile of the last step is p_t * percentile(exp(r_h)) over all h-step
    log returns r_h up to the row, one growing window per series; or over the
    newest ``num_samples``, a sliding window, with long series segmented with
    an exact halo.  ``keep`` columns ride along.  The growing window sorts a
    row's history anew: ``running.running_forecast_rows`` is the form for long
    series."""
    keep = [c for c in keep if c not in (group_col, "date")]
    pc = price_col or pick_price_col(df)
    df, full, _ = total_order(df, ["date"])
    valid = df.select(group_col, *full, *[c for c in keep if c not in full], finite_or_null(pc).alias("_p")).where(F.col("_p").isNotNull())
    back = max((num_samples or 0) + horizon - 1, min_context - 1)
    # the whole history up to each row is no halo
    halo = with_halo(valid, [group_col], full, None if num_samples is None else segment_of("date", segment), back=back)
    w = Window.partitionBy(group_col, SEG).orderBy(*full)
    lp = F.ln(F.col("_p"))
    step = halo.select("*", (lp - F.lag(lp, horizon).over(w)).alias("_rh"))
    frame = w.rowsBetween(Window.unboundedPreceding if num_samples is None else -(num_samples - 1), 0)
    ctx = w.rowsBetween(-(min_context - 1), 0)
    q_price = F.col("_p") * F.percentile(F.exp(F.col("_rh")), quantile).over(frame)
    accepted = F.count(F.lit(1)).over(ctx) == min_context
    out = step.select(
        group_col, "date", *keep, F.col("_p").alias("last_price"), accepted.alias("accepted"),
        F.when(accepted, q_price).alias("pred_price"), HALO,
    ).where(F.col(HALO) == 0).drop(HALO)
    return out.withColumn("pred_return", return_from_price("pred_price", "last_price"))


def ridge_prefix_models(df: DataFrame, feature_cols: Sequence[str], cuts: Sequence[int], alpha: float = RIDGE_ALPHA,
                        pos: str = "pos", label: str = "target") -> dict[int, LinearCoefficients]:
    """Ridge fitted on every training prefix ``pos < cut``, all from one
    aggregate of moments and one pass of Grams.

    Rows are cut into blocks at the sorted cuts; each prefix is a sum of
    whole blocks' Gram matrices.  Used for the walk-forward folds and the
    final holdout fit of the ridge family together.
    """
    bounds = sorted({int(c) for c in cuts})
    p = F.col(pos)
    block = F.lit(len(bounds))
    for j in reversed(range(len(bounds))):
        block = F.when(p < bounds[j], F.lit(j)).otherwise(block)
    used = df.where(p < bounds[-1])
    moments = column_moments(used, feature_cols, label)
    grams = block_grams(used, feature_cols, block, moments, label)
    out, acc = {}, None
    for j, b in enumerate(bounds):
        g = grams.get(j)
        if g is not None:
            acc = g if acc is None else acc + g
        if acc is None:
            raise ValueError(f"no training rows before position {b}")
        out[b] = ridge_from_gram(acc, feature_cols, alpha, moments)
    return out
