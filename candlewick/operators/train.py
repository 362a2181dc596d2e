"""Training jobs: training rows, walk-forward CV, the full pipeline (rows 50, 51).

One lazy plan builds the training rows (scan -> bars -> features -> target
-> complete rows); it is checkpointed once with its position, and every
fold is a filter on that frame plus a distributed fit.  All fold
predictions feed one grouped aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.operators import models as M
from candlewick.operators.features import model_feature_names, series_window, tabular_features
from candlewick.operators.guards import drop_incomplete, min_rows_guard
from candlewick.operators.halving import select_by_halving
from candlewick.operators.metrics import cv_summary, fold_metrics, metrics_long, run_summary, write_metrics
from candlewick.operators.sequence import EPOCHS, RATE, sequence_fit
from candlewick.operators.splits import (
    FoldPlan, chronological_holdout, date_position, fold_plan, fold_test, fold_train, global_position, holdout_cut,
)
from candlewick.plans.prefix import running_offsets
from candlewick.plans.segments import DEFAULT_SEGMENT, SEG
from candlewick.session import Saved, materialize, save
from candlewick.sources.bars import filter_universe, require_columns

# Family names and aliases accepted by the reference.
FAMILY_ALIASES = {
    "ridge": "ridge",
    "automl": "automl", "flaml": "automl",
    "custom_transformer": "custom_transformer", "transformer": "custom_transformer",
    "hf_finetune": "hf_finetune", "hf": "hf_finetune",
}
MSG_UNKNOWN_FAMILY = "Unknown model_family: {name}"


def family_of(name: str) -> str:
    key = name.lower()
    if key not in FAMILY_ALIASES:
        raise ValueError(MSG_UNKNOWN_FAMILY.format(name=name))
    return FAMILY_ALIASES[key]


@dataclass
class TrainingRows:
    df: DataFrame          # features + target + pos, read from a written table
    n: int
    feature_cols: list[str]
    stored: Saved | None = None  # the written table behind ``df``

    def release(self) -> None:
        """Delete the written table once no lazy result still reads it."""
        if self.stored is not None:
            self.stored.drop()


def training_rows(bars: DataFrame, horizon: int = 1, price_col: str = "adj_close", universe: Sequence[str] | None = None,
                  segment: str | Column | None = DEFAULT_SEGMENT, by: str = "position", checkpoint: bool = True,
                  inputs: Sequence[str] | None = None) -> TrainingRows:
    """Rows 1, 6, 20, 30, 31, 13, 16, 7, 32: complete rows with their position.

    ``by="position"`` (the reference's order) runs as one feature pass: the
    complete-row filter keeps the (symbol, segment) partitioning and sort, so
    the per-segment rank is a third Window over the same spec (no extra
    exchange or sort).  That frame is written once; positions are the
    segment offsets (a small prefix sum over per-segment counts, joined back
    behind a size check) plus the rank.

    Rows are complete in every feature; ``inputs`` names those that the
    training reads, and the frame then carries (and the table holds) no other.
    """
    require_columns(bars, ["date", "symbol", price_col])
    df = bars.dropna(subset=[price_col, "symbol", "date"])
    df = filter_universe(df, list(universe) if universe else None)
    if by == "date" or not checkpoint:
        feats = tabular_features(df, price_col=price_col, horizon=horizon, segment=segment).dropna(subset=["target"])
        feature_cols = model_feature_names(feats)
        rows = drop_incomplete(feats, feature_cols, "target")
        if inputs is not None:
            feature_cols = list(inputs)
            rows = rows.select("symbol", "date", *feature_cols, "target")
        if by == "date":
            complete = save(rows, "complete-rows") if checkpoint else None     # read by the date counts and the join
            placed = date_position(complete.df if complete else rows, out="pos")
            if complete is None:
                return TrainingRows(placed.df, placed.n, feature_cols)
            stored = save(placed.df, "training-rows")
            complete.drop()
            return TrainingRows(stored.df, placed.n, feature_cols, stored)
        pos = global_position(rows, segment=segment)
        return TrainingRows(pos.df, pos.n, feature_cols)

    feats = tabular_features(df, price_col=price_col, horizon=horizon, segment=segment, keep_internal=True)
    feature_cols = model_feature_names(feats)
    order = ["date", "_tb"]
    rows = drop_incomplete(feats, feature_cols, "target")
    if inputs is not None:
        feature_cols = list(inputs)
        rows = rows.select("symbol", *order, SEG, *feature_cols, "target")
    ranked = rows.withColumn("_rn", F.row_number().over(series_window("symbol", order)) - 1)
    saved = save(ranked, "training-rows")       # with the tie-breaker, which later windows use
    stored = saved.df
    offs = running_offsets(stored.groupBy("symbol", SEG).agg(F.count(F.lit(1)).alias("_n")), ["symbol", SEG], "_n", "_segoff")
    framed = (
        stored.join(offs.df.select("symbol", SEG, "_segoff"), ["symbol", SEG])
        .withColumn("pos", (F.col("_segoff") + F.col("_rn")).cast("long"))
        .drop("_segoff", "_rn", SEG)
    )
    return TrainingRows(framed, offs.total, feature_cols, saved)


def fit_family(family: str, alpha: float = M.RIDGE_ALPHA, grid: list | None = None) -> Callable[[DataFrame, list[str], DataFrame | None], M.FittedModel]:
    fam = family_of(family)
    if fam == "ridge":
        return lambda tr, cols, va: M.ridge_fit(tr, cols, alpha)
    if fam == "automl":
        def select(tr, cols, va):
            if va is None:
                raise ValueError("automl needs a validation frame")
            return M.select_model(tr, va, cols, grid=grid).best
        return select
    raise ValueError(f"{family} is not a tabular family")


def cross_validate(rows: TrainingRows, family: str = "ridge", n_splits: int = 5, alpha: float = M.RIDGE_ALPHA,
                   feature_cols: Sequence[str] | None = None, parallelism: int | None = None,
                   method: str = "gram", grid: list | None = None) -> tuple[DataFrame, FoldPlan]:
    """Row 50: k expanding folds, predictions unioned, one grouped aggregate.

    Ridge with ``method="gram"`` needs one pass over the data for all folds
    (block sufficient statistics, see ``models.block_grams``);
    ``method="fit"`` (and every other family) fits each fold with Spark ML
    on a filter of the one written frame.
    """
    fam = family_of(family)
    cols = list(feature_cols or rows.feature_cols)
    plan = fold_plan(rows.n, n_splits)
    if fam == "ridge" and method == "gram":
        return _ridge_cv_gram(rows, plan, cols, alpha)[0], plan
    fit = fit_family(fam, alpha, grid)

    def one(i: int) -> DataFrame:
        tr, te = fold_train(rows.df, plan, i), fold_test(rows.df, plan, i)
        model = fit(tr, cols, te)
        return model.transform(te, keep=["target"]).withColumn("fold", F.lit(i))

    # Fold fits are independent Spark jobs: submit them from a small thread
    # pool (as CrossValidator's ``parallelism`` does) so they share the cluster.
    workers = max(1, min(parallelism or plan.k, plan.k))
    with ThreadPoolExecutor(max_workers=workers) as pool:
        parts = list(pool.map(one, range(plan.k)))
    preds = parts[0]
    for p in parts[1:]:
        preds = preds.unionByName(p)
    metrics = fold_metrics(preds.withColumn("family", F.lit(fam)), by=("family", "fold"))
    return metrics, plan


def _ridge_cv_gram(rows: TrainingRows, plan: FoldPlan, cols: list[str], alpha: float,
                   holdout_cut: int | None = None) -> tuple[DataFrame, dict]:
    """Walk-forward ridge metrics from one Gram pass plus one scan.

    With ``holdout_cut`` the same Gram pass also fits the 80/20 model, and the
    same scan scores its validation rows as ``fold = -1``: every row emits
    one (fold, prediction) pair per region it belongs to.
    """
    starts = [plan.test_start(i) for i in range(plan.k)]
    cuts = starts + ([holdout_cut] if holdout_cut is not None else [])
    models = M.ridge_prefix_models(rows.df, cols, cuts, alpha)
    pos = F.col("pos")
    fold = F.floor((pos - plan.first_test) / plan.size).cast("int")
    cases = " ".join(f"WHEN _fold = {i} THEN {models[st].sql()}" for i, st in enumerate(starts))
    prediction = F.expr(f"CASE {cases} END")
    rated = rows.df.select(fold.alias("_fold"), "pos", "target", *cols)
    if holdout_cut is None:     # every row is of one fold
        preds = rated.where(pos >= plan.first_test).select("target", F.col("_fold").alias("fold"), prediction.alias("prediction"))
    else:
        entries = [F.when(pos >= plan.first_test, F.struct(F.col("_fold").alias("fold"), prediction.alias("prediction"))),
                   F.when(pos >= holdout_cut, F.struct(F.lit(-1).alias("fold"), models[holdout_cut].predict().alias("prediction")))]
        preds = (
            rated.where(pos >= min(plan.first_test, holdout_cut))
            .select("target", F.explode(F.array_compact(F.array(*entries))).alias("_p"))
            .select("target", F.col("_p.fold").alias("fold"), F.col("_p.prediction").alias("prediction"))
        )
    metrics = fold_metrics(preds.withColumn("family", F.lit("ridge")), by=("family", "fold"))
    return metrics, models


@dataclass
class TrainResult:
    family: str
    model: object
    feature_cols: list[str]
    n_rows: int
    metrics: DataFrame
    params: dict = field(default_factory=dict)


#: Parameters of the families and their defaults.
FAMILY_PARAMS = {
    "automl": {"budget_rows": None},
    "custom_transformer": {"seq_len": M.SEQ_LEN, "epochs": EPOCHS, "rate": RATE},
    "hf_finetune": {"num_samples": None, "quantile": M.QUANTILE, "min_context": M.MIN_CONTEXT},
}


def train_pipeline(bars: DataFrame, family: str = "ridge", horizon: int = 1, n_splits: int = 5,
                   universe: Sequence[str] | None = None, alpha: float = M.RIDGE_ALPHA, run: str = "run",
                   cv_for_deep_models: bool = False, by: str = "position", model_path: str | None = None,
                   metrics_path: str | None = None, segment: str | Column | None = DEFAULT_SEGMENT,
                   feature_cols: Sequence[str] | None = None, price_col: str = "adj_close",
                   family_params: dict | None = None, grid: list | None = None) -> TrainResult:
    """Row 51: training rows -> guard -> walk-forward CV -> 80/20 holdout fit
    -> save model + metrics.  ``feature_cols`` restricts the model inputs
    (default: every numeric column, as the reference infers them);
    ``family_params`` overrides ``FAMILY_PARAMS``, ``grid`` the automl grid.

    The training rows' table is deleted at the end: what is returned reads
    only the small metrics table."""
    fam = family_of(family)
    unknown = set(family_params or {}) - set(FAMILY_PARAMS.get(fam, {}))
    if unknown:
        raise ValueError(f"{fam} has no parameters {sorted(unknown)}")
    fp = FAMILY_PARAMS.get(fam, {}) | (family_params or {})
    rows = training_rows(bars, horizon, price_col=price_col, universe=universe, segment=segment, by=by)
    try:
        return _train(rows, fam, fp, horizon, n_splits, alpha, run, cv_for_deep_models, model_path, metrics_path,
                      list(feature_cols or rows.feature_cols), price_col, grid)
    finally:
        rows.release()


def _train(rows: TrainingRows, fam: str, fp: dict, horizon: int, n_splits: int, alpha: float, run: str, deep_cv: bool,
           model_path: str | None, metrics_path: str | None, cols: list[str], price_col: str, grid: list | None) -> TrainResult:
    min_rows_guard(rows.df, known_rows=rows.n)
    spark = rows.df.sparkSession
    rows = TrainingRows(rows.df, rows.n, cols)
    info = run_summary(rows.df, cols).first()
    cut = holdout_cut(rows.n)
    params = {"rows": int(info["rows"]), "universe_size": int(info["universe_size"]), "num_features": len(cols),
              "horizon": horizon, "n_splits": max(n_splits, 2), "holdout_cut": cut, "price_col": price_col, **fp}
    # (metric, value) rows besides the folds: parameters that are numbers, then what the family reports
    extra: list[tuple[str, float | None]] = [(f"param_{k}", float(v)) for k, v in params.items() if v is not None and not isinstance(v, str)]

    fold_df: DataFrame | None = None
    split = chronological_holdout(rows.df, rows.n)
    tr, va = split.where("is_train"), split.where("NOT is_train")
    if fam == "ridge":
        # folds and the final 80/20 fit from one Gram pass; fold metrics and
        # the validation MAE from one scan (validation rows are fold -1)
        all_m, prefix = _ridge_cv_gram(rows, fold_plan(rows.n, n_splits), cols, alpha, holdout_cut=cut)
        all_m = materialize(all_m, "fold-metrics")
        fold_df = all_m.where(F.col("fold") >= 0)
        val = all_m.where(F.col("fold") == -1).first()
        model = M.fitted_from_coefficients(prefix[cut], "ridge", {"alpha": alpha, "solver": "gram"})
        extra += [("param_alpha", float(alpha)), ("val_mae", None if val is None else val["mae"])]
    elif fam == "automl":
        fold_df = materialize(cross_validate(rows, fam, n_splits, alpha, grid=grid)[0], "fold-metrics")
        if fp["budget_rows"] is None:
            found = M.select_model(tr, va, cols, grid=grid)
        else:
            found = select_by_halving(tr, va, cols, int(fp["budget_rows"]), grid=grid)
        model = found.best
        extra.append(("val_mae", model.params["val_mae"]))
        for i, t in enumerate(found.trials):
            extra.append((f"trial_{i}_{t['estimator']}_val_mae", float(t["val_mae"])))
            extra += [(f"trial_{i}_{t['estimator']}_{k}", float(v)) for k, v in t.items() if k not in ("estimator", "val_mae")]
    else:
        if deep_cv:
            fold_df = materialize(_cv_sequence(rows, fam, n_splits, fp, horizon, price_col), "fold-metrics")
        if fam == "custom_transformer":
            model, history = sequence_fit(tr, cols, fp["seq_len"], epochs=int(fp["epochs"]), rate=fp["rate"])
            extra += [(f"train_mae_epoch_{i}", v) for i, v in enumerate(history)]
        else:
            model = M.ForecastModel(None, cols, fam, {**fp, "horizon": horizon, "price_col": price_col})
    if model_path:
        M.write_model(model, model_path)

    if fold_df is None:
        fold_df = spark.createDataFrame([], "family string, fold int, mae double, diracc double, n long")
    extra_df = spark.createDataFrame([(fam, None, k, None if v is None else float(v)) for k, v in extra],
                                     "family string, fold int, metric string, value double")
    metrics = materialize(metrics_long(fold_df, cv_summary(fold_df), run, extra_df), "metrics")
    if metrics_path:
        write_metrics(metrics, metrics_path)
    return TrainResult(fam, model, cols, rows.n, metrics, params)


def _cv_sequence(rows: TrainingRows, fam: str, n_splits: int, fp: dict, horizon: int, price_col: str) -> DataFrame:
    """CV of the sequence families (only with ``cv_for_deep_models``); every
    test row with a full window or context is predicted (quirk Q8), and all
    three metrics are of those rows (``n`` counts them)."""
    from pyspark.ml.functions import array_to_vector

    plan = fold_plan(rows.n, n_splits)
    pos = F.col("pos")
    fold = F.floor((pos - plan.first_test) / plan.size).cast("int")
    if fam == "custom_transformer":
        # windows of the test rows (which may reach into training rows) built
        # once for every fold; each fold fits on the pieces of its own prefix
        windows = (M.sequence_windows(rows.df, rows.feature_cols, fp["seq_len"], keep=["pos"]).where(pos >= plan.first_test)
                   .select("pos", "target", array_to_vector("seq").alias("features")))
        stored = save(windows, "sequence-windows")

        def one(i: int) -> DataFrame:
            model, _ = sequence_fit(rows.df.where(pos < plan.test_start(i)), rows.feature_cols, fp["seq_len"],
                                    epochs=int(fp["epochs"]), rate=fp["rate"])
            test = stored.df.where((pos >= plan.test_start(i)) & (pos < plan.test_end(i)))
            return model.model.transform(test).select(F.lit(i).alias("fold"), "target", "prediction")

        with ThreadPoolExecutor(max_workers=plan.k) as pool:
            parts = list(pool.map(one, range(plan.k)))
        preds = parts[0]
        for p in parts[1:]:
            preds = preds.unionByName(p)
        # write the (small) metrics before the windows go
        out = materialize(fold_metrics(preds.withColumn("family", F.lit(fam)), by=("family", "fold")), "seq-metrics")
        stored.drop()
        return out
    # every test row gets the forecast made from the prices up to it
    model = M.ForecastModel(None, rows.feature_cols, fam, {**fp, "horizon": horizon, "price_col": price_col})
    preds = model.transform(rows.df, keep=["pos", "target"]).where(pos >= plan.first_test)
    return fold_metrics(preds.select(F.lit(fam).alias("family"), fold.alias("fold"), "target", "prediction"), by=("family", "fold"))
