"""Error aggregates and summaries (inventory rows 5, 39-44)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _nan_null(c: str | Column) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(x), x)


def abs_error(y: str = "target", p: str = "prediction") -> Column:
    return F.abs(F.col(y) - F.col(p))


def direction_hit(y: str = "target", p: str = "prediction") -> Column:
    """1.0 when both are >= 0 or both are < 0 (zero counts as up; NaN is never >= 0)."""
    up_y = F.coalesce(_nan_null(y) >= 0, F.lit(False))
    up_p = F.coalesce(_nan_null(p) >= 0, F.lit(False))
    return (up_y == up_p).cast("double")


def mae(df: DataFrame, by: Sequence[str] = (), y: str = "target", p: str = "prediction") -> DataFrame:
    """Row 39: mean absolute error per group."""
    return df.groupBy(*by).agg(F.avg(abs_error(y, p)).alias("mae"))


def directional_accuracy(df: DataFrame, by: Sequence[str] = (), y: str = "target", p: str = "prediction") -> DataFrame:
    """Row 40: share of rows whose predicted direction matches."""
    return df.groupBy(*by).agg(F.avg(direction_hit(y, p)).alias("diracc"))


def fold_metrics(pred: DataFrame, by: Sequence[str] = ("family", "fold"), y: str = "target",
                 p: str = "prediction") -> DataFrame:
    """Rows 39+40 in one grouped aggregate (one pass over all fold predictions)."""
    return pred.groupBy(*by).agg(
        F.avg(abs_error(y, p)).alias("mae"),
        F.avg(direction_hit(y, p)).alias("diracc"),
        F.count(F.lit(1)).alias("n"),
    )


def cv_summary(folds: DataFrame, by: Sequence[str] = ("family",)) -> DataFrame:
    """Row 41: unweighted mean of the fold metrics."""
    return folds.groupBy(*by).agg(
        F.avg("mae").alias("mae_cv_mean"),
        F.avg("diracc").alias("diracc_cv_mean"),
        F.count(F.lit(1)).alias("folds"),
    )


def run_summary(df: DataFrame, feature_cols: Sequence[str], group_col: str = "symbol") -> DataFrame:
    """Row 42: rows, exact distinct symbols and feature count."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(group_col).alias("universe_size"),
        F.lit(len(feature_cols)).cast("long").alias("num_features"),
    )


#: Buckets per e-fold of a value's size in ``sample_quantile``.
QUANTILE_BUCKETS = 4096


def sample_quantile(samples: DataFrame, q: float, group: Sequence[str] = ("symbol",), step: str = "step",
                    value: str = "value", whole: bool = False) -> DataFrame:
    """Row 43: exact linear-interpolation quantile per (group, step); keep the last step.

    ``whole`` sorts the values of each group in one array, for groups known to
    be small (and keys that are not NULL).  Otherwise two levels, so that no task holds a group: values are counted by bucket
    (a growing function of the value, odd because ``asinh`` loses its digits
    far below zero), running counts over a group's buckets
    find those with the wanted ranks, and only their values are ranked.
    """
    keys = [*group, step]
    v, b = F.col("_v"), F.floor(F.signum("_v") * F.asinh(F.abs("_v")) * QUANTILE_BUCKETS)
    values = samples.select(*keys, F.col(value).cast("double").alias("_v")).where(v.isNotNull() & ~F.isnan(v))
    if whole:
        lists = (values.groupBy(*keys).agg(F.sort_array(F.collect_list("_v")).alias("_vs"))
                 .withColumn("_at", (F.size("_vs") - 1) * F.lit(float(q))))
        pick = lambda rank: F.element_at("_vs", rank.cast("int") + 1)
        return _last_step(lists.select(*keys, "_at", pick(F.floor("_at")).alias("_x"), pick(F.ceil("_at")).alias("_y")), group, step)
    counts = values.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")).withColumn("_b", b)
    over = Window.partitionBy(*keys)
    upto = over.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    at = F.col("_at")
    buckets = (counts.groupBy(*keys, "_b").agg(F.sum("_c").alias("_bc"))
               .select(*keys, "_b", (F.sum("_bc").over(upto) - F.col("_bc")).alias("_start"), F.sum("_bc").over(upto).alias("_end"),
                       ((F.sum("_bc").over(over) - 1) * F.lit(float(q))).alias("_at"))
               .where((F.col("_start") <= F.ceil(at)) & (F.col("_end") > F.floor(at))))
    inside = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    near = (counts.join(buckets, [*keys, "_b"])
            .withColumn("_hi", F.col("_start") + F.sum("_c").over(inside)).withColumn("_lo", F.col("_hi") - F.col("_c")))
    holds = lambda rank: F.max(F.when((F.col("_lo") <= rank) & (rank < F.col("_hi")), v))
    per_step = near.groupBy(*keys).agg(holds(F.floor(at)).alias("_x"), holds(F.ceil(at)).alias("_y"), F.first("_at").alias("_at"))
    return _last_step(per_step, group, step)


def _last_step(per_step: DataFrame, group: Sequence[str], step: str) -> DataFrame:
    """Interpolate between the neighbours ``_x`` and ``_y`` of rank ``_at``; the last step of each group."""
    at = F.col("_at")
    per_step = per_step.withColumn("_q", F.col("_x") + (F.col("_y") - F.col("_x")) * (at - F.floor(at)))
    return per_step.groupBy(*group).agg(
        F.max_by("_q", step).alias("q_value"),
        F.max(step).alias("last_step"),
    )


def metrics_long(fold_df: DataFrame, summary_df: DataFrame, run: str, extra: DataFrame | None = None) -> DataFrame:
    """Row 5 (shape): ``run, family, fold, metric, value`` (fold NULL = summary)."""
    per_fold = fold_df.select(
        "family", "fold",
        F.explode(F.array(
            F.struct(F.concat(F.lit("mae_fold_"), F.col("fold").cast("string")).alias("metric"), F.col("mae").alias("value")),
            F.struct(F.concat(F.lit("diracc_fold_"), F.col("fold").cast("string")).alias("metric"), F.col("diracc").alias("value")),
        )).alias("m"),
    ).select("family", "fold", "m.metric", "m.value")
    summ = summary_df.select(
        "family", F.lit(None).cast("int").alias("fold"),
        F.explode(F.array(
            F.struct(F.lit("mae_cv_mean").alias("metric"), F.col("mae_cv_mean").alias("value")),
            F.struct(F.lit("diracc_cv_mean").alias("metric"), F.col("diracc_cv_mean").alias("value")),
        )).alias("m"),
    ).select("family", "fold", "m.metric", "m.value")
    out = per_fold.unionByName(summ)
    if extra is not None:
        out = out.unionByName(extra.select("family", "fold", "metric", "value"))
    return out.select(F.lit(run).alias("run"), "family", "fold", "metric", F.col("value").cast("double").alias("value"))


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Row 5 (sink): partitioned by run and family; writing a run again
    replaces that run's rows and no others."""
    (metrics.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run", "family").parquet(path))
