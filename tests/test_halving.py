"""Successive halving against a plain loop over rungs."""

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression

from candlewick.operators.halving import rungs, select_by_halving
from candlewick.operators.models import read_model, write_model
from candlewick.operators.train import train_pipeline
from candlewick.sources.bars import bars_from_orders

SCHEMA = "pos long, a double, target double"
REGS = (5.0, 0.0, 0.3, 0.0, 0.05)


def grid():
    return [("linear", {"regParam": r}, LinearRegression(featuresCol="features", labelCol="target", solver="normal", regParam=r,
                                                         standardization=False)) for r in REGS]


def tables(spark, n=240, start=100):
    rnd = np.random.default_rng(2)
    a = rnd.normal(0, 1, n + 60)
    y = 0.5 * a + rnd.normal(0, 1 + np.arange(n + 60) / 100)
    rows = [(start + i, float(a[i]), float(y[i])) for i in range(n + 60)]
    return spark.createDataFrame(rows[:n], SCHEMA).repartition(5), spark.createDataFrame(rows[n:], SCHEMA), a, y


def plain(a, y, n, budget):
    """(reg index, rung, rows, error, kept) by closed forms."""
    plan, alive, out = rungs(len(REGS), n, budget), list(range(len(REGS))), []
    for r, (_, rows) in enumerate(plan):
        x, t = a[:rows], y[:rows]
        error = {}
        for i in alive:
            b = np.cov(x, t, bias=True)[0, 1] / (x.var() + REGS[i] / t.std())
            error[i] = np.abs(y[n:] - (t.mean() + b * (a[n:] - x.mean()))).mean()
        ranked = sorted(alive, key=lambda i: (round(error[i], 12), i))
        kept = ranked[:plan[r + 1][0]] if r + 1 < len(plan) else ranked[:1]
        out += [(r, rows, REGS[i], error[i], i in kept) for i in alive]
        alive = sorted(kept)
    return out


def test_rungs_stay_within_the_budget():
    assert rungs(5, 240, 480) == [(5, 24), (3, 40), (2, 60), (1, 120)]
    for k, n, budget, eta in [(1, 10, 5, 2), (9, 1000, 800, 3), (7, 50, 10**6, 2)]:
        plan = rungs(k, n, budget, eta)
        assert sum(p * r for p, r in plan) <= budget and plan[-1][0] == 1 and all(r <= n for _, r in plan)


@pytest.mark.parametrize("budget", [480, 10**6])
def test_rung_table_equals_a_plain_loop(spark, tmp_path, budget):
    train, val, a, y = tables(spark)
    res = select_by_halving(train, val, ["a"], budget, grid=grid())
    exp = plain(a, y, 240, budget)
    assert [(t["rung"], t["rows"], t["regParam"], t["kept"]) for t in res.trials] == [(r, n, g, k) for r, n, g, _, k in exp]
    assert np.allclose([t["val_mae"] for t in res.trials], [e for *_, e, _ in exp], rtol=1e-6)
    assert res.best.params["val_mae"] == res.trials[-1]["val_mae"] and res.trials[-1]["kept"]
    write_model(res.best, str(tmp_path / "m"))
    assert read_model(str(tmp_path / "m")).params["rows"] == res.trials[-1]["rows"]


def test_refusals(spark):
    train, val, _, _ = tables(spark)
    with pytest.raises(ValueError, match="budget"):
        select_by_halving(train, val, ["a"], 3, grid=grid())
    with pytest.raises(ValueError, match="empty"):
        select_by_halving(train.limit(0), val, ["a"], 1000, grid=grid())
    with pytest.raises(ValueError, match="eta"):
        select_by_halving(train, val, ["a"], 1000, grid=grid(), eta=1)


def test_pipeline_reports_the_rungs(spark):
    bars = bars_from_orders(spark, "/root/testdata/sf0.001")
    res = train_pipeline(bars, family="automl", n_splits=2, feature_cols=["log_return_1"], grid=grid()[:2],
                         family_params={"budget_rows": 400}, run="r")
    got = {r["metric"]: r["value"] for r in res.metrics.where("metric like 'trial%'").collect()}
    assert [got[f"trial_{i}_linear_rung"] for i in range(3)] == [0, 0, 1]
    assert [got[f"trial_{i}_linear_rows"] for i in range(3)] == [100, 100, 200]
    assert res.model.params["rows"] == 200
