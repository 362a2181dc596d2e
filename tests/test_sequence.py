"""The sequence regressor's epochs against a small numpy fit on materialised windows."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.operators import models as M
from candlewick.operators.sequence import fit_pieces, sequence_fit, sequence_pieces

L = 3
SCHEMA = "symbol string, date date, a double, b double, target double, i int"


def series(seed=5):
    """Two series over several years with gaps, one shorter than a window,
    nulls, a NaN and an infinite feature, rows without a label."""
    rnd = np.random.default_rng(seed)
    rows = []
    for symbol, n in (("x", 90), ("y", 41), ("z", 2)):
        day = dt.date(2020, 1, 1)
        a = rnd.normal(5, 2, n)
        for i in range(n):
            day += dt.timedelta(days=int(rnd.integers(1, 40)))
            y = 0.01 * a[i - 1] - 0.02 * a[i - 2] + rnd.normal(0, 0.001) if i > 1 else rnd.normal()
            b = [None, float("nan"), float("inf"), *rnd.normal(0, 1, 12)][int(rnd.integers(0, 15))]
            rows.append((symbol, day, float(a[i]), None if b is None else float(b), None if i % 17 == 11 else float(y), i))
    return rows


def plain_fit(rows, epochs, rate):
    """Adam on the mean absolute error over explicit windows."""
    clean = [[v if v is not None and np.isfinite(v) else 0.0 for v in r[2:4]] for r in rows]
    labels = [r[4] for r in rows if r[4] is not None]
    mu, sd = np.mean(clean, 0), np.std(clean, 0)
    my, sy = np.mean(labels), np.std(labels)
    windows, targets = [], []
    for i, r in enumerate(rows):
        if i >= L and rows[i - L][0] == r[0] and r[4] is not None:
            windows.append(((np.array(clean[i - L:i]) - mu) / sd).reshape(-1))
            targets.append((r[4] - my) / sy)
    design = np.column_stack([np.ones(len(windows)), windows])
    theta = m = v = np.zeros(design.shape[1])
    errors = []
    for t in range(1, epochs + 1):
        off = design @ theta - targets
        errors.append(sy * np.abs(off).mean())
        g = (design * np.sign(off)[:, None]).mean(0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    w = sy * theta[1:].reshape(L, 2) / sd
    return w.reshape(-1), my + sy * theta[0] - (w * mu).sum(), errors


@pytest.mark.parametrize("segment", [None, "year", "month"])
def test_epochs_equal_a_numpy_fit(spark, segment):
    rows = series()
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    model, errors = sequence_fit(df, ["a", "b"], L, epochs=15, rate=0.1, segment=segment)
    w, b, expected = plain_fit(rows, 15, 0.1)
    stage = model.model.stages[0]
    assert np.allclose(errors, expected, rtol=1e-9)
    assert np.allclose(stage.getOrDefault("weights"), w, rtol=1e-7, atol=1e-12)
    assert np.isclose(stage.getOrDefault("intercept"), b, rtol=1e-7, atol=1e-12)
    assert errors[-1] < 0.7 * errors[0]


def test_predictions_and_saved_model(spark, tmp_path):
    rows = series()
    df = spark.createDataFrame(rows, SCHEMA)
    model, _ = sequence_fit(df, ["a", "b"], L, epochs=4)
    M.write_model(model, str(tmp_path / "m"))
    again = M.read_model(str(tmp_path / "m"))
    assert again.seq_len == L
    stage = model.model.stages[0]
    w, b = np.array(stage.getOrDefault("weights")), stage.getOrDefault("intercept")
    got = {(r["symbol"], r["date"]): r["prediction"] for r in M.sequence_predict(again, df, ["a", "b"], L).collect()}
    clean = [[v if v is not None and np.isfinite(v) else 0.0 for v in r[2:4]] for r in rows]
    exp = {(r[0], r[1]): b + w @ np.array(clean[i - L:i]).reshape(-1)
           for i, r in enumerate(rows) if i >= L and rows[i - L][0] == r[0]}
    assert got.keys() == exp.keys()
    assert all(np.isclose(got[k], exp[k], rtol=1e-9) for k in exp)


def test_every_row_is_stored_once_besides_the_look_back(spark):
    rows = series()
    df = spark.createDataFrame(rows, SCHEMA)
    pieces = sequence_pieces(df, ["a"], L).agg(F.sum(F.size("_y")), F.sum(F.size("_x")), F.count("*")).first()
    assert pieces[0] == pieces[1] <= len(rows) + L * pieces[2]


def test_repeated_rows_count_each(spark):
    rows = series()[:60]
    twice = spark.createDataFrame([r for r in rows for _ in (0, 1)], SCHEMA)
    n = sequence_pieces(twice, ["a"], L).select(F.explode("_y").alias("y")).where("y is not null").count()
    assert n == 2 * sum(r[4] is not None for r in rows)
    sequence_fit(twice, ["a"], L, epochs=1)


@pytest.mark.parametrize("rows", [[], series()[:L]])
def test_too_few_rows_are_refused(spark, rows):
    with pytest.raises(ValueError, match="seq_len=3"):
        sequence_fit(spark.createDataFrame(rows, SCHEMA), ["a", "b"], L, epochs=2)


def test_constant_column_keeps_a_finite_fit(spark):
    df = spark.createDataFrame(series(), SCHEMA).withColumn("b", F.lit(4.0))
    model, errors = sequence_fit(df, ["a", "b"], L, epochs=3)
    assert np.isfinite(errors).all() and np.isfinite(model.model.stages[0].getOrDefault("weights")).all()


def test_pieces_without_rows_add_nothing(spark):
    empty = sequence_pieces(spark.createDataFrame([], SCHEMA), ["a"], L)
    with pytest.raises(ValueError):
        fit_pieces(empty, 1, L, np.zeros(2), np.ones(2), 1, 0.1)
