"""Ridge equivalence, persistence, sequences, the sample-quantile forecaster, metrics."""

import math

import numpy as np
import pytest

from helpers import day

from candlewick.operators import metrics as MT
from candlewick.operators import models as M
from candlewick.operators.guards import MIN_TRAINING_ROWS, NotEnoughRowsError, min_rows_guard
from candlewick.operators.train import family_of, train_pipeline, training_rows
from candlewick.sources.bars import bars_from_orders

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return training_rows(bars_from_orders(spark, SF), horizon=1)


def closed_form_ridge(X, y, alpha):
    xm, ym = X.mean(0), y.mean()
    Xc, yc = X - xm, y - ym
    w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(X.shape[1]), Xc.T @ yc)
    return w, ym - xm @ w


@pytest.mark.parametrize("alpha", [1.0, 50.0])
def test_ridge_matches_closed_form(rows, alpha):
    cols = ["log_return_1", "r_mean_5", "vol_mean_10", "hl_range_pct"]
    m = M.ridge_fit(rows.df, cols, alpha)
    pdf = rows.df.select(*cols, "target").toPandas()
    w, b = closed_form_ridge(pdf[cols].to_numpy(), pdf["target"].to_numpy(), alpha)
    lr = m.model.stages[-1]
    assert np.allclose(lr.coefficients.toArray(), w, rtol=1e-8, atol=1e-12)
    assert math.isclose(lr.intercept, b, rel_tol=1e-9, abs_tol=1e-12)


def test_full_feature_ridge_predictions(rows):
    m = M.ridge_fit(rows.df, rows.feature_cols, 1.0)
    pdf = rows.df.toPandas().sort_values("pos")
    w, b = closed_form_ridge(pdf[rows.feature_cols].to_numpy(), pdf["target"].to_numpy(), 1.0)
    got = m.transform(rows.df, keep=["pos"]).toPandas().sort_values("pos")["prediction"].to_numpy()
    assert np.allclose(got, pdf[rows.feature_cols].to_numpy() @ w + b, atol=1e-9)


def test_model_round_trip(spark, rows, tmp_path):
    m = M.ridge_fit(rows.df, rows.feature_cols)
    M.write_model(m, str(tmp_path / "m"))
    again = M.read_model(str(tmp_path / "m"))
    assert again.feature_cols == rows.feature_cols and again.family == "ridge"
    a = m.transform(rows.df, keep=["pos"]).orderBy("pos").collect()
    b = again.transform(rows.df, keep=["pos"]).orderBy("pos").collect()
    assert a == b


def test_alignment_fills_missing_and_drops_extra(spark, rows):
    m = M.ridge_fit(rows.df, ["log_return_1", "r_mean_5"])
    df = spark.createDataFrame([(0.01, 7.0)], "log_return_1 double, junk double")
    p = m.transform(df).first()["prediction"]
    lr = m.model.stages[-1]
    assert math.isclose(p, lr.intercept + lr.coefficients[0] * 0.01, rel_tol=1e-12)


def test_min_rows_guard(spark):
    with pytest.raises(NotEnoughRowsError):
        min_rows_guard(spark.range(10))
    assert min_rows_guard(spark.range(MIN_TRAINING_ROWS + 5)) == MIN_TRAINING_ROWS


def test_family_aliases():
    assert family_of("FLAML") == "automl" and family_of("hf") == "hf_finetune"
    with pytest.raises(ValueError):
        family_of("xgboost")


def test_sequence_windows_brute_force(spark, rows):
    sw = M.sequence_windows(rows.df, ["log_return_1", "r_mean_3"], seq_len=4).toPandas()
    pdf = rows.df.select("symbol", "date", "log_return_1", "r_mean_3").toPandas().sort_values(["symbol", "date"])
    exp = {}
    for s, g in pdf.groupby("symbol"):
        x = g[["log_return_1", "r_mean_3"]].to_numpy()
        for i in range(4, len(g)):
            exp[(s, g["date"].iloc[i])] = x[i - 4:i].reshape(-1)
    assert len(sw) == len(exp)
    for r in sw.itertuples():
        assert np.allclose(r.seq, exp[(r.symbol, r.date)])


def test_quantile_forecast_brute_force(spark):
    bars = bars_from_orders(spark, SF)
    got = {r.symbol: r for r in M.quantile_forecast(bars, horizon=2, num_samples=32, quantile=0.3).collect()}
    pdf = bars.toPandas().sort_values(["symbol", "date"])
    for s, g in pdf.groupby("symbol"):
        p = g["adj_close"].to_numpy()
        lp = np.log(p)
        last = p[-1]
        samples = [last * math.exp(lp[t] - lp[t - 2]) for t in range(len(p) - 32, len(p))]
        q = float(np.quantile(samples, 0.3))
        assert math.isclose(got[s].pred_price, q, rel_tol=1e-9)
        assert math.isclose(got[s].pred_return, math.log(q / last), rel_tol=1e-9, abs_tol=1e-12)
        assert got[s].accepted == (len(p) >= 64)


def test_directional_accuracy_zero_is_up_and_nan_is_down(spark):
    df = spark.createDataFrame([(0.0, 0.5), (-1.0, float("nan")), (1.0, -1.0), (-2.0, -0.1)],
                               "target double, prediction double")
    r = MT.directional_accuracy(df).first()
    assert r.diracc == 0.75
    assert math.isnan(MT.mae(df).first().mae)  # a NaN prediction makes the mean error NaN, as in numpy


def test_train_pipeline_metrics_shape(spark):
    res = train_pipeline(bars_from_orders(spark, SF), family="ridge", n_splits=1, run="t")
    m = res.metrics.toPandas()
    assert set(m["metric"]) >= {"mae_fold_0", "mae_fold_1", "diracc_fold_1", "mae_cv_mean", "diracc_cv_mean", "val_mae"}
    assert res.params["n_splits"] == 2


def test_gram_cv_equals_per_fold_spark_fits(rows):
    from candlewick.operators.train import cross_validate

    g, _ = cross_validate(rows, "ridge", 3, method="gram")
    f, _ = cross_validate(rows, "ridge", 3, method="fit")
    a = {r.fold: r for r in g.collect()}
    b = {r.fold: r for r in f.collect()}
    assert a.keys() == b.keys() == {0, 1, 2}
    for k in a:
        assert a[k].n == b[k].n
        assert math.isclose(a[k].mae, b[k].mae, rel_tol=1e-7)
        assert math.isclose(a[k].diracc, b[k].diracc, abs_tol=1.5 / a[k].n)


@pytest.mark.parametrize("family,cv", [("automl", False), ("transformer", True), ("hf", True)])
def test_other_families_train(spark, family, cv):
    res = train_pipeline(bars_from_orders(spark, SF), family=family, n_splits=2, run="t", cv_for_deep_models=cv)
    m = res.metrics.toPandas()
    if cv:
        assert {"mae_fold_0", "mae_fold_1", "mae_cv_mean"} <= set(m["metric"])
    assert len(m) > 0


def test_quantile_forecast_rows_brute_force(spark):
    bars = bars_from_orders(spark, SF)
    for seg in (None, "month"):
        got = {(r.symbol, r.date): r for r in
               M.quantile_forecast_rows(bars, horizon=3, num_samples=20, quantile=0.4, min_context=25, segment=seg).collect()}
        pdf = bars.toPandas().sort_values(["symbol", "date"])
        for s, g in pdf.groupby("symbol"):
            p = g["adj_close"].to_numpy()
            lp = np.log(p)
            for t in range(len(p)):
                r = got[(s, g["date"].iloc[t])]
                ok = t >= 24
                assert r.accepted == ok
                if ok:
                    samples = [p[t] * math.exp(lp[k] - lp[k - 3]) for k in range(max(3, t - 19), t + 1)]
                    q = float(np.quantile(samples, 0.4))
                    assert math.isclose(r.pred_price, q, rel_tol=1e-9)
                    assert math.isclose(r.pred_return, math.log(q / p[t]), rel_tol=1e-7, abs_tol=1e-12)


def test_select_model_picks_lowest_validation_mae(rows):
    from candlewick.operators.splits import chronological_holdout

    split = chronological_holdout(rows.df, rows.n)
    tr, va = split.where("is_train"), split.where("NOT is_train")
    cols = ["log_return_1", "r_mean_5", "r_std_10", "vol_mean_5"]
    res = M.select_model(tr, va, cols)
    assert len(res.trials) == 5
    best = min(res.trials, key=lambda t: t["val_mae"])
    assert res.best.params["estimator"] == best["estimator"]
    assert math.isclose(M.validation_mae(res.best, va), best["val_mae"], rel_tol=1e-12)
    again = M.select_model(tr, va, cols)
    assert [t["val_mae"] for t in again.trials] == [t["val_mae"] for t in res.trials]


def test_sequence_regressor_shapes(rows):
    cols = ["log_return_1", "r_mean_5"]
    model, history = M.sequence_model(rows.df, cols, seq_len=5, max_iter=20)
    assert model.model.stages[0].coefficients.size == 10
    fitted = M.sequence_predict(model, rows.df, cols, seq_len=5).toPandas()
    assert math.isclose(history[0], (fitted["target"] - fitted["prediction"]).abs().mean(), rel_tol=1e-9)
    preds = M.sequence_predict(model, rows.df, cols, seq_len=5)
    n_symbols = rows.df.select("symbol").distinct().count()
    assert preds.count() == rows.n - 5 * n_symbols
    assert preds.where("prediction IS NULL OR isnan(prediction)").count() == 0


def test_train_pipeline_writes_model_and_metrics(spark, tmp_path):
    res = train_pipeline(bars_from_orders(spark, SF), family="ridge", n_splits=2, run="r1",
                         model_path=str(tmp_path / "model"), metrics_path=str(tmp_path / "metrics"))
    stored = spark.read.parquet(str(tmp_path / "metrics"))
    assert stored.where("family = 'ridge'").count() == res.metrics.count()
    again = M.read_model(str(tmp_path / "model"))
    assert again.feature_cols == res.feature_cols and again.family == "ridge"


def test_prefix_ridge_equals_spark_ml_and_round_trips(spark, rows, tmp_path):
    cut = int(rows.n * 0.8)
    coefs = M.ridge_prefix_models(rows.df, rows.feature_cols, [cut, rows.n // 2], 1.0)
    gram_model = M.fitted_from_coefficients(coefs[cut], "ridge")
    ml_model = M.ridge_fit(rows.df.where(f"pos < {cut}"), rows.feature_cols, 1.0)
    a = gram_model.transform(rows.df, keep=["pos"]).orderBy("pos").toPandas()["prediction"].to_numpy()
    b = ml_model.transform(rows.df, keep=["pos"]).orderBy("pos").toPandas()["prediction"].to_numpy()
    assert np.allclose(a, b, atol=1e-8)
    M.write_model(gram_model, str(tmp_path / "g"))
    again = M.read_model(str(tmp_path / "g"))
    assert again.feature_cols == rows.feature_cols
    c = again.transform(rows.df, keep=["pos"]).orderBy("pos").toPandas()["prediction"].to_numpy()
    assert np.array_equal(a, c)


@pytest.mark.parametrize("times", [1, 1e4, 1e6, 1e8])
def test_gram_solve_holds_on_collinear_columns_at_any_size(times):
    """The Gram stands for ``times`` as many rows; a centred SVD is the truth."""
    import numpy as np

    from candlewick.operators.models import Moments, ridge_from_gram

    rng = np.random.default_rng(0)
    base = rng.normal(size=(2000, 6)) * [1e-2, 1e-2, 1e3, 1.0, 5.0, 1e-3] + [0, 0, 5e4, 3, 0, 0]
    x = np.column_stack([base, base[:, 0] - base[:, 1], base[:, 2] + base[:, 4], np.ones(2000)])
    y = base @ rng.normal(size=6) * 1e-3 + 1e-3 * rng.normal(size=2000)
    xy = np.column_stack([x, y])
    scale = xy.std(0)
    moments = Moments(xy.mean(0), np.where(scale > 0, scale, 1.0))
    z = np.column_stack([np.ones(len(x)), (xy - moments.pivot) / moments.scale])
    got = ridge_from_gram(times * (z.T @ z), [str(i) for i in range(x.shape[1])], 1.0, moments)
    xc, yc = x - x.mean(0), y - y.mean()
    u, s, vt = np.linalg.svd(xc, full_matrices=False)
    w = vt.T @ (np.where(s > 1e-9 * s[0], s * times / (s * s * times + 1.0), 0) * (u.T @ yc))
    exp = y.mean() + xc @ w
    assert np.allclose(x @ np.array(got.weights) + got.intercept, exp, rtol=0, atol=1e-6 * y.std())


@pytest.mark.parametrize("horizon,num_samples", [(1, None), (3, None), (1, 40), (3, 1000)])
def test_last_row_forecast_equals_the_whole_one(spark, horizon, num_samples):
    bars = bars_from_orders(spark, SF)
    whole = {r.symbol: r for r in M.quantile_forecast(bars, horizon, num_samples).collect()}
    rows = M.quantile_forecast_rows(bars, horizon, num_samples).toPandas().sort_values("date").groupby("symbol").tail(1)
    for r in rows.itertuples():
        assert r.accepted == whole[r.symbol].accepted
        assert math.isclose(r.pred_price, whole[r.symbol].pred_price, rel_tol=1e-9)


def test_sample_quantile_of_both_signs(spark):
    rnd = np.random.default_rng(1)
    for values in (-5e7 + 1e5 * rnd.normal(size=2000), 1e9 * rnd.normal(size=2001), np.array([-1e300, -1.0, 0.0, 1e-300, 7.0])):
        df = spark.createDataFrame([("a", 1, float(x)) for x in values], "symbol string, step int, value double")
        for q in (0.0, 0.25, 0.5, 1.0):
            got = M.sample_quantile(df, q).first()["q_value"]
            assert math.isclose(got, np.quantile(values, q), rel_tol=1e-12), q


def test_context_and_history_have_no_cap(spark):
    rnd, rows, p = np.random.default_rng(0), [], 100.0
    for i in range(2000):
        p *= math.exp(rnd.normal(0, 0.01))
        rows.append(("X", day(i), p))
    df = spark.createDataFrame(rows, "symbol string, date date, adj_close double")
    ctx = M.price_context(df).orderBy("k").collect()
    assert [r.k for r in ctx] == list(range(2000)) and ctx[0].n_context == 2000
    lp = np.log([r[2] for r in rows])
    exp = rows[-1][2] * np.quantile(np.exp(np.diff(lp)), 0.5)
    assert math.isclose(M.quantile_forecast(df).first().pred_price, exp, rel_tol=1e-9)


@pytest.mark.parametrize("q", [0.0, 0.3, 0.5, 1.0])
def test_sample_quantile_equals_numpy_with_ties_and_signs(spark, q):
    rng = np.random.default_rng(1)
    data = {g: np.round(rng.normal(0, 3, n), 1).tolist() for g, n in (("a", 501), ("b", 2), ("c", 1))}
    df = spark.createDataFrame([(g, 1, v) for g, vs in data.items() for v in vs] + [("a", 1, None), ("a", 0, 9.0)], "symbol string, step int, value double")
    for r in MT.sample_quantile(df, q).collect():
        assert r.last_step == 1 and math.isclose(r.q_value, np.quantile(data[r.symbol], q), rel_tol=1e-12, abs_tol=1e-12)


@pytest.mark.parametrize("family", ["ridge", "automl", "custom_transformer", "hf_finetune"])
def test_every_family_trains_saves_reloads_and_scores(spark, tmp_path, family):
    from candlewick.operators.scoring import score_requests
    from candlewick.sources.requests import REQUEST_SCHEMA

    bars = bars_from_orders(spark, SF)
    params = {"custom_transformer": {"seq_len": 7}, "hf_finetune": {"num_samples": 20, "min_context": 30, "quantile": 0.4}}.get(family)
    grid = [M.default_grid()[0]] if family == "automl" else None
    res = train_pipeline(bars, family=family, horizon=2, n_splits=2, family_params=params, model_path=str(tmp_path / "m"), price_col="close", grid=grid)
    again = M.read_model(str(tmp_path / "m"))
    assert type(again) is type(res.model) and again.feature_cols == res.feature_cols
    assert all(again.params[k] == v for k, v in (params or {}).items())
    if family == "hf_finetune":
        assert again.params["horizon"] == 2 and again.params["price_col"] == "close"
    window = [(day(i).isoformat(), *[100.0 + (i * 7919 % 13)] * 5, 10.0 + i) for i in range(75)]
    req = spark.createDataFrame([("r", "A", 1, None, None, None, window), (None, "B", None, None, None, None, window[:15]),
                                 ("m", "C", 1, None, 9.0, [0.01] * 6, None)], REQUEST_SCHEMA)
    for m in (res.model, again):
        out = score_requests(req, m, allow_minimal=True)
        scored = {r.request_id: r for r in out.scored.collect()}
        rejected = {r.symbol: r.reason for r in out.rejected.collect()}
        assert len(scored) + len(rejected) == 3 and math.isfinite(scored["r"].pred_return)
        assert ("C" in rejected) == (family in M.MODEL_KINDS)
        if family == "hf_finetune":
            p = [b[5] for b in window][10:]
            exp = np.log(np.quantile([p[i] / p[i - 2] for i in range(len(p) - 20, len(p))], 0.4))
            assert math.isclose(scored["r"].pred_return, exp, abs_tol=1e-12) and "30 valid prices" in rejected["B"]
        if family == "custom_transformer":
            assert "seq_len=7" in rejected["B"]


def test_sequence_model_scores_a_table_like_its_requests(spark, rows):
    model, _ = M.sequence_model(rows.df, ["log_return_1"], seq_len=4, max_iter=5)
    out = model.transform(rows.df, keep=["symbol", "date", "pos"])
    n_symbols = rows.df.select("symbol").distinct().count()
    assert out.count() == rows.n - 3 * n_symbols


def test_metrics_of_a_run_are_replaced_not_doubled(spark, tmp_path):
    bars, path = bars_from_orders(spark, SF), str(tmp_path / "metrics")
    for run in ("a", "b", "a"):
        train_pipeline(bars, family="ridge", n_splits=2, run=run, metrics_path=path)
    stored = spark.read.parquet(path)
    assert stored.where("run = 'a'").count() == stored.where("run = 'b'").count() == stored.select("run", "family", "fold", "metric").distinct().count() / 2
    assert stored.where("metric = 'param_n_splits'").first().value == 2


def test_automl_needs_a_validation_frame(rows):
    from candlewick.operators.train import fit_family

    with pytest.raises(ValueError, match="validation"):
        fit_family("automl")(rows.df, ["log_return_1"], None)


def test_training_leaves_only_its_metrics_table(spark, tmp_path, monkeypatch):
    from candlewick import session

    monkeypatch.setattr(session, "shared_dir", lambda spark: f"file://{tmp_path}")
    train_pipeline(bars_from_orders(spark, SF), family="ridge", n_splits=2)
    left = {p.name.rsplit("-", 1)[0] for p in (tmp_path / "candlewick-tables").iterdir()}
    assert not any(n.startswith(("training-rows", "complete-rows")) for n in left)


def test_few_columns_give_the_gram_of_many(spark, rows, monkeypatch):
    from pyspark.sql import functions as F

    cols, block = ["log_return_1", "vol_mean_5"], F.floor(F.col("pos") / 500)
    df = rows.df.withColumn("vol_mean_5", F.when(F.col("pos") % 7 > 0, F.col("vol_mean_5")).otherwise(F.lit(float("nan"))))
    pdf = df.select(*cols, "target").toPandas().fillna(0.0).to_numpy()
    moments = M.column_moments(df, cols)
    assert np.allclose(moments.pivot, pdf.mean(0), rtol=1e-9) and np.allclose(moments.scale, pdf.std(0), rtol=1e-9)
    few = M.block_grams(df, cols, block, moments)
    monkeypatch.setattr(M, "FEW_COLUMNS", 0)
    many = M.block_grams(df, cols, block, moments)
    assert few.keys() == many.keys() and len(few) > 1
    for b in few:
        assert np.allclose(few[b], many[b], rtol=1e-9, atol=1e-7)


@pytest.mark.parametrize("by", ["position", "date"])
def test_training_rows_hold_only_the_inputs(spark, by):
    """The same complete rows at the same positions, without the features no model reads."""
    bars = bars_from_orders(spark, SF)
    whole, some = training_rows(bars, by=by), training_rows(bars, by=by, inputs=["log_return_1"])
    assert some.n == whole.n and some.feature_cols == ["log_return_1"]
    assert set(some.stored.df.columns) <= {"symbol", "date", "log_return_1", "target", "pos", "_tb", "_seg", "_rn"}
    shared = ["symbol", "date", "pos", "log_return_1", "target"]
    assert sorted(map(tuple, some.df.select(shared).collect())) == sorted(map(tuple, whole.df.select(shared).collect()))


def test_the_cross_validation_query_runs_no_python_and_writes_its_inputs_only(spark, monkeypatch):
    from candlewick.operators import train
    from candlewick.plans import catalog

    written, save = {}, train.save
    monkeypatch.setattr(train, "save", lambda df, name: written.setdefault(name, save(df, name)))
    monkeypatch.setattr(M, "_arrow_sums", lambda *a: pytest.fail("the Gram of one feature needs no Python"))
    assert catalog.QUERIES["cross_validate"](spark, SF).count() == 5
    assert "r_std_10" not in written["training-rows"].df.columns


@pytest.mark.parametrize("horizon,num_samples", [(1, None), (3, None), (2, 9)])
def test_forecasts_of_whole_and_cut_series_are_equal(spark, monkeypatch, horizon, num_samples):
    """Also for bars without symbol, date or price, ties, and series too short to be forecast."""
    from candlewick.plans import segments

    rnd = np.random.default_rng(3)
    rows = [(s, day(11 * i), float(p)) for s, n in (("A", 90), ("B", 70), ("C", 2), ("D", 1)) for i, p in enumerate(np.exp(rnd.normal(0, 0.1, n)))]
    rows += [("A", day(22), 1.5), ("A", day(22), 1.5), (None, day(1), 2.0), (None, day(2), 2.5), ("A", None, 3.0), ("E", None, 4.0),
             ("B", day(5), None), ("B", day(6), math.nan), ("B", day(7), math.inf)]
    df = spark.createDataFrame(rows, "symbol string, date date, adj_close double")
    found = []
    for most in (25_000, 10):
        monkeypatch.setattr(segments, "LONG_SERIES", most)
        found.append(sorted(map(repr, M.quantile_forecast(df, horizon, num_samples, 0.3).collect())))
    assert found[0] == found[1] and len(found[0]) == 6
    cut = M.quantile_forecast(df.where("symbol is not null and date is not null"), horizon, num_samples, 0.3, segment="month").collect()
    whole = {r.symbol: r for r in M.quantile_forecast(df, horizon, num_samples, 0.3).collect()}
    assert all(r.pred_price == whole[r.symbol].pred_price for r in cut) and whole["A"].pred_price is not None


def test_a_short_series_forecast_counts_no_values_and_reads_its_bars_once(spark):
    """The plan that ran holds the aggregate of the bars once, besides the one that counts them."""
    df = M.quantile_forecast(bars_from_orders(spark, SF))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and "_bc" not in final


@pytest.mark.parametrize("q", [0.0, 0.3, 0.5, 1.0])
def test_quantile_of_whole_groups_equals_that_of_buckets(spark, q):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(g, s, float(v)) for g, n in (("a", 301), ("b", 2), ("c", 1)) for s in (1, 2) for v in np.round(rng.normal(0, 3, n), 1)]
                               + [("a", 1, None), ("a", 2, math.nan), ("d", 1, None)], "symbol string, step int, value double")
    assert sorted(MT.sample_quantile(df, q, whole=True).collect()) == sorted(MT.sample_quantile(df, q).collect())
