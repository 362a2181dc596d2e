"""Request validation, routing, window/minimal scoring, batch vs stream."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.operators import scoring as S
from candlewick.operators.models import ridge_fit
from candlewick.operators.train import training_rows
from candlewick.sources.bars import bars_from_orders
from candlewick.sources.requests import REQUEST_SCHEMA, requests_from_bars, write_requests_json
from candlewick.streaming.scoring_stream import score_stream

SF = "/root/testdata/sf0.001"


def window(n, start=dt.date(2024, 1, 2), price0=100.0):
    """n weekday bars rising linearly (like the reference's one request file)."""
    out, d, i = [], start, 0
    while len(out) < n:
        if d.weekday() < 5:
            p = price0 + 0.5 * i
            out.append((d.isoformat(), p - 0.5, p + 0.5, p - 1.5, p, p, 100000.0 + 1000 * i))
            i += 1
        d += dt.timedelta(days=1)
    return out


def req(rid, symbol="AAPL", horizon=1, last_close=None, last_returns=None, bars=None):
    return (rid, symbol, horizon, None, last_close, last_returns, bars)


@pytest.fixture(scope="module")
def model(spark):
    rows = training_rows(bars_from_orders(spark, SF), horizon=1)
    return ridge_fit(rows.df, rows.feature_cols)


@pytest.fixture
def requests(spark):
    def _mk(rows):
        return spark.createDataFrame(rows, REQUEST_SCHEMA)
    return _mk


def test_validation_rules(requests):
    df = requests([
        req("ok", bars=window(20)),
        req("h0", horizon=0, bars=window(20)),
        req("h31", horizon=31, bars=window(20)),
        req("lc0", last_close=0.0, last_returns=[0.01] * 5),
        req("r4", last_close=10.0, last_returns=[0.01] * 4),
        req("r241", last_close=10.0, last_returns=[0.01] * 241),
        req("nosym", symbol=None, bars=window(20)),
    ])
    got = {r.request_id: r for r in S.validate_requests(df).collect()}
    assert got["ok"].accepted
    for k in ("h0", "h31", "lc0", "r4", "r241", "nosym"):
        assert not got[k].accepted and got[k].reject_reason


def test_routes_and_window_guard(requests):
    df = requests([
        req("w10", bars=window(10)),
        req("w11", bars=window(11)),
        req("min", last_close=10.0, last_returns=[0.01] * 6),
        req("none"),
    ])
    on = {r.request_id: r for r in S.triage(df, allow_minimal=True).collect()}
    off = {r.request_id: r for r in S.triage(df, allow_minimal=False).collect()}
    assert on["w10"].route == "rejected" and "at least 11" in on["w10"].reason
    assert on["w11"].route == "window" and on["min"].route == "minimal"
    assert on["none"].route == "rejected" and "last_close" in on["none"].reason
    assert off["min"].route == "rejected" and "disabled" in off["min"].reason


def test_window_features_row_count(requests):
    """75 bars -> 65 complete feature rows (the reference's request file)."""
    df = requests([req("r", bars=window(75))])
    assert S.features_for_requests(df).count() == 65


def test_window_scoring_first_and_last(requests, model):
    bars = window(75)
    df = requests([req("r", bars=bars)])
    feats = S.features_for_requests(df).orderBy("date")
    last = model.transform(feats, keep=["date"]).orderBy("date").collect()
    res_last = S.score_windows(df, model, row="last").scored.first()
    res_first = S.score_windows(df, model, row="first").scored.first()
    assert math.isclose(res_last.pred_return, last[-1].prediction, rel_tol=1e-12)
    assert math.isclose(res_first.pred_return, last[-11].prediction, rel_tol=1e-12)
    assert math.isclose(res_last.pred_price, bars[-1][5] * math.exp(res_last.pred_return), rel_tol=1e-12)
    assert res_last.used_mode == "tabular_from_window_adj_close"


def test_minimal_scoring(requests, model):
    r = [0.01, -0.02, 0.03, 0.0, 0.01, 0.02, -0.01]
    df = requests([req("m", last_close=50.0, last_returns=r)])
    st = S.minimal_return_stats(df).first()
    assert math.isclose(st.r_mean_5, np.mean(r[-5:])) and math.isclose(st.r_std_5, np.std(r[-5:], ddof=1))
    assert math.isclose(st.r_mean_10, np.mean(r)) and st.r_last == r[-1]
    out = S.score_minimal(df, model).scored.first()
    assert out.used_mode == "tabular_minimal"
    assert math.isclose(out.pred_price, 50.0 * math.exp(out.pred_return), rel_tol=1e-12)


def test_accepted_plus_rejected_is_everything(spark, model):
    reqs = requests_from_bars(bars_from_orders(spark, "/root/testdata/sf0.01"))
    res = S.score_requests(reqs, model, allow_minimal=True)
    ids_s = {r.request_id for r in res.scored.select("request_id").collect()}
    ids_r = {r.request_id for r in res.rejected.select("request_id").collect()}
    assert not ids_s & ids_r and ids_s | ids_r == {r.request_id for r in reqs.select("request_id").collect()}


def test_batch_and_stream_agree(spark, model, tmp_path):
    reqs = requests_from_bars(bars_from_orders(spark, "/root/testdata/sf0.01"))
    write_requests_json(reqs.repartition(3), str(tmp_path / "in"))
    s_scored, s_rej = score_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"), model,
                                   allow_minimal=True, max_files_per_trigger=1)
    b = S.score_requests(reqs, model, allow_minimal=True)
    key = ["request_id", "pred_return", "pred_price", "used_mode"]
    assert sorted(s_scored.select(*key).collect()) == sorted(b.scored.select(*key).collect())
    assert s_rej.count() == b.rejected.count()


def test_latest_bar_scoring(spark, model):
    out = S.score_latest_bars(bars_from_orders(spark, SF), model).collect()
    assert len(out) == 5 and all(r.pred_price > 0 for r in out)


def test_latest_bars_since_a_date_equal_the_whole_history(spark, model):
    bars = bars_from_orders(spark, SF)
    last = bars.agg(F.max("date")).first()[0]
    cut = bars.where(~((F.col("symbol") == "5-LOW") & (F.col("date") > last - dt.timedelta(days=900))))   # one symbol has no recent bars
    exp = sorted(S.score_latest_bars(cut, model).collect())
    assert sorted(S.score_latest_bars(cut, model, since=last - dt.timedelta(days=120)).collect()) == exp and len(exp) == 5


def test_stream_restart_adds_no_duplicates(spark, model, tmp_path):
    """New files after a restart from the same checkpoint are scored once;
    files already processed are not replayed."""
    reqs = requests_from_bars(bars_from_orders(spark, "/root/testdata/sf0.01"))
    a = reqs.where(F.col("request_id") < "3")
    b = reqs.where(F.col("request_id") >= "3")
    src_dir, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    write_requests_json(a, f"{src_dir}/a")
    first, _ = score_stream(spark, f"{src_dir}/*", out, ck, model, allow_minimal=True)
    n_first = first.count()
    write_requests_json(b, f"{src_dir}/b")
    second, rej = score_stream(spark, f"{src_dir}/*", out, ck, model, allow_minimal=True)
    ids = [r.request_id for r in second.select("request_id").collect()]
    assert len(ids) == len(set(ids)) and len(ids) > n_first
    assert len(ids) + rej.count() == reqs.count()


def test_records_without_or_with_equal_ids_stay_apart(requests, model):
    """Two senders without an id, two with the same: each is priced from its own bars."""
    bars = {price: window(30, price0=price) for price in (100.0, 5000.0, 20.0, 700.0)}
    named = requests([req(str(p), bars=b) for p, b in bars.items()])
    exp = sorted((r.pred_return, r.pred_price) for r in S.score_windows(named, model).scored.collect())
    poor = requests([req(i, bars=b) for i, b in zip((None, None, "x", "x"), bars.values(), strict=True)])
    res = S.score_windows(poor, model)
    assert sorted((r.pred_return, r.pred_price) for r in res.scored.collect()) == exp and res.rejected.count() == 0
    assert S.features_for_requests(poor).count() == 4 * 20


def test_equal_records_are_each_answered(requests, model):
    res = S.score_requests(requests([req(None, bars=window(30))] * 3 + [req("w", bars=window(5))] * 2), model)
    assert res.scored.count() == 3 and res.rejected.count() == 2
    assert len({r.pred_price for r in res.scored.collect()}) == 1


def test_omitted_horizon_is_one_and_returns_must_be_numbers(requests):
    got = {r.request_id: r for r in S.validate_requests(requests([
        req("none", horizon=None, bars=window(20)), req("null", last_close=1.0, last_returns=[0.1, None, 0.1, 0.1, 0.1]),
        req("nan", last_close=1.0, last_returns=[0.1, float("nan"), 0.1, 0.1, 0.1])])).collect()}
    assert got["none"].accepted and not got["null"].accepted and not got["nan"].accepted


def test_pretty_printed_request_file(spark, model, tmp_path):
    import json

    from candlewick.sources.requests import read_requests

    bars = [dict(zip(("date", "open", "high", "low", "close", "adj_close", "volume"), b)) for b in window(75)]
    (tmp_path / "one.json").write_text(json.dumps({"symbol": "AAPL", "ohlcv_window": bars}, indent=2))
    req_ = read_requests(spark, str(tmp_path), multi_line=True)
    assert req_.count() == 1
    res = S.score_windows(req_, model, min_rows=64, loaded_at=12.5)
    r = res.scored.first()
    assert r.symbol == "AAPL" and r.loaded_at_unix == 12.5 and math.isclose(r.pred_price, bars[-1]["adj_close"] * math.exp(r.pred_return))


def test_window_without_a_usable_row_is_rejected_once(requests, model):
    bad = [(f"no date {i}", *b[1:]) for i, b in enumerate(window(20))]
    res = S.score_requests(requests([req("bad", bars=bad), req("ok", bars=window(20))]), model)
    assert [r.request_id for r in res.scored.collect()] == ["ok"]
    assert [(r.request_id, r.reason) for r in res.rejected.collect()] == [("bad", S.MSG_NO_USABLE_ROWS)]


def test_fields_of_a_wrong_type(spark):
    """Each probed record is rejected with its own reason and kept as text."""
    import json

    from candlewick.sources.requests import parse_requests

    bar = {"open": 1, "high": "1", "low": 1.0, "close": 1, "adj_close": 1e0, "volume": 3}
    good = [{"symbol": "A"}, {"symbol": "A", "horizon": "5", "last_close": "12.5", "last_returns": ["0.1", 0, 1, 2, 3], "more": []},
            {"symbol": "A", "horizon": 2.0, "as_of": None, "ohlcv_window": [bar, bar | {"date": "2024-01-02"}], "last_close": None}]
    bad = [({"symbol": 5}, "symbol must be text"), ({"symbol": "A", "horizon": "abc"}, "horizon must be a whole number"),
           ({"symbol": "A", "horizon": 1.5}, "horizon must be a whole number"), ({"symbol": "A", "horizon": None}, "horizon must be a whole number"),
           ({"symbol": "A", "ohlcv_window": "none"}, "ohlcv_window must be a list"), ({"symbol": "A", "ohlcv_window": [3]}, "ohlcv_window must hold records"),
           ({"symbol": "A", "ohlcv_window": [bar | {"date": 3}]}, "the date of a bar must be text"),
           ({"symbol": "A", "last_close": "x"}, "last_close must be a number"), ({"symbol": "A", "last_returns": [1, 2, 3, 4, "x"]}, "last_returns must be numbers"),
           ({"symbol": "A", "last_returns": 3}, "last_returns must be a list"), ([], "not a JSON record"), (None, "not a JSON record")]
    rules = [({}, "symbol is required"), ({"symbol": "A", "horizon": 10 ** 12}, "horizon must be between 1 and 30"),
             ({"symbol": "A", "ohlcv_window": [{**bar, "open": "x"}]}, "every ohlcv_window bar needs numeric open, high, low, close, adj_close and volume")]
    lines = [*map(json.dumps, good), *(json.dumps(x) for x, _ in [*bad, *rules]), "{", None]
    df = parse_requests(spark.createDataFrame([(x, ) for x in lines], "value string").coalesce(1))
    got = S.validate_requests(df).collect()
    assert [r["reject_reason"] for r in got] == [None] * len(good) + [x for _, x in [*bad, *rules]] + ["not a JSON record"] * 2
    assert [r["raw_record"] for r in got] == [x if r["record_error"] else None for r, x in zip(got, lines, strict=True)]
    assert got[1]["horizon"] == 5 and got[1]["last_close"] == 12.5 and got[1]["last_returns"] == [0.1, 0, 1, 2, 3]
    assert [b["high"] for b in got[2]["ohlcv_window"]] == [1.0, 1.0] and got[2]["ohlcv_window"][1]["date"] == "2024-01-02"
