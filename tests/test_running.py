"""Running quantiles against a plain sort of every prefix."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.operators import models as M
from candlewick.operators.running import running_forecast_rows, running_quantile
from candlewick.sources.bars import bars_from_orders

SF = "/root/testdata/sf0.001"
SCHEMA = "symbol string, pos long, value double"


def series(seed=3):
    """A long series with ties, jumps and gaps, short ones, and one without a value."""
    rnd = random.Random(seed)
    draw = {"a": lambda i: None, "b": lambda i: rnd.choice([None, 0.0, 0.0, rnd.gauss(0, 1)]), "c": lambda i: float(i),
            "d": lambda i: -float(i), "e": lambda i: float("nan") if i % 3 else rnd.gauss(i, 50), "f": lambda i: 1.0}
    sizes = {"a": 9, "b": 400, "c": 120, "d": 120, "e": 90, "f": 70, "g": 1}
    rows = [(s, draw.get(s, lambda i: 5.0)(i)) for s in sizes for i in range(sizes[s])]
    return [(s, p, v) for p, (s, v) in enumerate(rows)]


def expected(rows, q):
    out, seen, symbol = {}, [], None
    for s, p, v in rows:
        if s != symbol:
            seen, symbol = [], s
        if v is not None and v == v:
            seen.append(v)
        out[p] = float(np.quantile(seen, q)) if seen else None
    return out


@pytest.mark.parametrize("q", [0.0, 0.3, 0.5, 1.0])
@pytest.mark.parametrize("block_rows", [7, 64, 100_000])
def test_running_quantile_equals_sorting_every_prefix(spark, q, block_rows):
    rows = series()
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), SCHEMA).repartition(5)
    saved = running_quantile(df, q, block_rows=block_rows)
    got = {r["pos"]: r["quantile"] for r in saved.df.collect()}
    exp = expected(rows, q)
    assert got.keys() == exp.keys()
    for p, x in exp.items():
        assert (got[p] is None) == (x is None), p
        assert x is None or math.isclose(got[p], x, rel_tol=1e-12, abs_tol=1e-12), (p, got[p], x)
    assert saved.drop()


def test_empty_table(spark):
    assert running_quantile(spark.createDataFrame([], SCHEMA), 0.5).df.count() == 0


def test_no_task_meets_more_than_a_block_and_its_slice(spark):
    """The rows handed to one block: its own, and at most 2 B + 4 earlier values."""
    from candlewick.operators.running import _slices, _with_slice_ranks
    from candlewick.plans.prefix import running_offsets

    size = 50
    rnd = random.Random(5)
    rows = [("x", i, rnd.choice([0.0, rnd.gauss(0, 1)])) for i in range(3000)]
    src = spark.createDataFrame(rows, "_g string, _pos long, _v double").withColumn("_t", F.expr(f"_pos div {size}"))
    tallies = src.groupBy("_g", "_t", "_v").agg(F.count(F.lit(1)).alias("_c"))
    ranks = running_offsets(tallies.groupBy("_g", "_v").agg(F.sum("_c").alias("_c")), ["_g", "_v"], "_c", "_off").df
    cells = tallies.join(ranks.select("_g", "_v", F.expr(f"_off div {size}").alias("_b")), ["_g", "_v"])
    most = _slices(_with_slice_ranks(src, 0.5), cells).groupBy("_t").agg(F.sum("_n").alias("n")).agg(F.max("n")).first()[0]
    assert 0 < most <= 2 * size + 4


@pytest.mark.parametrize("segment,block_rows,horizon", [(None, 8192, 1), ("month", 11, 3), ("year", 40, 2)])
def test_forecasts_equal_the_growing_window(spark, segment, block_rows, horizon):
    bars = bars_from_orders(spark, SF)
    want = {(r["symbol"], r["date"]): r for r in M.quantile_forecast_rows(bars, horizon, quantile=0.4, min_context=25, keep=["volume"]).collect()}
    got = running_forecast_rows(bars, horizon, 0.4, 25, segment=segment, keep=["volume"], block_rows=block_rows)
    assert got.columns == ["symbol", "date", "volume", "last_price", "accepted", "pred_price", "pred_return"]
    rows = got.collect()
    assert len(rows) == len(want)
    for r in rows:
        w = want[(r["symbol"], r["date"])]
        assert (r["accepted"], r["last_price"], r["volume"]) == (w["accepted"], w["last_price"], w["volume"])
        assert (r["pred_price"] is None) == (w["pred_price"] is None)
        if w["pred_price"] is not None:
            assert math.isclose(r["pred_price"], w["pred_price"], rel_tol=1e-12)
            assert math.isclose(r["pred_return"], w["pred_return"], rel_tol=1e-9, abs_tol=1e-12)
