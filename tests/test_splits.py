"""Positions, walk-forward folds, holdout, date folds, distributed prefix sums."""

import pytest
from pyspark.sql import functions as F

from candlewick.operators import splits
from candlewick.plans.prefix import running_offsets

from helpers import bar


def expected_folds(n, k):
    t = n // (k + 1)
    return [(list(range(0, n - (k - i) * t)), list(range(n - (k - i) * t, n - (k - i - 1) * t))) for i in range(k)]


@pytest.mark.parametrize("n,k", [(60, 5), (61, 5), (100, 2), (7, 2)])
def test_fold_bounds(spark, n, k):
    df = spark.range(n).withColumnRenamed("id", "pos")
    plan = splits.fold_plan(n, k)
    for i, (tr, te) in enumerate(expected_folds(n, k)):
        assert sorted(r.pos for r in splits.fold_train(df, plan, i).collect()) == tr
        assert sorted(r.pos for r in splits.fold_test(df, plan, i).collect()) == te
    labelled, _ = splits.walk_forward_folds(df, n, k)
    for r in labelled.collect():
        te = [i for i, (_, t) in enumerate(expected_folds(n, k)) if r.pos in t]
        assert r.fold == (te[0] if te else None)


def test_one_split_is_raised_to_two():
    assert splits.fold_plan(100, 1).k == 2


def test_too_few_rows_for_folds():
    with pytest.raises(ValueError):
        splits.fold_plan(2, 5)


def test_holdout_cut():
    assert splits.holdout_cut(8568) == int(8568 * 0.8)


def test_global_position_dense_and_ordered(spark, make_bars):
    rows = [bar(s, i * 13, 100.0 + i) for s in ("B", "A", "C") for i in range(90)]
    for seg in (None, "year", "month"):
        p = splits.global_position(make_bars(rows), segment=seg)
        got = p.df.orderBy("pos").select("symbol", "date", "pos").collect()
        assert p.n == len(rows) and [r.pos for r in got] == list(range(len(rows)))
        assert [(r.symbol, r.date) for r in got] == sorted((r.symbol, r.date) for r in got)


def test_running_offsets_do_not_depend_on_the_pieces(spark):
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 7 + 1).alias("w"))
    one, six = (running_offsets(df, ["k"], "w", "o", pieces=n) for n in (1, 6))
    exp, acc = {}, 0
    for k in range(500):
        exp[k] = acc
        acc += k % 7 + 1
    for got in (one, six):
        assert {r.k: r.o for r in got.df.collect()} == exp and got.total == acc
    assert running_offsets(df.where("false"), ["k"], "w", "o").total == 0


def test_date_folds_never_split_a_date(spark, make_bars):
    rows = [bar(s, i, 100.0 + i) for s in ("A", "B", "C") for i in range(60)]
    df, plan = splits.date_folds(make_bars(rows), 5)
    per_date = df.groupBy("date").agg(F.countDistinct("fold").alias("f"), F.countDistinct("is_train").alias("t"))
    assert per_date.where("f > 1 OR t > 1").count() == 0
    # training rows of fold i all come before fold i's first date
    for i in range(plan.k):
        first = df.where(F.col("fold") == i).agg(F.min("date")).first()[0]
        assert df.where(F.col("dpos") < plan.test_start(i)).where(F.col("date") >= first).count() == 0


def test_training_rows_release_deletes_the_table(spark):
    import os

    from candlewick.operators.train import training_rows
    from candlewick.sources.bars import bars_from_orders

    rows = training_rows(bars_from_orders(spark, "/root/testdata/sf0.001"))
    path = rows.stored.path.replace("file:", "")
    assert os.path.isdir(path)
    rows.release()
    assert not os.path.exists(path)
