"""Bar store: rows, plans without exchange, skipped years and buckets, appends."""

import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F

from candlewick.operators import features as feat
from candlewick.sources import bars as src
from candlewick.sources.store import BUCKETS, YEAR, read_bar_store, write_bar_store
from helpers import bar

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def table(spark, tmp_path):
    name = f"bars_{uuid.uuid4().hex}"
    yield name, str(tmp_path / "store")
    spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.fixture
def store(spark, table):
    bars = src.bars_from_orders(spark, SF)
    write_bar_store(bars, table[0], buckets=8, path=table[1])
    return bars, table[0]


def rows_of(df):
    return sorted(map(repr, df.collect()))


def test_rows_come_back(spark, store):
    bars, name = store
    back = read_bar_store(spark, name)
    assert back.columns == bars.columns and rows_of(back) == rows_of(src.prepare_bars(bars))


@pytest.mark.parametrize("segment", [None, "year"])
def test_features_equal_those_of_plain_bars(spark, store, segment):
    bars, name = store
    got = feat.tabular_features(read_bar_store(spark, name), horizon=1, segment=segment)
    exp = feat.tabular_features(bars, horizon=1, segment=segment)
    assert rows_of(got.select(exp.columns)) == rows_of(exp)


def test_unsplit_features_need_no_exchange(spark, store):
    df = feat.tabular_features(read_bar_store(spark, store[1]), horizon=1, segment=None)
    df.write.format("noop").mode("overwrite").save()
    plan = plan_of(df)
    assert "Exchange" not in plan and "Window" in plan
    assert "SelectedBucketsCount: 8 out of 8" in plan


def test_a_date_bound_skips_years(spark, store):
    bars, name = store
    first, last = dt.date(1996, 6, 1), dt.date(1997, 2, 28)
    df = read_bar_store(spark, name, since=first, until=last)
    assert rows_of(df) == rows_of(src.prepare_bars(bars).where(F.col("date").between(first, last)))
    assert re.search(rf"PartitionFilters: \[[^\]]*{YEAR}#\d+ >= 1996", plan_of(df))
    used = df.select(F.input_file_name().alias("f")).distinct().collect()
    assert {r["f"].split(f"{YEAR}=")[1][:4] for r in used} == {"1996", "1997"}


def test_a_universe_reads_its_buckets_only(spark, store):
    df = read_bar_store(spark, store[1], universe=["1-URGENT"])
    assert "SelectedBucketsCount: 1 out of 8" in plan_of(df.groupBy("symbol").count())
    assert [r["symbol"] for r in df.select("symbol").distinct().collect()] == ["1-URGENT"]


def test_one_file_for_a_year_and_bucket(spark, store):
    files = spark.table(store[1]).select(F.input_file_name().alias("f")).distinct().collect()
    places = [(r["f"].split(f"{YEAR}=")[1][:4], re.search(r"_(\d{5})\.", r["f"]).group(1)) for r in files]
    assert len(places) == len(set(places))


def test_appended_days_join_their_series(spark, table, make_bars):
    old = make_bars([bar(s, i, 10 + i) for s in "ab" for i in range(20)])
    new = make_bars([bar(s, i, 10 + i) for s in "ab" for i in range(20, 40)])
    write_bar_store(old, table[0], buckets=4, path=table[1])
    write_bar_store(new, table[0], buckets=4, mode="append")
    df = feat.tabular_features(read_bar_store(spark, table[0]), segment=None)
    assert "Exchange" not in plan_of(df)
    assert rows_of(df) == rows_of(feat.tabular_features(old.unionByName(new), segment=None).select(df.columns))


def test_keyless_repeated_and_infinite_rows(spark, table, make_bars):
    good = bar("a", 1, 5)
    rows = [good, good, (None, *good[1:]), ("a", None, *good[2:]), (*good[:2], float("inf"), *good[3:])]
    write_bar_store(make_bars(rows).withColumn("note", F.lit("x")), table[0], path=table[1])
    back = read_bar_store(spark, table[0])
    assert back.count() == 3 and back.where("open is null").count() == 1 and "note" in back.columns
    assert spark.table(table[0]).columns[-1] == YEAR and BUCKETS > 1


def test_empty_store_and_clashing_column(spark, table, make_bars):
    write_bar_store(make_bars([]), table[0], path=table[1])
    assert read_bar_store(spark, table[0], since=dt.date(2020, 1, 1)).count() == 0
    with pytest.raises(ValueError, match=YEAR):
        write_bar_store(make_bars([]).withColumn(YEAR, F.lit(1)), table[0] + "_x")
