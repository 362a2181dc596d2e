"""Physical-plan properties: pushdown, pruning, partial aggregation, exchange count."""


from candlewick.operators import features as feat
from candlewick.sources import bars as src

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_universe_filter_reaches_the_scan(spark, tmp_path):
    src.bars_from_orders(spark, SF).write.parquet(str(tmp_path / "bars"))
    df = src.load_bars(spark, str(tmp_path / "bars"), universe=["1-URGENT", "5-LOW"])
    plan = plan_of(df)
    assert "PushedFilters: [IsNotNull(symbol), In(symbol" in plan or "In(symbol, [1-URGENT,5-LOW])" in plan
    assert df.select("symbol").distinct().count() == 2


def test_universe_filter_pushes_through_the_bar_aggregate(spark):
    df = src.filter_universe(src.bars_from_orders(spark, SF), ["1-URGENT"])
    plan = plan_of(df)
    assert "In(o_orderpriority" in plan or "EqualTo(o_orderpriority" in plan


def test_bar_adapter_prunes_columns_and_aggregates_partially(spark):
    plan = plan_of(src.bars_from_orders(spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>" in plan
    assert "partial_" in plan


def test_unsplit_features_use_one_exchange(spark, tmp_path):
    src.bars_from_orders(spark, SF).write.parquet(str(tmp_path / "b"))
    bars = spark.read.parquet(str(tmp_path / "b"))
    df = feat.tabular_features(bars, horizon=1, segment=None)
    df.write.format("noop").mode("overwrite").save()
    plan = plan_of(df)
    assert plan.count("Exchange hashpartitioning") == 1


def test_row_order_and_partition_count_do_not_change_results(spark):
    bars = src.bars_from_orders(spark, SF)
    base = sorted(feat.tabular_features(bars, horizon=1).collect())
    shuffled = bars.orderBy((bars.volume * 7919) % 101).repartition(13)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        other = sorted(feat.tabular_features(shuffled, horizon=1, segment="month").collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert base == other


def test_training_rank_reuses_the_feature_sort(spark, tmp_path):
    from pyspark.sql import functions as F

    from candlewick.operators.guards import drop_incomplete

    src.bars_from_orders(spark, SF).write.parquet(str(tmp_path / "b"))
    bars = spark.read.parquet(str(tmp_path / "b"))
    f = feat.tabular_features(bars, horizon=1, segment=None, keep_internal=True)
    rows = drop_incomplete(f, feat.model_feature_names(f), "target")
    ranked = rows.withColumn("_rn", F.row_number().over(feat.series_window("symbol", ["date", "_tb"])))
    ranked.write.format("noop").mode("overwrite").save()
    plan = plan_of(ranked)
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1 and plan.count("Window [") == 3
