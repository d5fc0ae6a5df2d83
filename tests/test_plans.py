"""Plan-shape tests: the scale decisions stay in the physical plans."""

import re

from pyspark.sql import functions as F

from strata_testing import T
from strata.functions.expr import ts_literal
from strata.operators import dedupe
from strata.operators.merge import merge_upsert
from strata.plans import gold


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _big_target(spark, n=200_000):
    return spark.range(n).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("v"))


def test_small_insert_ignore_never_shuffles_the_target(spark):
    target = _big_target(spark)
    batch = spark.createDataFrame([("5", 1), ("x", 2)], "k string, v long")
    delta = dedupe.insert_ignore(target, batch, ["k"], ["v"])
    plan = _plan(delta)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert [r.k for r in delta.collect()] == ["x"]


def test_small_upsert_splits_target_with_broadcast_keys(spark):
    target = _big_target(spark).withColumn("last_updated", F.lit(T("2024-01-01")).cast("timestamp_ntz"))
    batch = spark.createDataFrame([("5", 99), ("new", 1)], "k string, v long")
    out = merge_upsert(target, batch, ["k"], {"v": "replace"}, ts_literal(T("2024-02-01")))
    plan = _plan(out)
    assert re.search(r"BroadcastHashJoin [^\n]*LeftAnti", plan) and re.search(r"BroadcastHashJoin [^\n]*LeftSemi", plan)
    assert out.count() == 200_001
    assert out.filter("k = '5'").collect()[0].v == 99


def test_large_upsert_falls_back_to_one_full_outer_join(spark):
    target = _big_target(spark, 1000).withColumn("last_updated", F.lit(None).cast("timestamp_ntz"))
    batch = _big_target(spark, 1000)
    out = merge_upsert(target, batch, ["k"], {"v": "replace"}, ts_literal(T("2024-02-01")), broadcast_max_keys=10)
    assert "FullOuter" in _plan(out)


def test_facts_are_aggregated_before_the_client_join(spark):
    trades = spark.range(5000).select(F.lit("hot").alias("client_id"),
                                      F.timestamp_add("HOUR", F.col("id"), ts_literal("2024-01-01 00:00:00"))
                                      .alias("trade_time"),
                                      F.lit(1).cast("decimal(18,8)").alias("trade_volume"))
    clients = spark.createDataFrame([("hot", "1")], "client_id string, affiliate_id string")
    df = gold.daily_trades(trades, clients)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    join_at = plan.index("Join Inner")
    assert "Aggregate" in plan[join_at:]          # an aggregate sits below the join
    assert df.agg(F.sum("total_trades")).collect()[0][0] == 5000
