"""Dedupe, insert-ignore and upsert operators on literal frames."""

from decimal import Decimal

from pyspark.sql import functions as F

from strata_testing import T
from strata.functions.expr import ts_literal
from strata.operators import dedupe
from strata.operators.merge import UpsertRule, merge_upsert

SCHEMA_C = "client_id string, affiliate_id string, register_time timestamp_ntz"


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_keep_latest_picks_latest_with_tiebreak(spark):
    df = spark.createDataFrame([
        ("1", "a", T("2024-01-01")), ("1", "b", T("2024-02-01")), ("1", "a", T("2024-02-01")),
        ("2", "c", T("2023-01-01")),
    ], SCHEMA_C)
    out = dedupe.keep_latest(df, ["client_id"], [F.col("register_time").desc_nulls_first(),
                                                 F.col("affiliate_id").asc()])
    assert rows(out, "client_id") == [("1", "a", T("2024-02-01")), ("2", "c", T("2023-01-01"))]


def test_keep_latest_desc_nulls_first_like_postgres(spark):
    df = spark.createDataFrame([("1", "a", T("2024-01-01")), ("1", "b", None)], SCHEMA_C)
    out = dedupe.keep_latest(df, ["client_id"], [F.col("register_time").desc_nulls_first()])
    assert rows(out, "client_id") == [("1", "b", None)]


def test_keep_latest_hot_key_is_reduced_before_shuffle(spark):
    df = spark.range(0, 5000).select((F.col("id") % 2).cast("string").alias("client_id"),
                                     F.lit("x").alias("affiliate_id"),
                                     F.timestamp_seconds("id").cast("timestamp_ntz").alias("register_time"))
    out = dedupe.keep_latest(df, ["client_id"], [F.col("register_time").desc()])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert out.count() == 2


def test_insert_ignore_first_wins_and_null_keys_rejected(spark):
    target = spark.createDataFrame([("o1", 1)], "order_id string, v int")
    incoming = spark.createDataFrame([("o1", 9), ("o2", 3), ("o2", 2), (None, 5)], "order_id string, v int")
    delta = dedupe.insert_ignore(target, incoming, ["order_id"], [F.col("v").asc()])
    assert rows(delta, "order_id") == [("o2", 2)]


def test_insert_ignore_is_idempotent(spark):
    incoming = spark.createDataFrame([("o1", 1), ("o2", 2)], "order_id string, v int")
    empty = incoming.limit(0)
    first = dedupe.insert_ignore(empty, incoming, ["order_id"], ["v"])
    table = empty.unionByName(first)
    again = dedupe.insert_ignore(table, incoming, ["order_id"], ["v"])
    assert again.count() == 0


def test_new_keys_and_union_keys(spark):
    a = spark.createDataFrame([("1",), ("2",)], "client_id string")
    b = spark.createDataFrame([("2",), ("3",)], "client_id string")
    assert rows(dedupe.new_keys(b, a, ["client_id"]), "client_id") == [("3",)]
    assert rows(dedupe.union_keys(a, b, keys=["client_id"]), "client_id") == [("1",), ("2",), ("3",)]


def _clients(spark, data):
    return spark.createDataFrame(data, SCHEMA_C + ", last_updated timestamp_ntz")


def test_merge_upsert_rules(spark):
    t0, t1 = T("2024-01-01"), T("2024-06-01")
    target = _clients(spark, [("1", "a", T("2020-01-01"), t0), ("2", "b", T("2021-01-01"), t0)])
    source = spark.createDataFrame([("1", "z", T("2022-01-01")), ("3", "c", T("2023-01-01"))], SCHEMA_C)
    out = merge_upsert(target, source, ["client_id"],
                       {"affiliate_id": UpsertRule.REPLACE, "register_time": UpsertRule.LEAST}, ts_literal(t1))
    assert rows(out, "client_id") == [
        ("1", "z", T("2020-01-01"), t1),   # replace + LEAST keeps the older time
        ("2", "b", T("2021-01-01"), t0),   # untouched keeps its stamp
        ("3", "c", T("2023-01-01"), t1),   # inserted
    ]


def test_merge_upsert_is_idempotent(spark):
    t1 = T("2024-06-01")
    target = _clients(spark, [("1", "a", T("2020-01-01"), T("2024-01-01"))])
    source = spark.createDataFrame([("1", "b", T("2019-01-01")), ("2", "c", T("2023-01-01"))], SCHEMA_C)
    rules = {"affiliate_id": "replace", "register_time": "least"}
    once = merge_upsert(target, source, ["client_id"], rules, ts_literal(t1))
    twice = merge_upsert(once, source, ["client_id"], rules, ts_literal(t1))
    assert rows(once, "client_id") == rows(twice, "client_id")


def test_merge_upsert_composite_key_and_types(spark):
    s = "client_id string, trade_time timestamp_ntz, trade_volume decimal(18,8), last_updated timestamp_ntz"
    target = spark.createDataFrame([("1", T("2024-01-01"), Decimal("1.5"), T("2024-01-02"))], s)
    source = spark.createDataFrame([("1", T("2024-01-01"), Decimal("2.5")), ("1", T("2024-01-03"), Decimal("3"))],
                                   "client_id string, trade_time timestamp_ntz, trade_volume decimal(20,8)")
    out = merge_upsert(target, source, ["client_id", "trade_time"], {"trade_volume": "replace"},
                       ts_literal(T("2024-02-01")))
    assert out.schema == target.schema
    assert [r.trade_volume for r in out.orderBy("trade_time").collect()] == [Decimal("2.5"), Decimal("3")]
