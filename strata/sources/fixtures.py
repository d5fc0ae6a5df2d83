"""Driver tables -> bronze-shaped DataFrames.

The test data is a TPC-H-like star schema; each bronze table of the domain
is a projection of one driver table (``FIXTURES.md`` section 3).  Every
projection is narrow (no shuffle) except deposits, which needs the order's
customer and joins lineitem to orders on the order key.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.expr import ts_literal

# Clocks of the fixtures, number of affiliates the trade,
# deposit and asset rows are spread over, and the coin of each return flag.
AS_OF = dt.date(2001, 8, 1)
EVENTS_AS_OF = dt.date(2024, 1, 31)
LOAD_TIME = dt.datetime(2001, 8, 1, 0, 0, 0)
AFFILIATE_SPREAD = 25
COIN_BY_FLAG = {"A": "USDT", "N": "BTC", "R": "ETH"}
REGISTER_BASE = "1995-01-01 00:00:00"
REGISTER_STEP_DAYS = 7
REGISTER_SPAN_DAYS = 2400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lineage(source: str, load_time=LOAD_TIME):
    return [F.lit(source).alias("source_file"), ts_literal(load_time).alias("load_time"),
            F.lit("SUCCESS").alias("load_status")]


def _spread(key_col: str):
    return (F.col(key_col) % AFFILIATE_SPREAD).cast("string")


def customers(spark: SparkSession, sf_dir: str, lineage: bool = True) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    reg = F.timestamp_add("DAY", ((F.col("c_custkey") * REGISTER_STEP_DAYS) % REGISTER_SPAN_DAYS).cast("int"),
                          ts_literal(REGISTER_BASE))
    cols = [F.col("c_nationkey").cast("string").alias("affiliate_id"),
            F.col("c_custkey").cast("string").alias("client_id"),
            reg.alias("register_time")]
    return c.select(*cols, *(_lineage("customer.parquet") if lineage else []))


def customers_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second customer feed: every order re-announces its client, under the
    affiliate the order is spread to, registered at the order date."""
    o = table(spark, sf_dir, "orders")
    return o.select(_spread("o_custkey").alias("affiliate_id"),
                    F.col("o_custkey").cast("string").alias("client_id"),
                    F.col("o_orderdate").alias("register_time"),
                    *_lineage("orders.parquet"))


def customers_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third customer feed: every event announces its user, registered at the event's time.
    Only a part of the customers has events."""
    e = table(spark, sf_dir, "events")
    return e.select(_spread("user_id").alias("affiliate_id"), F.col("user_id").cast("string").alias("client_id"),
                    F.col("ts").alias("register_time"), *_lineage("events.parquet", EVENTS_AS_OF))


def trades(spark: SparkSession, sf_dir: str, lineage: bool = True) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    cols = [_spread("o_custkey").alias("affiliate_id"),
            F.col("o_custkey").cast("string").alias("client_id"),
            F.col("o_totalprice").cast("decimal(20,8)").alias("trade_volume"),
            F.col("o_orderdate").alias("trade_time")]
    return o.select(*cols, *(_lineage("orders.parquet") if lineage else []))


def deposits(spark: SparkSession, sf_dir: str, lineage: bool = True) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate",
                                                 "l_returnflag", "l_extendedprice")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    coin = F.lit(None).cast("string")
    for flag, name in reversed(list(COIN_BY_FLAG.items())):
        coin = F.when(F.col("l_returnflag") == flag, F.lit(name)).otherwise(coin)
    cols = [F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("order_id"),
            _spread("o_custkey").alias("affiliate_id"),
            F.col("o_custkey").cast("string").alias("client_id"),
            F.col("l_shipdate").alias("deposit_time"),
            coin.alias("deposit_coin"),
            F.col("l_extendedprice").cast("decimal(20,8)").alias("deposit_amount")]
    return j.select(*cols, *(_lineage("lineitem.parquet") if lineage else []))


def assets(spark: SparkSession, sf_dir: str, lineage: bool = True) -> DataFrame:
    e = table(spark, sf_dir, "events")
    cols = [_spread("user_id").alias("affiliate_id"),
            F.col("user_id").cast("string").alias("client_id"),
            F.col("value").cast("decimal(20,8)").alias("balance"),
            F.col("ts").alias("update_time"),
            F.col("event_type").alias("remark")]
    return e.select(*cols, *(_lineage("events.parquet", EVENTS_AS_OF) if lineage else []))


def documents_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL-bearing input for quality checks: documents LEFT JOIN labels."""
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, on="doc_id", how="left")
