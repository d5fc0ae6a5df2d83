"""Structured Streaming: batch equality, exactly-once file pickup, dedupe."""

from decimal import Decimal

from pyspark.sql import functions as F

from strata_testing import SF_SMALL, T
from strata.plans import gold
from strata.sources import fixtures as fx
from strata.sources import pages
from strata.streaming import ingest


def test_stream_daily_totals_equal_batch_view(spark):
    streamed = ingest.q_stream_daily_trades(spark, SF_SMALL)
    e = fx.table(spark, SF_SMALL, "events")
    clients = e.select(F.col("user_id").cast("string").alias("client_id"), F.lit("1").alias("affiliate_id"),
                       F.col("ts").alias("register_time")).distinct()
    trades = e.select(F.col("user_id").cast("string").alias("client_id"), F.col("ts").alias("trade_time"),
                      F.col("value").cast("decimal(18,8)").alias("trade_volume"))
    batch = gold.daily_trades(trades, clients.dropDuplicates(["client_id"])).drop("affiliate_id")
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_ingest_pages_reads_each_file_once(spark, tmp_path):
    rows = spark.createDataFrame([("1", "u1", Decimal("1"), T("2024-01-01"), "view")],
                                 "affiliate_id string, client_id string, balance decimal(20,8), "
                                 "update_time timestamp_ntz, remark string")
    landing, target, ckpt = str(tmp_path / "l"), str(tmp_path / "t"), str(tmp_path / "c")
    pages.write_landing(rows, landing, "assets")
    ingest.ingest_pages(spark, landing, "assets", target, ckpt)
    ingest.ingest_pages(spark, landing, "assets", target, ckpt)       # nothing new
    assert spark.read.parquet(target).count() == 1
    more = rows.withColumn("client_id", F.lit("u2"))
    pages.write_landing(more, landing, "assets")
    ingest.ingest_pages(spark, landing, "assets", target, ckpt)
    assert sorted(r.client_id for r in spark.read.parquet(target).collect()) == ["u1", "u2"]


def test_ingest_pages_insert_ignore_on_key(spark, tmp_path):
    s = ("affiliate_id string, order_id string, client_id string, deposit_time timestamp_ntz, "
         "deposit_coin string, deposit_amount decimal(20,8)")
    a = spark.createDataFrame([("1", "o1", "c1", T("2024-01-01"), "BTC", Decimal("1"))], s)
    landing, target, ckpt = str(tmp_path / "l"), str(tmp_path / "t"), str(tmp_path / "c")
    pages.write_landing(a, landing, "deposits")
    ingest.ingest_pages(spark, landing, "deposits", target, ckpt, keys=["order_id"], arrival_order=["deposit_time"])
    pages.write_landing(a.withColumn("deposit_amount", F.lit(Decimal("9")).cast("decimal(20,8)")), landing, "deposits")
    ingest.ingest_pages(spark, landing, "deposits", target, ckpt, keys=["order_id"], arrival_order=["deposit_time"])
    got = spark.read.parquet(target).collect()
    assert len(got) == 1 and got[0].deposit_amount == Decimal("1")      # first write wins


def test_stream_dedupe_drops_redelivered_rows(spark):
    out = ingest.q_stream_trades_dedup(spark, SF_SMALL)
    e = fx.table(spark, SF_SMALL, "events")
    assert out.count() == e.count()
    assert out.select("client_id", "trade_time").distinct().count() == out.count()


def test_instant_conversions_are_inverse(spark):
    df = spark.createDataFrame([(T("2024-03-31 01:30:00.123456"),)], "ts timestamp_ntz")
    back = df.select(ingest.to_wall(ingest.to_instant("ts")).alias("x")).collect()[0].x
    assert back == T("2024-03-31 01:30:00.123456")


def test_upsert_stream_keeps_latest_and_replaces(spark, tmp_path):
    from strata.sources.catalog import PartitionedTable
    schema = "client_id string, trade_time timestamp_ntz, trade_volume decimal(18,8)"
    landing, ckpt = str(tmp_path / "l"), str(tmp_path / "c")
    table = PartitionedTable(spark, str(tmp_path / "t"), ["client_id", "trade_time"], "trade_month",
                             lambda: F.date_format("trade_time", "yyyy-MM"))
    order = [F.col("trade_volume").desc()]
    stamp = F.lit(T("2024-02-01")).cast("timestamp_ntz")

    def run():
        src = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(landing)
        ingest.upsert_stream(src, table, ["client_id", "trade_time"], order, {"trade_volume": "replace"}, stamp, ckpt)

    spark.createDataFrame([("1", T("2024-01-01"), Decimal("1")), ("2", T("2024-01-02"), Decimal("2"))],
                          schema).write.parquet(landing + "/d=1")
    run()
    spark.createDataFrame([("1", T("2024-01-01"), Decimal("5")), ("1", T("2024-01-01"), Decimal("3"))],
                          schema).write.parquet(landing + "/d=2")
    run()
    got = {r.client_id: r.trade_volume for r in table.read().collect()}
    assert got == {"1": Decimal("5"), "2": Decimal("2")}
