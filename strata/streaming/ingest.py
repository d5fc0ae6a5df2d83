"""Incremental ingestion with Structured Streaming.

The upstream system keeps hand-made state (a last-timestamp file per
affiliate and endpoint, a seen-uid set).  Here that state is a streaming
checkpoint: a file source remembers which files it has processed, so a
second ``availableNow`` run over the same checkpoint reads nothing new, and
progress is committed only after the sink write succeeded.

* :func:`ingest_pages`       landing pages -> bronze rows, bad records, bad pages (append / insert-ignore)
* :func:`ingest_new_keys`    stream of records -> key table, only unseen keys
* :func:`dedupe_stream`      drop re-delivered rows within a watermark
* :func:`split_late`         the same, with repeats and late rows counted and late rows kept apart
* :func:`daily_totals`       tumbling one-day window aggregate
* :func:`daily_by_affiliate` daily trade metrics by affiliate, upserted as they change

Sinks are replay-safe: a micro-batch is written under its query and batch
number and read through the list of committed batches (:mod:`strata.sources.batches`).

Stream event time must be ``timestamp`` (with zone) for watermarks; the
batch side uses ``timestamp_ntz``.  :func:`to_instant` / :func:`to_wall`
convert without depending on the session time zone (UTC wall clock).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.functions.expr import EPOCH_NTZ, trunc_ntz, ts_literal
from strata.operators.dedupe import insert_ignore
from strata.schemas import ARRIVAL, ENDPOINT_TABLES, ENVELOPES, KEYS, SILVER
from strata.session import work_dir
from strata.sources import fixtures as fx
from strata.sources import pages
from strata.sources.batches import BatchTable, checkpoint_id
from strata.sources.bronze import BronzeTable
from strata.sources.catalog import PartitionedTable


def to_instant(c) -> Column:
    """timestamp_ntz (UTC wall clock) -> timestamp, zone independent."""
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), c))


def to_wall(c) -> Column:
    """timestamp -> timestamp_ntz (UTC wall clock), zone independent."""
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.expr(EPOCH_NTZ))


def _run(writer, checkpoint: str) -> None:
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def ingest_table(spark: SparkSession, target: str, endpoint: str, keys: Sequence[str] = (), arrival_order: Sequence = ()) -> BronzeTable:
    """The table that :func:`ingest_pages` fills."""
    return BronzeTable(spark, target, ENDPOINT_TABLES[endpoint], keys, [F.col(c).asc() if isinstance(c, str) else c for c in arrival_order])


def ingested(spark: SparkSession, target: str, endpoint: str, kind: str = pages.ROW) -> DataFrame:
    """What :func:`ingest_pages` has committed of one kind: rows, bad records or bad pages."""
    return ingest_table(spark, target, endpoint).lines(kind)


def page_stream(spark: SparkSession, landing: str, endpoint: str) -> DataFrame:
    """New landing pages of one endpoint; only its folders are listed.  Lines that are no page stand in the corrupt column."""
    schema = T.StructType(list(ENVELOPES[endpoint].fields) + [T.StructField(pages.CORRUPT, T.StringType()),
                          T.StructField("affiliate_id", T.StringType()), T.StructField("endpoint", T.StringType()),
                          T.StructField("dt", T.DateType())])
    return (spark.readStream.schema(schema).option("basePath", landing).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", pages.CORRUPT).json(f"{landing.rstrip('/')}/affiliate_id=*/endpoint={endpoint}")
            .withColumn("source_file", F.col("_metadata.file_path")))


def ingest_pages(spark: SparkSession, landing: str, endpoint: str, target: str, checkpoint: str,
                 keys: Sequence[str] = (), arrival_order: Sequence = (), load_time=None) -> None:
    """Incrementally load new landing files of ``endpoint`` (hive layout) into the batch table ``target``.

    A micro-batch is parsed once and split into bronze rows, bad records and
    bad pages, each in a folder of its own; the counts of all three are taken
    while writing and committed with them.  The batch is keyed by the
    checkpoint's query and Spark's batch number, so a replay replaces it.
    With ``keys`` only the first row of a key is kept: first in the batch by
    ``arrival_order``, and not in any batch before.
    """
    lines = pages.classified(page_stream(spark, landing, endpoint), endpoint, load_time)
    table = ingest_table(spark, target, endpoint, keys, arrival_order)

    def sink(batch: DataFrame, batch_id: int) -> None:
        table.load(batch, checkpoint_id(spark, checkpoint), batch_id)

    _run(lines.writeStream.foreachBatch(sink), checkpoint)


def ingest_all_endpoints(spark: SparkSession, landing: str, root: str, load_time=None) -> None:
    """One incremental query per endpoint (all affiliates at once), each with
    its own checkpoint, into ``root/bronze/<table>``; keyed tables are
    insert-ignored per micro-batch."""
    for endpoint, name in ENDPOINT_TABLES.items():
        ingest_pages(spark, landing, endpoint, f"{root}/bronze/{name}", f"{root}/_checkpoints/{name}",
                     keys=KEYS[name], arrival_order=[F.col(c).asc() for c in ARRIVAL.get(name, [])],
                     load_time=load_time)


def ingest_new_keys(stream: DataFrame, keys: Sequence[str], event_time: str, key_table: str,
                    checkpoint: str) -> None:
    """Append to ``key_table`` the keys not seen before, with the time they
    were first seen (earliest event of the key in its first micro-batch)."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        firsts = batch.groupBy(*keys).agg(F.min(event_time).alias("first_seen"))
        seen = spark.read.parquet(key_table).select(*keys)
        # Small batches probe the (large) key table with broadcast batch keys.
        new = insert_ignore(seen, firsts, keys, [F.col("first_seen").asc()])
        new.write.mode("append").parquet(key_table)

    _run(stream.writeStream.foreachBatch(sink), checkpoint)


def upsert_stream(stream: DataFrame, table, keys: Sequence[str], order_by: Sequence, rules=None,
                  now=None, checkpoint: str | None = None) -> None:
    """Keep-latest streaming upsert: each micro-batch is reduced to its
    latest row per key and merged into ``table`` (a PartitionedTable or
    SnapshotTable) with the per-column ``rules``; only the partitions a
    batch touches are rewritten.  Replays of a batch are idempotent."""
    from strata.operators.dedupe import keep_latest

    def sink(batch: DataFrame, batch_id: int) -> None:
        latest = keep_latest(batch, keys, order_by)
        table.upsert(latest, rules, now)

    _run(stream.writeStream.foreachBatch(sink), checkpoint)


def dedupe_stream(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Drop rows whose key was already seen within ``delay`` of event time
    (state is bounded by the watermark)."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def daily_totals(stream: DataFrame, event_time: str, value: str) -> DataFrame:
    """Tumbling one-day totals: date, total_trades, total_volume."""
    return (stream.groupBy(F.window(event_time, "1 day").alias("w"))
            .agg(F.count(F.lit(1)).alias("total_trades"),
                 F.sum(value).cast("decimal(28,8)").alias("total_volume"))
            .select(to_wall(F.col("w.start")).alias("date"), "total_trades", "total_volume"))


def split_table(spark: SparkSession, root: str, schema: T.StructType) -> BatchTable:
    """The table of :func:`split_late`: the stream's columns and ``kind`` (row, duplicate, late)."""
    return BatchTable(spark, root, T.StructType([*schema.fields, T.StructField("kind", T.StringType())]), partition_by=("kind",))


def split_late(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str, root: str, checkpoint: str) -> BatchTable:
    """Keep one row per key, and every other row where it can be counted.

    The watermark is the greatest event time of the batches before, less
    ``delay``, and is committed with each batch.  A row behind it is ``late``: it
    goes to a folder of its own instead of being dropped without a trace.  Of the
    others, the first of its key is a ``row`` and the rest are ``duplicate``.  A key can
    only repeat in front of the watermark, so no older kept row is looked at.
    Rows without an event time are late.  The kinds add up to the input.
    """
    spark, columns = stream.sparkSession, stream.columns
    table = split_table(spark, root, stream.schema)

    def sink(batch: DataFrame, batch_id: int) -> None:
        query = checkpoint_id(spark, checkpoint)
        earlier = [c for c in table.commits(query) if c["batch"] < batch_id]
        mark = earlier[-1]["marks"]["watermark"] if earlier else None
        micros = F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), F.col(event_time))
        behind = micros.isNull() if mark is None else micros.isNull() | (micros < mark)
        first = Window.partitionBy("late", *keys, F.when(F.col("late"), F.xxhash64(*columns))).orderBy(event_time, F.xxhash64(*columns))
        lines = batch.withColumn("late", behind).withColumn("nth", F.row_number().over(first))
        kept = table.read(earlier).filter(F.col("kind") == "row")
        if mark is not None:    # a plain comparison, so that it reaches the Parquet statistics
            kept = kept.filter(F.col(event_time) >= F.timestamp_add("MICROSECOND", F.lit(mark), F.expr(EPOCH_NTZ)))
        known = kept.select(*keys).withColumn("known", F.lit(True))      # one row a key already
        kind = F.when(F.col("late"), "late").when((F.col("nth") > 1) | F.col("known"), "duplicate").otherwise("row")
        out = lines.join(known, list(keys), "left").withColumn("kind", kind)
        one = lambda k: F.count(F.when(F.col("kind") == k, 1))
        counts = {"input": F.count(F.lit(1)), **{k: one(k) for k in ("row", "duplicate", "late")},
                  "newest": F.max(F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), F.col(event_time)))}
        wait = spark.range(1).select(F.expr(f"unix_micros(timestamp_seconds(0) + INTERVAL {delay})").alias("w")).first().w

        def marks(got: dict) -> dict:
            found = [m for m in (mark, got["newest"] and got["newest"] - wait) if m is not None]
            return {"watermark": max(found) if found else None}
        table.write(out, query, batch_id, counts=counts, marks=marks)

    _run(stream.writeStream.foreachBatch(sink), checkpoint)
    return table


DAILY_SCHEMA = T.StructType([T.StructField("date", T.TimestampNTZType()), T.StructField("affiliate_id", T.StringType()),
                             T.StructField("total_trades", T.LongType()), T.StructField("total_volume", T.DecimalType(28, 8)),
                             T.StructField("last_updated", T.TimestampNTZType())])


def daily_table(spark: SparkSession, root: str) -> PartitionedTable:
    """Daily metrics by (date, affiliate), a folder for each month."""
    return PartitionedTable(spark, root, ["date", "affiliate_id"], "month", lambda: F.date_format("date", "yyyy-MM"), DAILY_SCHEMA)


def daily_by_affiliate(trades: DataFrame, clients: DataFrame, event_time: str, value: str, root: str, checkpoint: str, now=None) -> PartitionedTable:
    """Trade count and volume per day and affiliate, kept up to date from a stream of trades.

    Each micro-batch is joined to the (static) client table for its affiliate;
    the running totals of the days it touches come out in update mode and replace
    those rows of the table, whose other days are not rewritten.  Trades of
    unknown clients do not count, as in the daily view.  A replayed batch writes the same totals.
    """
    spark = trades.sparkSession
    table = daily_table(spark, root)
    owned = trades.join(clients.select("client_id", "affiliate_id"), "client_id")
    totals = (owned.groupBy(trunc_ntz("day", event_time).alias("date"), "affiliate_id")
              .agg(F.count(F.lit(1)).alias("total_trades"), F.sum(value).cast("decimal(28,8)").alias("total_volume")))

    def sink(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            table.upsert(batch, {"total_trades": "replace", "total_volume": "replace"}, now)

    _run(totals.writeStream.outputMode("update").foreachBatch(sink), checkpoint)
    return table


# --- registered queries (driver tables -> stream -> sink -> result) ---------------

# Fixture clock boundaries of the streaming queries.
SEEN_BEFORE = "2024-01-02 00:00:00"
DELIVERY_SPLIT = ("2024-01-20 00:00:00", "2024-01-15 00:00:00")
LATE_DELAY = "7 days"


def _events_as_trades(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.table(spark, sf, "events")
    return e.select(F.col("user_id").cast("string").alias("client_id"), F.col("ts").alias("trade_time"),
                    F.col("value").cast("decimal(18,8)").alias("trade_volume"))


def q_stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Asset pages land in two deliveries; two availableNow runs on one
    checkpoint load each file exactly once."""
    base = work_dir(spark, "stream_ingest")
    landing, target, ckpt = base + "/landing", base + "/bronze_assets", base + "/_checkpoint"
    rows = fx.assets(spark, sf, lineage=False)
    cut = ts_literal(DELIVERY_SPLIT[0])
    pages.write_landing(rows.filter(F.col("update_time") < cut), landing, "assets", request_time=fx.LOAD_TIME,
                        dt_unit="year")
    ingest_pages(spark, landing, "assets", target, ckpt, load_time=fx.EVENTS_AS_OF)
    pages.write_landing(rows.filter(F.col("update_time") >= cut), landing, "assets", request_time=fx.LOAD_TIME,
                        dt_unit="year")
    ingest_pages(spark, landing, "assets", target, ckpt, load_time=fx.EVENTS_AS_OF)
    return ingested(spark, target, "assets").select("affiliate_id", "client_id", "balance", "update_time", "remark", "load_status")


def q_stream_new_customers(spark: SparkSession, sf: str) -> DataFrame:
    base = work_dir(spark, "stream_new_customers")
    keys_path, ckpt = base + "/client_keys", base + "/_checkpoint"
    ev = _events_as_trades(spark, sf)
    seed = (ev.filter(F.col("trade_time") < ts_literal(SEEN_BEFORE)).groupBy("client_id")
            .agg(F.min("trade_time").alias("first_seen")))
    seed.write.parquet(keys_path)
    src = (spark.readStream.schema(fx.table(spark, sf, "events").schema)
           .parquet(f"{sf.rstrip('/')}/events*.parquet")
           .select(F.col("user_id").cast("string").alias("client_id"), F.col("ts").alias("trade_time")))
    ingest_new_keys(src, ["client_id"], "trade_time", keys_path, ckpt)
    return spark.read.parquet(keys_path).filter(F.col("first_seen") >= ts_literal(SEEN_BEFORE))


def q_stream_trades_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Two overlapping deliveries of the trade feed, each picked up by its
    own availableNow run on one checkpoint; the stream keeps one row per
    (client, trade_time) with watermark-bounded state, so the overlap is
    dropped and nothing is late."""
    base = work_dir(spark, "stream_trades_dedup")
    landing, out, ckpt = base + "/landing", base + "/out", base + "/_checkpoint"
    tr = _events_as_trades(spark, sf)
    first, second = DELIVERY_SPLIT
    tr.filter(F.col("trade_time") < ts_literal(first)).write.parquet(landing + "/delivery=1")

    def run() -> None:
        src = (spark.readStream.schema(tr.schema).option("recursiveFileLookup", "true").parquet(landing)
               .withColumn("event_time", to_instant("trade_time")))
        deduped = dedupe_stream(src, ["client_id", "trade_time"], "event_time", LATE_DELAY).drop("event_time")
        _run(deduped.writeStream.format("parquet").option("path", out), ckpt)

    run()
    tr.filter(F.col("trade_time") >= ts_literal(second)).write.parquet(landing + "/delivery=2")
    run()
    return spark.read.parquet(out)


def q_stream_trades_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Two overlapping deliveries of the trade feed upserted (keep-latest per
    (client, trade_time)) into a month-partitioned silver table."""
    base = work_dir(spark, "stream_trades_upsert")
    landing, ckpt = base + "/landing", base + "/_checkpoint"
    table = PartitionedTable(spark, base + "/tradeactivities", ["client_id", "trade_time"], "trade_month",
                             lambda: F.date_format("trade_time", "yyyy-MM"), SILVER["tradeactivities"])
    tr = _events_as_trades(spark, sf)
    first, second = DELIVERY_SPLIT
    order = [F.col("trade_volume").desc_nulls_last()]
    stamp = ts_literal(fx.EVENTS_AS_OF)

    def run() -> None:
        src = (spark.readStream.schema(tr.schema).option("recursiveFileLookup", "true").parquet(landing))
        upsert_stream(src, table, ["client_id", "trade_time"], order, {"trade_volume": "replace"}, stamp, ckpt)

    tr.filter(F.col("trade_time") < ts_literal(first)).write.parquet(landing + "/delivery=1")
    run()
    tr.filter(F.col("trade_time") >= ts_literal(second)).write.parquet(landing + "/delivery=2")
    run()
    return table.read()


def q_stream_daily_trades(spark: SparkSession, sf: str) -> DataFrame:
    """Daily totals from a stream (complete mode); equals the batch view."""
    base = work_dir(spark, "stream_daily_trades")
    out, ckpt = base + "/out", base + "/_checkpoint"
    src = (spark.readStream.schema(fx.table(spark, sf, "events").schema)
           .parquet(f"{sf.rstrip('/')}/events*.parquet")
           .select(to_instant("ts").alias("event_time"),
                   F.col("value").cast("decimal(18,8)").alias("trade_volume")))
    totals = daily_totals(src, "event_time", "trade_volume")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    _run(totals.writeStream.outputMode("complete").foreachBatch(sink), ckpt)
    return spark.read.parquet(out)


def q_stream_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries of asset pages between HTML error pages (the ``pages`` table, line by line), one
    file of the first with records whose balance is no number (the events' properties instead): what
    became of every input, by affiliate and kind."""
    base = work_dir(spark, "stream_quarantine")
    landing, target, ckpt = base + "/landing", base + "/assets", base + "/_checkpoint"
    rows = fx.assets(spark, sf, lineage=False)
    cut = ts_literal(DELIVERY_SPLIT[0])
    pages.write_landing(rows.filter(F.col("update_time") < cut), landing, "assets", request_time=fx.LOAD_TIME, dt_unit="year")
    spoiled = fx.table(spark, sf, "events").filter(F.col("event_type") == "error").select(
        (F.col("user_id") % fx.AFFILIATE_SPREAD).cast("string").alias("affiliate_id"), F.lit("assets").alias("endpoint"),
        F.to_date("ts").alias("dt"), F.to_json(F.struct(
            F.lit(pages.OK_CODE).alias("code"), F.array(F.struct(F.col("user_id").cast("string").alias("uid"), F.col("props").alias("balance")))
            .alias("data"))).alias("value"))
    spoiled.write.mode("append").partitionBy("affiliate_id", "endpoint", "dt").text(landing)
    ingest_pages(spark, landing, "assets", target, ckpt, load_time=fx.EVENTS_AS_OF)
    pages.write_landing(rows.filter(F.col("update_time") >= cut), landing, "assets", request_time=fx.LOAD_TIME, dt_unit="year")
    junk = fx.table(spark, sf, "pages").select((F.col("page_id") % fx.AFFILIATE_SPREAD).cast("string").alias("affiliate_id"),
                                               F.lit("assets").alias("endpoint"), F.lit(fx.EVENTS_AS_OF).alias("dt"), F.col("html").alias("value"))
    junk.write.mode("append").partitionBy("affiliate_id", "endpoint", "dt").text(landing)
    ingest_pages(spark, landing, "assets", target, ckpt, load_time=fx.EVENTS_AS_OF)
    table = ingest_table(spark, target, "assets")
    kinds = [table.lines(k).select("affiliate_id", F.lit(k).alias("kind")) for k in (pages.ROW, pages.BAD_RECORD, pages.BAD_PAGE)]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2]).groupBy("affiliate_id", "kind").agg(F.count(F.lit(1)).alias("n"))


def q_stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Three deliveries of the trade feed: up to the 20th, from the 15th on (an overlap), and at last the
    trades of every seventh client, held back until then.  Each trade by what became of it."""
    base = work_dir(spark, "stream_late_rows")
    landing, root, ckpt = base + "/landing", base + "/trades", base + "/_checkpoint"
    held = F.col("client_id").cast("long") % 7 == 0
    tr = _events_as_trades(spark, sf)
    first, second = DELIVERY_SPLIT
    deliveries = [tr.filter(~held & (F.col("trade_time") < ts_literal(first))),
                  tr.filter(~held & (F.col("trade_time") >= ts_literal(second))), tr.filter(held)]
    table = None
    for n, rows in enumerate(deliveries, 1):
        rows.write.parquet(f"{landing}/delivery={n}")
        source = spark.readStream.schema(tr.schema).option("recursiveFileLookup", "true").parquet(landing)
        table = split_late(source, ["client_id", "trade_time"], "trade_time", LATE_DELAY, root, ckpt)
    return table.read()


def q_stream_daily_affiliate(spark: SparkSession, sf: str) -> DataFrame:
    """Daily trade metrics by affiliate from a stream of trades in two deliveries; the clients are the customers."""
    base = work_dir(spark, "stream_daily_affiliate")
    landing, ckpt = base + "/landing", base + "/_checkpoint"
    clients = fx.customers(spark, sf, lineage=False).select("client_id", "affiliate_id")
    tr = _events_as_trades(spark, sf)
    cut = ts_literal(DELIVERY_SPLIT[0])
    table = None
    for n, rows in enumerate((tr.filter(F.col("trade_time") < cut), tr.filter(F.col("trade_time") >= cut)), 1):
        rows.write.parquet(f"{landing}/delivery={n}")
        source = spark.readStream.schema(tr.schema).option("recursiveFileLookup", "true").parquet(landing)
        table = daily_by_affiliate(source, clients, "trade_time", "trade_volume", base + "/daily", ckpt, ts_literal(fx.EVENTS_AS_OF))
    return table.read().select("date", "affiliate_id", "total_trades", "total_volume")


__all__ = ["ingest_pages", "ingest_all_endpoints", "ingest_new_keys", "upsert_stream", "dedupe_stream",
           "daily_totals", "split_late", "daily_by_affiliate", "ingested", "ingest_table",
           "to_instant", "to_wall"]
