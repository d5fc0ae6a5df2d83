"""Batch-committed tables, replay-safe streams, quarantine, late rows, incremental silver."""

import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.plans import gold, jobs
from strata.sources import batches, pages
from strata.sources import fixtures as fx
from strata.streaming import ingest
from strata_testing import SF_SMALL, T

@pytest.fixture(autouse=True)
def few_buckets(monkeypatch):
    """Small tables need no 64 folders."""
    monkeypatch.setattr(jobs, "SILVER_BUCKETS", 2)


ASSETS = "affiliate_id string, client_id string, balance decimal(20,8), update_time timestamp_ntz, remark string"


def assets(spark, *clients):
    return spark.createDataFrame([("1", c, Decimal("1"), T("2024-01-01"), "view") for c in clients], ASSETS)


def table(spark, path):
    return batches.BatchTable(spark, str(path), spark.createDataFrame([], "id long, kind string").schema, ("kind",))


def rows(spark, lo, hi):
    return spark.range(lo, hi).select("id", F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("kind"))


def ids(frame):
    return sorted(r.id for r in frame.collect())


def test_batch_is_replaced_and_unfinished_writes_are_not_read(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    assert t.read().count() == 0 and not t.exists()
    t.write(rows(spark, 0, 4), "q", 0)
    t.write(rows(spark, 4, 6), "q", 1, counts={"odd": F.count(F.when(F.col("kind") == "odd", 1))}, marks={"high": 5})
    assert ids(t.read()) == list(range(6)) and t.last("q")["counts"] == {"odd": 1} and t.last("q")["marks"] == {"high": 5}
    rows(spark, 90, 95).write.partitionBy("kind").parquet(f"{t.root}/query=q/batch={2:012d}/attempt=lost")   # no commit
    assert ids(t.read()) == list(range(6))
    t.write(rows(spark, 10, 12), "q", 1)
    assert ids(t.read()) == [0, 1, 2, 3, 10, 11]
    t.write(rows(spark, 20, 21), "q", 2)
    assert len(os.listdir(f"{t.root}/query=q/batch={2:012d}")) == 1      # the lost attempt went with the commit
    t.write(rows(spark, 30, 31), "other", 0)
    assert ids(t.read()) == [0, 1, 2, 3, 10, 11, 20, 30] and ids(t.read(t.commits("other"))) == [30]


def test_counts_cover_rows_that_are_not_kept(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    c = t.write(rows(spark, 0, 9), "q", 0, counts={"all": F.count(F.lit(1))}, keep=F.col("kind") == "odd")
    assert c["rows"] == 4 and c["counts"]["all"] == 9 and ids(t.read()) == [1, 3, 5, 7]
    t.write(rows(spark, 0, 0), "q", 1)
    assert ids(t.read()) == [1, 3, 5, 7]


def test_log_is_compacted_and_keeps_replays(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(batches, "COMPACT_EVERY", 4)
    log = batches.CommitLog(spark, str(tmp_path / "log"))
    for n in range(10):
        log.commit({"batch": n, "v": n})
    assert [e["v"] for e in log.entries().values()] == list(range(10))
    assert len([f for f in os.listdir(tmp_path / "log") if f.endswith(".json") and not f.startswith(".")]) == 3
    log.commit({"batch": 7, "v": 70})          # replay of a batch that stands in the compact file
    log.commit({"batch": 10, "v": 10})
    assert log.entries()[7]["v"] == 70 and log.entries()[6]["v"] == 6 and len(log.entries()) == 11


@pytest.mark.parametrize("after_commit", [False, True])
def test_replayed_micro_batch_leaves_each_record_once(spark, tmp_path, monkeypatch, after_commit):
    """A fault after the write, before or after the sink's commit, always before Spark's: the micro-batch runs twice."""
    landing, target, ckpt = (str(tmp_path / n) for n in ("l", "t", "c"))
    pages.write_landing(assets(spark, "a", "b"), landing, "assets")
    real, faults = batches.BatchTable._commit, []

    def fails_once(self, entry):
        if after_commit:
            real(self, entry)
        if not faults:
            faults.append(entry["batch"])
            raise RuntimeError("executor and driver lost")
        if not after_commit:
            real(self, entry)
    monkeypatch.setattr(batches.BatchTable, "_commit", fails_once)
    with pytest.raises(Exception, match="lost"):
        ingest.ingest_pages(spark, landing, "assets", target, ckpt)
    ingest.ingest_pages(spark, landing, "assets", target, ckpt)
    assert faults == [0]
    assert sorted(r.client_id for r in ingest.ingested(spark, target, "assets").collect()) == ["a", "b"]
    assert sorted(r.client_id for r in spark.read.parquet(target).collect()) == ["a", "b"]     # nothing else lies there
    pages.write_landing(assets(spark, "c"), landing, "assets")
    ingest.ingest_pages(spark, landing, "assets", target, ckpt)
    assert sorted(r.client_id for r in ingest.ingested(spark, target, "assets").collect()) == ["a", "b", "c"]


def test_new_checkpoint_is_a_new_query(spark, tmp_path):
    landing, target = str(tmp_path / "l"), str(tmp_path / "t")
    pages.write_landing(assets(spark, "a"), landing, "assets")
    ingest.ingest_pages(spark, landing, "assets", target, str(tmp_path / "c1"))
    ingest.ingest_pages(spark, landing, "assets", target, str(tmp_path / "c2"))
    assert ingest.ingested(spark, target, "assets").count() == 2      # batch 0 of another query replaces nothing


def test_stream_keeps_everything_that_is_bad(spark, tmp_path):
    landing, target, ckpt = (str(tmp_path / n) for n in ("l", "t", "c"))
    pages.write_landing(assets(spark, "a", "b"), landing, "assets")
    folder = tmp_path / "l" / "affiliate_id=9" / "endpoint=assets" / "dt=2024-01-02"
    os.makedirs(folder)
    good = {"uid": "z", "balance": "2.5", "uTime": "1700000000000", "remark": None}
    lines = ["<html>", "see <b> no page", json.dumps({"code": "00000", "data": [good, {"uid": "y", "balance": "much", "uTime": "1"}, {"uid": None}]}),
             json.dumps({"code": "E1", "data": [good]}), json.dumps({"code": "00000"}), json.dumps({"code": "00000", "data": []})]
    (folder / "page.json").write_text("\n".join(lines))
    ingest.ingest_pages(spark, landing, "assets", target, ckpt)
    assert sorted(r.client_id for r in ingest.ingested(spark, target, "assets").collect()) == ["a", "b", "z"]
    records = ingest.ingested(spark, target, "assets", pages.BAD_RECORD).collect()
    assert sorted(str(r.client_id) for r in records) == ["None", "y"] and any('"much"' in r.raw for r in records)
    assert sorted(r.raw[:6] for r in ingest.ingested(spark, target, "assets", pages.BAD_PAGE).collect()) == ["<html>", "see <b", '{"code', '{"code']
    commits = ingest.ingest_table(spark, target, "assets").commits()
    counts = commits[0]["counts"]
    assert [counts[k] for k in ("row", "bad_record", "bad_page", "empty_page")] == [3, 2, 4, 1]
    assert counts["pages"] == 6 + spark.read.text(f"{landing}/affiliate_id=1").count()


def test_stream_parses_each_batch_once(spark, tmp_path):
    landing, target, ckpt = (str(tmp_path / n) for n in ("l", "t", "c"))
    pages.write_landing(assets(spark, "a"), landing, "assets")
    env = pages.read_envelopes(spark, landing, "assets")
    plan = pages.classified(env, "assets")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan json") == 1 and "Exchange" not in plan


def test_late_rows_are_kept_apart_and_add_up(spark, tmp_path):
    schema = "k string, t timestamp_ntz, v int"
    landing, root, ckpt = (str(tmp_path / n) for n in ("l", "r", "c"))

    def deliver(n, data):
        spark.createDataFrame(data, schema).write.parquet(f"{landing}/d={n}")
        source = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(landing)
        return ingest.split_late(source, ["k", "t"], "t", "2 days", root, ckpt)
    deliver(1, [("a", T("2024-01-01"), 1), ("b", T("2024-01-10"), 1), ("b", T("2024-01-10"), 1)])
    deliver(2, [("a", T("2024-01-01"), 1), ("b", T("2024-01-10"), 1), ("c", T("2024-01-08"), 1), ("c", T("2024-01-07 23:59:59"), 1), ("x", None, 1)])
    out = deliver(3, [("d", T("2024-01-20"), 1), ("c", T("2024-01-08"), 2)])
    got = sorted((r.k, r.kind) for r in out.read().collect())
    assert got == [("a", "late"), ("a", "row"), ("b", "duplicate"), ("b", "duplicate"), ("b", "row"), ("c", "duplicate"),
                   ("c", "late"), ("c", "row"), ("d", "row"), ("x", "late")]
    commits = out.commits()
    assert all(c["counts"]["input"] == sum(c["counts"][k] for k in ("row", "duplicate", "late")) for c in commits)
    assert [c["counts"]["late"] for c in commits] == [0, 3, 0]


def test_stream_daily_by_affiliate_equals_the_daily_view(spark):
    streamed = ingest.q_stream_daily_affiliate(spark, SF_SMALL)
    clients = fx.customers(spark, SF_SMALL, lineage=False)
    trades = ingest._events_as_trades(spark, SF_SMALL)
    view = gold.gold_daily(clients, trades, clients.select("affiliate_id", F.lit("n").alias("name")).distinct(), fx.AS_OF)
    batch = view.filter("total_trades > 0").select("date", "affiliate_id", "total_trades", "total_volume")
    assert streamed.count() > 0 and streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0



def test_incremental_silver_reads_new_batches_alone(spark, tmp_path, monkeypatch):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "tables")
    s = "affiliate_id string, client_id string, trade_volume decimal(20,8), trade_time timestamp_ntz"
    c = "affiliate_id string, client_id string, register_time timestamp_ntz"
    reads = []
    real = batches.BatchTable.read
    monkeypatch.setattr(batches.BatchTable, "read", lambda self, commits=None: reads.append((os.path.basename(self.root), commits)) or real(self, commits))

    def load(n, endpoint, data, schema):
        pages.write_landing(spark.createDataFrame(data, schema), f"{landing}{n}", endpoint)
        jobs.run_bronze(spark, f"{landing}{n}", root, load_time=T("2024-03-01"))
    load(0, "trade_activities", [("1", "u1", Decimal("5"), T("2024-01-01")), ("1", "u2", Decimal("-1"), T("2024-01-01")),
                                 ("1", "u3", Decimal("12345678901.5"), T("2024-01-01")), ("1", "u9", Decimal("7"), T("2024-01-02"))], s)
    jobs.run_silver(spark, root, T("2024-03-02"), incremental=True)
    trades = jobs.silver_table(spark, root, "tradeactivities")
    waiting = jobs.pending_table(spark, root, "tradeactivities")
    assert trades.read().count() == 0 and sorted(r.client_id for r in waiting.read().collect()) == ["u1", "u9"]
    bad = {r.client_id: r.failed_rules for r in spark.read.parquet(root + "/quarantine/bronze_trades_rules").collect()}
    assert bad == {"u2": ["volume_non_negative"], "u3": ["volume_fits_silver"]}          # no amount is lost as NULL
    load(1, "customer_list", [("1", "u1", T("2023-01-01")), ("1", "u2", T("2023-01-01"))], c)
    jobs.run_silver(spark, root, T("2024-03-03"), incremental=True)
    assert [(r.client_id, r.trade_volume) for r in trades.read().collect()] == [("u1", Decimal("5"))]
    assert [r.client_id for r in waiting.read().collect()] == ["u9"]
    reads.clear()
    versions, logs = waiting.versions(), jobs.read_quality_log(spark, root).count()
    assert jobs.run_silver(spark, root, T("2024-03-04"), incremental=True) == {n: 0 for n in jobs.SILVER_INPUTS}
    assert reads == [] and waiting.versions() == versions and jobs.read_quality_log(spark, root).count() == logs
    assert len(spark.read.parquet(root + "/quarantine/bronze_trades_rules").collect()) == 2
    load(2, "trade_activities", [("1", "u2", Decimal("3"), T("2024-02-01"))], s)
    reads.clear()
    assert jobs.run_silver(spark, root, T("2024-03-05"), incremental=True)["bronze_trades"] == 1
    assert all(len(cs) <= 1 for n, cs in reads if n.startswith("bronze_"))
    full = str(tmp_path / "full")
    for n in (0, 1, 2):
        jobs.run_bronze(spark, f"{landing}{n}", full, load_time=T("2024-03-01"))
    jobs.run_silver(spark, full, T("2024-03-05"))
    cols = ["client_id", "trade_time", "trade_volume"]
    want = jobs.silver_table(spark, full, "tradeactivities").read().select(cols)
    assert sorted(map(tuple, trades.read().select(cols).collect())) == sorted(map(tuple, want.collect()))
    with pytest.raises(ValueError):
        jobs.run_silver(spark, full, strict=True)


def test_repeated_silver_run_leaves_quarantine_as_it_is(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "tables")
    s = "affiliate_id string, client_id string, trade_volume decimal(20,8), trade_time timestamp_ntz"
    pages.write_landing(spark.createDataFrame([("1", "u1", Decimal("5"), T("2024-01-01"))], s), landing, "trade_activities")
    jobs.run_bronze(spark, landing, root, load_time=T("2024-03-01"))
    for _ in range(2):
        jobs.run_silver(spark, root, T("2024-03-02"))
        assert jobs.pending_table(spark, root, "tradeactivities").read().count() == 1


def test_quality_row_of_a_load_comes_from_the_writing_job(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "tables")
    s = "affiliate_id string, order_id string, client_id string, deposit_time timestamp_ntz, deposit_coin string, deposit_amount decimal(20,8)"
    data = [("1", "o1", "c1", T("2024-01-01"), "BTC", Decimal("1"))] * 3 + [("1", "o2", "c1", T("2024-01-01"), None, Decimal("1"))]
    pages.write_landing(spark.createDataFrame(data, s), landing, "deposits")
    jobs.run_bronze(spark, landing, root, load_time=T("2024-03-01"))
    log = {r.table_name: r for r in jobs.read_quality_log(spark, root).collect()}["bronze_deposits"]
    assert log.total_records == 4 and log.duplicate_count == 2 and log.null_percentages["deposit_coin"] == 25.0
    assert not log.validation_passed and jobs.bronze_table(spark, root, "bronze_deposits").read().count() == 1


def test_profile_reads_its_input_once(spark):
    from strata.operators import quality
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = quality.dq_report(df, "documents", check_time=F.lit(T("2024-01-01")).cast("timestamp_ntz"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1


def test_lookback_lists_wanted_folders_only(spark, tmp_path):
    for day in ("2024-01-01", "2024-01-31", "2023-12-31"):
        for affiliate in ("3", "11"):
            for endpoint in ("assets", "deposits"):
                os.makedirs(tmp_path / "h" / f"affiliate_id={affiliate}" / f"endpoint={endpoint}" / f"dt={day}")
                os.makedirs(tmp_path / "d" / f"affiliate{affiliate}" / endpoint / day.replace("-", "/"))
    first = T("2024-01-15").date()
    hive = pages.landing_folders(spark, str(tmp_path / "h"), "assets", "hive", first)
    assert sorted(p.split("/h/")[1] for p in hive) == ["affiliate_id=11/endpoint=assets/dt=2024-01-31", "affiliate_id=3/endpoint=assets/dt=2024-01-31"]
    dated = pages.landing_folders(spark, str(tmp_path / "d"), "assets", "dated", first)
    assert sorted(p.split("/d/")[1] for p in dated) == ["affiliate11/assets/2024/01/31", "affiliate3/assets/2024/01/31"]
    assert len(pages.landing_folders(spark, str(tmp_path / "h"), "assets", "hive", first, "month")) == 4
    got = [r.affiliate_id for r in pages.discover_affiliates(spark, str(tmp_path / "h")).orderBy("affiliate_no").collect()]
    assert got == ["3", "11"]


def test_refresh_equals_a_rebuild_and_leaves_other_months_alone(spark, tmp_path):
    from strata.plans import refresh
    root = str(tmp_path / "tables")
    c = "affiliate_id string, client_id string, register_time timestamp_ntz"
    t = "affiliate_id string, client_id string, trade_volume decimal(20,8), trade_time timestamp_ntz"
    d = "affiliate_id string, order_id string, client_id string, deposit_time timestamp_ntz, deposit_coin string, deposit_amount decimal(20,8)"

    def load(n, **data):
        for endpoint, (rows, schema) in data.items():
            pages.write_landing(spark.createDataFrame(rows, schema), f"{tmp_path}/l{n}", endpoint)
        jobs.run_bronze(spark, f"{tmp_path}/l{n}", root, load_time=T("2024-06-01"))
        jobs.run_silver(spark, root, T("2024-06-01"), incremental=True)
        return refresh.refresh_gold(spark, root, "2024-06-02")

    def same():
        s = {n: jobs.silver_table(spark, root, n).read() for n in jobs.SILVER_TABLES}
        full = {"gold_affiliate_daily_metrics": gold.gold_daily(s["clientaccount"], s["tradeactivities"], s["affiliateaccount"], "2024-06-02"),
                "gold_affiliate_monthly_metrics": gold.gold_monthly(s["clientaccount"], s["tradeactivities"], s["deposits"], s["affiliateaccount"], "2024-06-02")}
        for name, want in full.items():
            got = refresh.read_view(spark, root, name)
            assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))

    assert load(0, customer_list=([("1", "a", T("2024-01-05")), ("2", "b", T("2024-02-05"))], c),
                trade_activities=([("1", "a", Decimal(5), T("2024-01-09")), ("1", "b", Decimal(7), T("2024-03-09")), ("1", "z", Decimal(1), T("2024-04-01"))], t),
                deposits=([("1", "o1", "a", T("2024-02-02"), "BTC", Decimal(3))], d)) is None
    same()
    before = bronze_or_gold_files(root)
    assert load(1, trade_activities=([("1", "a", Decimal(2), T("2024-03-10"))], t)) == ["2024-03"]
    same()
    after = bronze_or_gold_files(root)
    assert {f for f in before if "period_month=2024-03" not in f} == {f for f in after if "period_month=2024-03" not in f}
    plan = refresh.month_sources(spark, root, ["2024-03"])[2]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [trade_month" in plan.replace("isnotnull(trade_month", "trade_month") or "trade_month#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # A client that comes late brings its waiting trade; one that registers earlier under another affiliate moves all its months.
    assert load(2, customer_list=([("1", "z", T("2024-05-01")), ("2", "a", T("2023-12-31"))], c)) == ["2023-12", "2024-01", "2024-02", "2024-03", "2024-04", "2024-05"]
    same()
    assert load(3) == []


def bronze_or_gold_files(root):
    return {os.path.join(x, n) for x, _, names in os.walk(root + "/gold_periods") for n in names if n.endswith(".parquet")}
