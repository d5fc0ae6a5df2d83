"""Work that must not be done twice, and memory that must not grow with a partition, in the layer jobs and their sinks."""

from decimal import Decimal

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from strata.operators import dedupe, merge
from strata.operators.paging import PagedTable
from strata.plans import jobs, queries, silver
from strata.sources import batches, pages
from strata.sources import fixtures as fx
from strata_testing import SF_SMALL, T


@pytest.fixture
def json_plans(monkeypatch):
    """Physical plans of what is written as JSON."""
    plans, write = [], DataFrameWriter.json

    def spied(self, path, *args, **kwargs):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, path, *args, **kwargs)
    monkeypatch.setattr(DataFrameWriter, "json", spied)
    return plans


def test_landing_write_shuffles_rows_once_and_sorts_after(spark, tmp_path, json_plans):
    rows = spark.range(5000).select(F.expr("cast(id % 1 as string)").alias("affiliate_id"), F.col("id").cast("string").alias("client_id"),
                                    F.expr("timestampadd(DAY, cast(id % 1 as int), timestamp_ntz'2024-01-01')").alias("register_time")).repartition(6)
    pages.write_landing(rows, str(tmp_path), "customer_list", request_time=T("2024-01-02"), page_size=100)
    plan = json_plans[0].split("Initial Plan")[-1]
    ours = plan.split("round", 1)[0].split("RoundRobinPartitioning")[0]     # above the input's own exchange
    assert ours.count("Exchange hashpartitioning") == 1 and "REBALANCE" not in plan
    assert ours.index("Sort [affiliate_id") < ours.index("Exchange hashpartitioning")      # bounded by the exchange, not by the input
    got = pages.read_envelopes(spark, str(tmp_path), "customer_list")
    assert got.agg(F.max(F.size("data"))).first()[0] <= 100
    assert sorted(int(r.uid) for r in got.select(F.inline("data")).collect()) == list(range(5000))
    assert got.select("source_file").distinct().count() <= 2      # six inputs, four to a file


def test_batches_are_written_without_a_sort_by_folder(spark, tmp_path, monkeypatch):
    name, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet

    def spied(self, *args, **kwargs):
        seen.append(int(spark.conf.get(name)))
        return write(self, *args, **kwargs)
    monkeypatch.setattr(DataFrameWriter, "parquet", spied)
    before = spark.conf.get(name)
    t = batches.BatchTable(spark, str(tmp_path / "t"), spark.createDataFrame([], "id long, kind string").schema, ("kind",))
    t.write(spark.range(100).select("id", (F.col("id") % 3).cast("string").alias("kind")), "q", 0)
    assert seen == [batches.OPEN_WRITERS] and spark.conf.get(name) == before
    assert sorted((r.id, r.kind) for r in t.read().collect()) == [(i, str(i % 3)) for i in range(100)]


def test_large_insert_ignore_stores_nothing_and_keeps_its_rows(spark, monkeypatch):
    batch = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5), ("c", 3), (None, 4), ("c", 9)], "k string, v int")
    target = spark.createDataFrame([("b", 0), ("b", 1), (None, 0)], "k string, v int")
    small = sorted(map(tuple, dedupe.insert_ignore(target, batch, ["k"], ["v"], rows=6).collect()))
    monkeypatch.setattr("strata.session.materialize", lambda df: pytest.fail("stored"))
    large = dedupe.insert_ignore(target, batch, ["k"], ["v"], broadcast_max_keys=2, rows=6)
    assert sorted(map(tuple, large.collect())) == small == [("a", 1), ("c", 3)]


def test_first_load_of_a_table_joins_nothing(spark):
    target = spark.createDataFrame([], "k string, a decimal(18,8), b int, last_updated timestamp_ntz")
    source = spark.createDataFrame([("x", Decimal("1.5"), T("2020-01-01")), ("x", None, None), (None, Decimal(2), None)],
                                   "k string, a decimal(20,8), last_updated timestamp_ntz")
    stamp = F.lit(T("2024-01-01")).cast("timestamp_ntz")
    got = merge.as_inserts(target, source, stamp)
    want = merge.merge_upsert(target, source, ["k"], now=stamp)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.dtypes == want.dtypes
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def landed(spark, root, deposits):
    cols = "order_id string, affiliate_id string, client_id string, deposit_time timestamp_ntz, deposit_coin string, deposit_amount decimal(20,8)"
    rows = [(o, "1", c, T("2024-01-05"), "BTC", Decimal(1)) for o, c in deposits]
    pages.write_landing(spark.createDataFrame(rows, cols), root, "deposits", request_time=T("2024-01-06"))


def test_silver_run_picks_the_latest_deposits_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "SILVER_BUCKETS", 2)
    landing, root = str(tmp_path / "landing"), str(tmp_path / "tables")
    landed(spark, landing, [("o1", "c1"), ("o2", "c2"), ("o1", "c1")])
    clients = spark.createDataFrame([("1", "c1", T("2024-01-01"))], "affiliate_id string, client_id string, register_time timestamp_ntz")
    pages.write_landing(clients, landing, "customer_list", request_time=T("2024-01-06"))
    jobs.run_bronze(spark, landing, root, load_time=T("2024-01-06"))
    log = {r.table_name: (r.total_records, r.duplicate_count) for r in jobs.read_quality_log(spark, root).collect()}
    assert log["bronze_deposits"] == (3, 1) and log["bronze_customers"] == (1, 0)
    computed = spark.sparkContext.accumulator(0)
    latest = silver.deposits_source

    def counted(rows, now):
        def tick(parts):
            for part in parts:
                computed.add(part.num_rows)
                yield part
        out = latest(rows, now)
        return out.mapInArrow(tick, out.schema)
    monkeypatch.setattr(silver, "deposits_source", counted)
    jobs.run_silver(spark, root, T("2024-01-06"))
    assert computed.value == 2      # each order once, though upsert, waiting table and checks read it
    assert [r.order_id for r in jobs.silver_table(spark, root, "deposits").read().collect()] == ["o1"]
    assert [r.order_id for r in jobs.pending_table(spark, root, "deposits").read().collect()] == ["o2"]
    with pytest.raises(ValueError):
        jobs.run_silver(spark, root, T("2024-01-06"), strict=True)


def test_paged_deposits_have_as_many_ranges_as_their_rows_need(spark, monkeypatch):
    monkeypatch.setattr("strata.operators.paging.ROWS_PER_RANGE", 1000)
    asked, write = [], PagedTable.write

    def spied(self, df, order_by, ranges=None):
        write(self, df, order_by, ranges)
        asked.append((df.count(), len(self.sizes.read().collect())))
    monkeypatch.setattr(PagedTable, "write", spied)
    assert queries.q_page_read_ranges(spark, SF_SMALL).count() == queries.PAGE_ROWS
    rows, ranges = asked[0]
    assert rows == fx.deposits(spark, SF_SMALL).count() and ranges == -(-rows // 1000)
