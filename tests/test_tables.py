"""Snapshot / insert-once tables and the layer jobs."""

from pyspark.sql import functions as F

from strata_testing import SF_SMALL, T
from strata.plans import jobs
from strata.sources import fixtures as fx
from strata.sources import pages
from strata.sources.catalog import AppendTable, SnapshotTable, table_columns, table_exists


def test_snapshot_versions_never_overwrite_the_read_version(spark, tmp_path):
    schema = "client_id string, affiliate_id string, register_time timestamp_ntz, last_updated timestamp_ntz"
    t = SnapshotTable(spark, str(tmp_path / "clients"), keys=["client_id"])
    v1 = t.write(spark.createDataFrame([("1", "a", T("2020-01-01"), T("2024-01-01"))], schema))
    v2 = t.upsert(spark.createDataFrame([("1", "b", T("2019-01-01")), ("2", "c", T("2021-01-01"))],
                                        "client_id string, affiliate_id string, register_time timestamp_ntz"),
                  rules={"register_time": "least"})
    assert (v1, v2) == (1, 2) and t.versions() == [1, 2]
    assert t.read(1).count() == 1
    cur = {r.client_id: (r.affiliate_id, r.register_time) for r in t.read().collect()}
    assert cur == {"1": ("b", T("2019-01-01")), "2": ("c", T("2021-01-01"))}


def test_append_table_insert_ignore(spark, tmp_path):
    t = AppendTable(spark, str(tmp_path / "dep"), keys=["order_id"])
    b1 = spark.createDataFrame([("o1", 1), ("o2", 2)], "order_id string, v int")
    t.append(b1)
    t.insert_ignore(spark.createDataFrame([("o2", 9), ("o3", 3)], "order_id string, v int"), ["v"])
    t.insert_ignore(spark.createDataFrame([("o3", 7)], "order_id string, v int"), ["v"])
    assert sorted(tuple(r) for r in t.read().collect()) == [("o1", 1), ("o2", 2), ("o3", 3)]


def test_catalog_helpers(spark):
    spark.range(3).createOrReplaceTempView("strata_tmp_view")
    assert table_exists(spark, "strata_tmp_view") and not table_exists(spark, "strata_missing_view")
    assert table_columns(spark, "strata_tmp_view") == ["id"]


def test_layer_jobs_end_to_end_and_rerun(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "tables")
    for endpoint, name in [("customer_list", "customers"), ("deposits", "deposits"),
                           ("trade_activities", "trades"), ("assets", "assets")]:
        pages.write_landing(getattr(fx, name)(spark, SF_SMALL, lineage=False), landing, endpoint, dt_unit="year")
    jobs.run_all(spark, landing, root, fx.AS_OF, now=fx.LOAD_TIME, dt_unit="year")
    counts = {r.table_name: r.row_count for r in jobs.table_counts(spark, root).collect()}
    customers = fx.table(spark, SF_SMALL, "customer").count()
    assert counts["bronze_customers"] == customers == counts["clientaccount"]
    assert counts["gold_affiliate_performance"] == counts["affiliateaccount"]
    # a second bronze run over the same landing inserts nothing new for keyed tables,
    # and the silver upsert keeps one row per key
    jobs.run_bronze(spark, landing, root, load_time=fx.LOAD_TIME, dt_unit="year")
    jobs.run_silver(spark, root, now=T("2001-08-02"))
    again = {r.table_name: r.row_count for r in jobs.table_counts(spark, root).collect()}
    assert again["bronze_customers"] == customers and again["clientaccount"] == customers
    assert again["bronze_trades"] == 2 * counts["bronze_trades"]        # no natural key: appended
    assert again["tradeactivities"] == counts["tradeactivities"]
    latest = jobs.silver_table(spark, root, "clientaccount")
    assert latest.read().filter(F.col("last_updated") == F.lit(T("2001-08-02"))).count() == customers
    aff = jobs.silver_table(spark, root, "affiliateaccount")
    assert aff.versions() == [1, 2]


def test_partitioned_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    from strata.sources.catalog import PartitionedTable
    s = "client_id string, trade_time timestamp_ntz, trade_volume double, last_updated timestamp_ntz"
    t = PartitionedTable(spark, str(tmp_path / "trades"), ["client_id", "trade_time"], "trade_month",
                         lambda: F.date_format("trade_time", "yyyy-MM"))
    t.write(spark.createDataFrame([("1", T("2024-01-05"), 1.0, T("2024-02-01")),
                                   ("1", T("2024-02-05"), 2.0, T("2024-02-01"))], s))
    jan_files = sorted(p.name for p in (tmp_path / "trades" / "trade_month=2024-01").iterdir())
    touched = t.upsert(spark.createDataFrame([("1", T("2024-02-05"), 5.0), ("2", T("2024-03-01"), 3.0)],
                                             "client_id string, trade_time timestamp_ntz, trade_volume double"),
                       {"trade_volume": "replace"}, F.lit(T("2024-03-02")))
    assert sorted(touched) == ["2024-02", "2024-03"]
    assert sorted(p.name for p in (tmp_path / "trades" / "trade_month=2024-01").iterdir()) == jan_files
    got = {(r.client_id, r.trade_time): (r.trade_volume, r.last_updated) for r in t.read().collect()}
    assert got == {("1", T("2024-01-05")): (1.0, T("2024-02-01")), ("1", T("2024-02-05")): (5.0, T("2024-03-02")),
                   ("2", T("2024-03-01")): (3.0, T("2024-03-02"))}


def test_quality_log_and_reset(spark, tmp_path):
    root = str(tmp_path / "tables")
    df = spark.createDataFrame([("1", None), ("1", None)], "client_id string, affiliate_id string")
    jobs.log_quality(spark, root, df, "bronze_customers", T("2024-01-01"))
    jobs.log_quality(spark, root, df.limit(1), "bronze_customers", T("2024-01-02"))
    log = jobs.read_quality_log(spark, root).orderBy("check_timestamp").collect()
    assert [r.validation_passed for r in log] == [False, False]
    assert log[0].duplicate_percentage == 50.0 and log[0].null_percentages["affiliate_id"] == 100.0
    spark.range(3).write.parquet(root + "/bronze/bronze_customers")
    jobs.reset_layers(spark, root)
    import os
    assert not os.path.exists(root + "/bronze") and os.path.exists(root + "/quality/etl_data_quality_log")


def test_bronze_quarantines_unparseable_records_and_strict_raises(spark, tmp_path):
    import pytest
    from test_pages import make_dated_landing
    landing = tmp_path / "dump"
    make_dated_landing(landing)
    root = str(tmp_path / "tables")
    jobs.run_bronze(spark, str(landing), root, layout="dated", load_time=T("2025-04-10"))
    ids = sorted(r.client_id for r in jobs.bronze_table(spark, root, "bronze_customers").read().collect())
    assert ids == ["u1", "u2", "u3", "u4", "u5"]
    bad = spark.read.parquet(root + "/quarantine/customer_list_records").collect()
    assert [r.client_id for r in bad] == ["u7"]
    with pytest.raises(ValueError):
        jobs.run_bronze(spark, str(landing), str(tmp_path / "strict"), layout="dated", strict=True)


def test_streaming_ingest_all_endpoints(spark, tmp_path):
    from strata.streaming import ingest
    landing, root = str(tmp_path / "landing"), str(tmp_path / "tables")
    for endpoint, name in [("customer_list", "customers"), ("deposits", "deposits"),
                           ("trade_activities", "trades"), ("assets", "assets")]:
        pages.write_landing(getattr(fx, name)(spark, SF_SMALL, lineage=False), landing, endpoint, dt_unit="year")
    ingest.ingest_all_endpoints(spark, landing, root, load_time=fx.LOAD_TIME)
    ingest.ingest_all_endpoints(spark, landing, root, load_time=fx.LOAD_TIME)      # nothing new
    dep = spark.read.parquet(root + "/bronze/bronze_deposits")
    assert dep.count() == dep.select("order_id").distinct().count()
    assert dep.count() == fx.deposits(spark, SF_SMALL).select("order_id").distinct().count()
    assert spark.read.parquet(root + "/bronze/bronze_trades").count() == fx.table(spark, SF_SMALL, "orders").count()


def test_null_partition_rows_survive_and_marker_is_not_needed(spark, tmp_path):
    import os

    from pyspark.sql import functions as F

    from strata.sources.catalog import PartitionedTable, SnapshotTable
    schema = "id string, t timestamp_ntz, v int"
    make = lambda rows: spark.createDataFrame(rows, schema)
    root = str(tmp_path / "nulls")
    table = PartitionedTable(spark, root, ["id", "t"], "month", lambda: F.date_trunc("month", F.col("t")).cast("date"),
                             make([]).schema)
    table.write(make([("a", T("2024-01-02"), 1), ("n1", None, 1)]))
    table.upsert(make([("b", T("2024-01-03"), 2), ("n2", None, 2)]), updated_col=None)
    assert sorted(r.id for r in table.read().collect()) == ["a", "b", "n1", "n2"]
    os.remove(f"{root}/_SUCCESS")
    table.upsert(make([("n3", None, 3)]), updated_col=None)
    assert sorted(r.id for r in table.read().collect()) == ["a", "b", "n1", "n2", "n3"]
    assert not os.listdir(f"{root}.__staging")
    snap = SnapshotTable(spark, str(tmp_path / "snap"))
    os.makedirs(f"{snap.root}/v=00000001/_temporary")     # what a failed write leaves
    assert snap.write(make([("a", None, 1)])) == 2 and snap.read().count() == 1


def test_live_session_keeps_its_settings(spark):
    from strata.session import get_spark
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert get_spark().conf.get("spark.sql.shuffle.partitions") == before


def test_gold_views_are_readable_by_name(spark, tmp_path):
    from strata.plans import jobs
    from strata.sources.catalog import SnapshotTable
    for i, name in enumerate(jobs.GOLD_VIEWS):
        SnapshotTable(spark, f"{tmp_path}/gold/{name}").write(spark.range(i))
    jobs.register_views(spark, str(tmp_path))
    assert [spark.sql(f"SELECT count(*) FROM {name}").first()[0] for name in jobs.GOLD_VIEWS] == [0, 1, 2, 3]
