"""Landing pages: the upstream dated layout (pretty JSON per file) and the
hive layout written by write_landing."""

import json
from decimal import Decimal

from pyspark.sql import functions as F

from strata_testing import T
from strata.sources import pages


def _page(root, aff, endpoint, day, name, body):
    y, m, d = day.split("-")
    folder = root / f"affiliate{aff}" / endpoint / y / m / d
    folder.mkdir(parents=True, exist_ok=True)
    text = body if isinstance(body, str) else json.dumps(body, indent=2)
    (folder / name).write_text(text)


def _env(records, code="00000"):
    return {"code": code, "msg": "success", "requestTime": "1712793600000", "data": records}


def _ms(ts):
    return str(int((T(ts) - T("1970-01-01")).total_seconds() * 1000))


def make_dated_landing(root):
    _page(root, 5, "customer_list", "2025-04-04", "page_1.json",
          _env([{"uid": "u1", "registerTime": _ms("2025-04-04 10:00:00")},
                {"uid": "u2", "registerTime": _ms("2025-04-04 11:30:00.250")}]))
    _page(root, 5, "customer_list", "2025-04-04", "page_2.json", _env([]))
    _page(root, 12, "customer_list", "2025-04-10", "page_1.json",
          _env([{"uid": "u3", "registerTime": _ms("2025-04-10 00:00:00")}]))
    _page(root, 12, "customer_list", "2025-04-30", "page_1.json",
          _env([{"uid": "u4", "registerTime": _ms("2025-04-30 00:00:00")}]))
    _page(root, 12, "customer_list", "2025-03-01", "page_1.json",
          _env([{"uid": "u5", "registerTime": _ms("2025-03-01 00:00:00")}]))
    _page(root, 3, "customer_list", "2025-04-09", "page_1.json", "{not json")
    _page(root, 3, "customer_list", "2025-04-09", "page_2.json", _env([{"uid": "u6", "registerTime": "1"}], "abc"))
    _page(root, 3, "customer_list", "2025-04-09", "page_3.json",
          _env([{"uid": "u7", "registerTime": "not-a-number"}]))


def test_dated_layout_scan_with_lineage_and_quarantine(spark, tmp_path):
    make_dated_landing(tmp_path)
    scan = pages.scan_pages(spark, str(tmp_path), "customer_list", layout="dated", load_time=T("2025-04-10"))
    got = {r.client_id: (r.affiliate_id, r.register_time, r.load_status) for r in scan.rows.collect()}
    assert got["u1"] == ("5", T("2025-04-04 10:00:00"), "SUCCESS")
    assert got["u2"][1] == T("2025-04-04 11:30:00.250")
    assert got["u7"] == ("3", None, "ERROR")          # unparseable time -> kept, flagged
    assert set(got) == {"u1", "u2", "u3", "u4", "u5", "u7"}
    assert all(r.source_file.endswith(".json") for r in scan.rows.collect())
    bad = scan.quarantine.collect()
    assert len(bad) == 2 and {r.affiliate_id for r in bad} == {"3"}


def test_lookback_has_no_upper_bound(spark, tmp_path):
    make_dated_landing(tmp_path)
    scan = pages.scan_pages(spark, str(tmp_path), "customer_list", layout="dated", as_of="2025-04-10",
                            days_back=7)
    assert sorted(r.client_id for r in scan.rows.collect()) == ["u1", "u2", "u3", "u4", "u7"]


def test_discover_affiliates_numeric_order(spark, tmp_path):
    make_dated_landing(tmp_path)
    got = [r.affiliate_id for r in pages.discover_affiliates(spark, str(tmp_path)).orderBy("affiliate_no").collect()]
    assert got == ["3", "5", "12"]


def test_hive_landing_round_trip_and_page_bound(spark, tmp_path):
    n = 2500
    df = spark.range(n).select((F.col("id") % 3).cast("string").alias("affiliate_id"),
                               F.col("id").cast("string").alias("client_id"),
                               (F.col("id") * F.lit(0.25)).cast("decimal(20,8)").alias("trade_volume"),
                               F.timestamp_add("HOUR", F.col("id"), F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'"))
                               .alias("trade_time"))
    root = str(tmp_path / "landing")
    pages.write_landing(df.repartition(2), root, "trade_activities", request_time=T("2024-06-01"), page_size=100)
    back = pages.scan_pages(spark, root, "trade_activities").rows.select(*df.columns)
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    sizes = spark.read.json(root).select(F.size("data").alias("n")).agg(F.max("n"), F.sum("n")).collect()[0]
    assert sizes[0] <= 100 and sizes[1] == n
    assert {r.dt.isoformat()[:7] for r in spark.read.json(root).select("dt").distinct().collect()} <= {"2024-01", "2024-02", "2024-03", "2024-04"}


def test_month_folders_lookback_is_exact(spark, tmp_path):
    df = spark.createDataFrame([("1", "a", Decimal("1"), T("2024-01-01")), ("1", "b", Decimal("1"), T("2024-01-25")),
                                ("1", "c", Decimal("1"), T("2024-02-03"))],
                               "affiliate_id string, client_id string, trade_volume decimal(20,8), "
                               "trade_time timestamp_ntz")
    root = str(tmp_path / "m")
    pages.write_landing(df, root, "trade_activities", dt_unit="month")
    rows = pages.scan_pages(spark, root, "trade_activities", as_of="2024-02-05", days_back=15, dt_unit="month").rows
    assert sorted(r.client_id for r in rows.collect()) == ["b", "c"]
