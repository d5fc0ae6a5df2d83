"""Gold views and reports on literal silver frames (traps T1, T12-T17)."""

from decimal import Decimal

import pytest

from strata_testing import T
from strata.plans import gold, reports

AS_OF = "2024-03-31"
CS = "client_id string, affiliate_id string, register_time timestamp_ntz"
TS = "client_id string, trade_time timestamp_ntz, trade_volume decimal(18,8)"
DS = "order_id string, client_id string, deposit_time timestamp_ntz, deposit_amount decimal(18,8)"
AS = "affiliate_id string, name string"


@pytest.fixture
def frames(spark):
    aff = spark.createDataFrame([("1", "Affiliate 1"), ("2", "Affiliate 2"), ("9", "Affiliate 9")], AS)
    clients = spark.createDataFrame([
        ("c1", "1", T("2024-01-05 10:00:00")), ("c2", "1", T("2024-03-01 00:00:00")),
        ("c3", "2", T("2024-03-20 08:00:00")),
    ], CS)
    trades = spark.createDataFrame([
        ("c1", T("2024-01-05 12:00:00"), Decimal("100")), ("c1", T("2024-03-01 00:00:00"), Decimal("50")),
        ("c3", T("2024-02-10 09:00:00"), Decimal("7")), ("cX", T("2024-03-10 00:00:00"), Decimal("999")),
    ], TS)
    deposits = spark.createDataFrame([("o1", "c3", T("2024-02-11 00:00:00"), Decimal("5"))], DS)
    return aff, clients, trades, deposits


def test_gold_daily_full_outer_and_client_affiliate(frames):
    aff, clients, trades, _ = frames
    out = {(r.date, r.affiliate_id): (r.new_signups, r.total_trades, r.total_volume, r.affiliate_name)
           for r in gold.gold_daily(clients, trades, aff, AS_OF).collect()}
    assert out[(T("2024-01-05"), "1")] == (1, 1, Decimal("100"), "Affiliate 1")
    assert out[(T("2024-02-10"), "2")] == (0, 1, Decimal("7"), "Affiliate 2")   # trade-only day
    assert out[(T("2024-03-20"), "2")] == (1, 0, Decimal("0"), "Affiliate 2")   # signup-only day
    assert sum(v[0] for v in out.values()) == 3                                   # signups = clients
    assert all(k[1] != "cX" for k in out)                                         # unknown client dropped


def test_gold_monthly_chained_join_splits_rows_and_merged_does_not(frames):
    aff, clients, trades, deposits = frames
    faithful = gold.gold_monthly(clients, trades, deposits, aff, AS_OF)
    feb2 = [r for r in faithful.collect() if r.month == T("2024-02-01") and r.affiliate_id == "2"]
    assert len(feb2) == 2     # trades and deposits without signups stay apart
    merged = gold.gold_monthly_merged(clients, trades, deposits, aff, AS_OF)
    feb2m = [r for r in merged.collect() if r.month == T("2024-02-01") and r.affiliate_id == "2"]
    assert len(feb2m) == 1 and feb2m[0].total_trades == 1 and feb2m[0].total_deposits == 1
    assert feb2m[0].active_traders == 1


def test_gold_performance_window_rates_and_guards(frames):
    aff, clients, trades, _ = frames
    out = {r.affiliate_id: r for r in gold.gold_performance(aff, clients, trades, AS_OF).collect()}
    # cutoff = 2024-03-01 00:00 inclusive (midnight-based, no upper bound)
    a1 = out["1"]
    assert (a1.total_customers, a1.new_signups_30d, a1.active_customers_30d) == (2, 1, 1)
    assert (a1.trades_30d, a1.trading_volume_30d, a1.avg_trade_size) == (1, Decimal("50"), 50.0)
    assert a1.monthly_activation_rate == 50.0
    a9 = out["9"]      # affiliate without clients: zeros, no division error
    assert (a9.total_customers, a9.trades_30d, a9.avg_trade_size, a9.monthly_activation_rate) == (0, 0, 0.0, 0.0)


def test_etl_dashboard_statuses(spark, frames):
    aff, clients, trades, _ = frames
    bronze = spark.createDataFrame([("1", "c1"), ("1", "c2"), ("3", "c7")], "affiliate_id string, client_id string")
    daily = gold.gold_daily(clients, trades, aff, AS_OF)
    out = {r.affiliate_id: r for r in gold.gold_etl_dashboard(bronze, clients, daily, aff, AS_OF).collect()}
    assert (out["1"].etl_status, out["1"].success_count, out["1"].success_rate) == ("Complete", 2, 100)
    assert (out["3"].etl_status, out["3"].partial_count, out["3"].success_rate) == ("Bronze Complete", 1, 33)
    # affiliate 2 has no bronze rows: separate silver/gold-only rows, 'Not Started', NULL counts
    not_started = [r for r in out.values() if r.affiliate_id == "2"]
    assert not_started and not_started[0].etl_status == "Not Started"
    assert not_started[0].error_count is None and not_started[0].total_records is None


def test_top_affiliates_order_limit_and_null_names(spark):
    perf = spark.createDataFrame([
        ("A", 1, Decimal("10"), 1.0, 1.0), ("B", 1, Decimal("30"), 1.0, 1.0), ("C", 1, Decimal("30"), 1.0, 1.0),
        (None, 1, Decimal("99"), 1.0, 1.0),
    ], "affiliate_name string, new_signups_30d long, trading_volume_30d decimal(28,8), "
       "monthly_activation_rate double, avg_trade_size double")
    got = [r.affiliate_name for r in reports.top_affiliates(perf, 2).collect()]
    assert got == ["B", "C"]


def test_page_read_and_keyset_paging(spark):
    df = spark.range(1, 26).selectExpr("cast(id as int) as k")
    assert [r.k for r in reports.page_read(df, ["k"], 3, 10).collect()] == [21, 22, 23, 24, 25]
    assert [r.k for r in reports.page_after(df, "k", 20, 3).collect()] == [21, 22, 23]


def test_time_slice_half_open(spark):
    df = spark.createDataFrame([("1", T("2024-01-01")), ("1", T("2024-01-02")), ("2", T("2024-01-01 12:00:00"))],
                               "client_id string, ts timestamp_ntz")
    assert reports.time_slice(df, "ts", "2024-01-01 00:00:00", "2024-01-02 00:00:00").count() == 2
    assert reports.time_slice(df, "ts", "2024-01-01 00:00:00", "2024-01-02 00:00:00", client_id=2).count() == 1
