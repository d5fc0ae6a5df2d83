"""Driver contract: entry smoke, registry shape, oracle agreement on sf0.001."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from strata_testing import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v != 0 else "0"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["affiliate_name", "new_signups_30d", "trading_volume_30d", "monthly_activation_rate",
                          "avg_trade_size"]


def test_every_query_has_an_oracle():
    from strata.plans import oracle, queries
    assert set(queries.registry()) == set(oracle.oracle())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


FAST = ["silver_trades", "upsert_customers", "gold_daily", "gold_monthly", "gold_performance", "gold_etl_dashboard",
        "top_affiliates", "dq_report", "validate_records", "check_constraints", "bronze_insert_ignore",
        "load_summary", "scan_assets", "view_top_affiliates", "report_etl_status"]


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    idx = [ocols.index(c) for c in df.columns]
    key = lambda r: tuple((x is None, str(x)) for x in r)
    s = sorted((tuple(_norm(x) for x in r) for r in df.collect()), key=key)
    o = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=key)
    assert s == o
