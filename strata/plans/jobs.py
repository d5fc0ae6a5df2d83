"""Layer jobs: bronze, silver, gold and all three.

Tables live under one root folder on the shared file system:
``bronze/<table>`` (committed batches), ``silver/<table>`` (partitioned, or
snapshot versions) and ``gold/<view>/v=<n>`` (snapshot versions).  Every job reads committed
tables and writes new ones, so a failed or retried run never leaves a
half-written table behind; lineage is cut at each table boundary.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans import gold, refresh, silver
from strata.schemas import ARRIVAL, BRONZE, ENDPOINT_TABLES, KEYS, SILVER
from strata.session import work_dir
from strata.sources import fixtures as fx
from strata.sources import pages
from strata.functions.expr import ts_literal
from strata.operators import quality
from strata.plans.rules import record_rules
from strata.sources.batches import BatchTable, CommitLog
from strata.sources.bronze import BronzeTable, incoming
from strata.sources.catalog import PartitionedTable, SnapshotTable, delete_path

SILVER_TABLES = ("affiliateaccount", "clientaccount", "deposits", "tradeactivities")
GOLD_VIEWS = ("gold_affiliate_daily_metrics", "gold_affiliate_monthly_metrics",
              "gold_affiliate_performance", "gold_etl_affiliate_dashboard")


def log_quality(spark: SparkSession, root: str, df: DataFrame, table_name: str, now=None) -> None:
    """Append one quality row (null %, duplicate %, verdict, issues) for
    ``df`` to the quality log table.  Checks warn, they never block."""
    stamp = ts_literal(now) if now is not None else None
    quality.dq_report(df, table_name, check_time=stamp).write.mode("append").parquet(
        f"{root}/quality/etl_data_quality_log")


def read_quality_log(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/quality/etl_data_quality_log")


def reset_layers(spark: SparkSession, root: str) -> None:
    """Drop every layer (gold first, then silver, then bronze) and the
    quarantine; the quality log is kept."""
    for layer in ("gold_periods", "gold", "silver", "bronze", "quarantine"):
        delete_path(spark, f"{root}/{layer}")


def bronze_table(spark: SparkSession, root: str, name: str) -> BronzeTable:
    return BronzeTable(spark, f"{root}/bronze/{name}", name)


# Partitioning of the keyed silver tables (derived from key columns only):
# trades by trade month, the others by a hash bucket of the key.
SILVER_BUCKETS = 64


def _bucket(*cols):
    return lambda: F.pmod(F.xxhash64(*cols), F.lit(SILVER_BUCKETS)).cast("int")


SILVER_PARTS = {
    "clientaccount": ("client_bucket", _bucket("client_id")),
    "deposits": ("order_bucket", _bucket("order_id")),
    "tradeactivities": ("trade_month", lambda: F.date_format("trade_time", "yyyy-MM")),
}


def silver_table(spark: SparkSession, root: str, name: str):
    """Silver table handle: affiliates as a versioned snapshot (small),
    the keyed tables partitioned for touched-partition upserts."""
    if name in SILVER_PARTS:
        col, expr = SILVER_PARTS[name]
        return PartitionedTable(spark, f"{root}/silver/{name}", KEYS[name], col, expr, SILVER[name])
    return SnapshotTable(spark, f"{root}/silver/{name}", SILVER[name], KEYS[name])


def quarantine_table(spark: SparkSession, root: str, name: str, schema: T.StructType) -> BatchTable:
    return BatchTable(spark, f"{root}/quarantine/{name}", schema)


def run_bronze(spark: SparkSession, landing: str, root: str, *, as_of=None, days_back: int | None = None,
               load_time=None, layout: str = "hive", dt_unit: str = "day",
               strict: bool = False) -> dict[str, DataFrame]:
    """Load every endpoint (all affiliates in one scan each) as one committed batch of its bronze table.

    The pages are parsed once and split into rows, bad records and bad pages
    (``strict`` raises on a bad record instead, before anything is committed).
    Null counts, totals and failures are counted by the writing job; of the
    quality log only the duplicates need a look at the batch just written.
    """
    out = {}
    for endpoint, name in ENDPOINT_TABLES.items():
        table = bronze_table(spark, root, name)
        if not pages.landing_folders(spark, landing, endpoint, layout):     # not delivered: no batch, no quality row
            out[name] = table.read([])
            continue
        lines = pages.scan_lines(spark, landing, endpoint, layout=layout, as_of=as_of, days_back=days_back,
                                 load_time=load_time, dt_unit=dt_unit)

        def check(counts: dict, endpoint: str = endpoint) -> None:
            if strict and counts[pages.BAD_RECORD]:
                raise ValueError(f"{endpoint}: records with missing or unparseable required fields")
        last = table.last("load")
        commit = table.load(lines, "load", last["batch"] + 1 if last else 0, check)
        out[name] = table.read([commit])
        log_batch_quality(spark, root, table, commit, load_time)
        for kind, leaf in ((pages.BAD_RECORD, f"{endpoint}_records"), (pages.BAD_PAGE, endpoint)):
            if incoming(commit)[kind]:
                bad = table.lines(kind, [commit])
                quarantine_table(spark, root, leaf, bad.schema).write(bad, "load", commit["batch"])
    return out


def log_batch_quality(spark: SparkSession, root: str, table: BronzeTable, commit: dict, now=None) -> None:
    """Quality row of all records that came with a batch, before conflict handling, from the counts in its commit."""
    counts = incoming(commit)
    total = counts[pages.ROW] + counts[pages.BAD_RECORD]
    columns = [c for c in table.columns if c not in quality.LINEAGE_COLUMNS]
    records = table.lines(pages.BAD_RECORD, [commit]).select(table.columns)
    if not table.keys:      # rows under a key are different, and no bad record equals a row: it lacks a field that a row has
        records = table.read([commit]).unionByName(records)
    # Rows that a key turned away repeat one that is stored.
    turned_away = counts[pages.ROW] - commit["counts"].get("new_rows", counts[pages.ROW])
    duplicates = turned_away + quality.duplicates_of(records, columns)
    report = quality.measured_report(spark, table.name, total, {c: counts[f"null_{c}"] for c in table.columns}, duplicates,
                                     ts_literal(now) if now is not None else None)
    report.write.mode("append").parquet(f"{root}/quality/etl_data_quality_log")


# What silver reads of each bronze table: its rules, its source select, its conflict rules, and the parent its rows need.
SILVER_INPUTS = {"bronze_customers": "clientaccount", "bronze_deposits": "deposits", "bronze_trades": "tradeactivities"}


def silver_runs(spark: SparkSession, root: str) -> CommitLog:
    """Log of silver runs: what of bronze each has consumed."""
    return CommitLog(spark, f"{root}/silver/_runs")


def pending_table(spark: SparkSession, root: str, name: str) -> SnapshotTable:
    """Rows of ``deposits`` or ``tradeactivities`` whose client is not known (yet)."""
    return SnapshotTable(spark, f"{root}/quarantine/{name}_orphans", SILVER[name], KEYS[name])


def _checked(spark: SparkSession, root: str, name: str, rows: DataFrame, run: int, strict: bool) -> DataFrame:
    """The rows that meet the rules of their table; the others stand in this run's quarantine batch."""
    valid, failed = quality.split_valid(rows, record_rules()[name])
    if strict and not failed.isEmpty():
        raise ValueError(f"{name}: records that break the rules")
    quarantine_table(spark, root, f"{name}_rules", failed.schema).write(failed, "silver", run)
    return valid


def _staged(spark: SparkSession, root: str, name: str, rows: DataFrame) -> tuple[DataFrame, str]:
    """``rows`` written once beside the silver tables, as several steps of a run read them; the folder goes with the run."""
    path = f"{root}/silver/{name}.__candidates/{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path), path


def _split_known(spark: SparkSession, root: str, name: str, candidates: DataFrame, clients: DataFrame,
                 strict: bool) -> tuple[DataFrame, DataFrame, str]:
    """(rows of known clients, orphans, folder of both), from one pass over the candidates."""
    known = clients.select("client_id").distinct().withColumn("known", F.lit(True))
    marked = candidates.join(known, "client_id", "left").select(*candidates.columns, F.coalesce("known", F.lit(False)).alias("known"))
    rows, path = _staged(spark, root, name, marked)
    orphans = rows.filter(~F.col("known")).drop("known")
    if strict and not orphans.isEmpty():
        delete_path(spark, path)
        raise ValueError("foreign key violation: child rows without a parent")
    return rows.filter("known").drop("known"), orphans, path


def run_silver(spark: SparkSession, root: str, now=None, strict: bool = False, incremental: bool = False) -> dict[str, int]:
    """Affiliates -> clients -> deposits -> trades (parents first, for the foreign keys).

    ``incremental`` reads only the bronze batches committed since the last run
    (its high-water marks stand in the run's commit) and nothing at all if there
    are none; otherwise all of bronze is read again.  Rows that break a rule are
    quarantined under the run's number; rows of unknown clients are kept aside as
    one table that each run replaces, and enter silver when their client comes.
    A run that was interrupted is simply repeated: upserts give the same rows,
    and the quarantine of its number is replaced.  Returns the batches read by table.
    """
    log = silver_runs(spark, root)
    runs = log.entries()
    done = runs[max(runs)]["consumed"] if runs else {}
    tables = {name: bronze_table(spark, root, name) for name in SILVER_INPUTS}
    commits = {name: t.commits() for name, t in tables.items()}
    fresh = {name: [c for c in cs if not incremental or c["batch"] > done.get(name, {}).get(c["query"], -1)] for name, cs in commits.items()}
    if incremental and not any(fresh.values()):
        return {name: 0 for name in fresh}
    run, now_col = max(runs, default=-1) + 1, silver._stamp(now)
    rows = {name: _checked(spark, root, name, tables[name].read(fresh[name]), run, strict) for name in tables if fresh[name] or not incremental}
    changed, staged = [], []
    stored = {name: silver_table(spark, root, name) for name in ("clientaccount", "deposits", "tradeactivities")}
    touched: set[str] = set()      # months whose metrics this run can change, for the gold refresh
    if "bronze_customers" in rows:
        customers = rows["bronze_customers"]
        source, staging = _staged(spark, root, "clientaccount", silver.clients_source(customers, now))
        staged.append(staging)
        if incremental:
            touched |= refresh.months_of_clients(source, stored["clientaccount"].read(), stored["tradeactivities"].read(), stored["deposits"].read())
        aff, seen = silver_table(spark, root, "affiliateaccount"), silver.affiliates_source(customers, now)
        if aff.current_version() is None:
            aff.write(seen)
        else:
            aff.upsert(seen, silver.AFFILIATE_RULES, now_col)
        silver_table(spark, root, "clientaccount").upsert(source, silver.CLIENT_RULES, now_col, stored=True)
        changed += ["affiliateaccount", "clientaccount"]
    clients = silver_table(spark, root, "clientaccount").read()
    for name, target, source, latest, rules in (
            ("bronze_deposits", "deposits", silver.deposits_source, silver.latest_deposits, silver.DEPOSIT_RULES),
            ("bronze_trades", "tradeactivities", silver.trades_source, silver.latest_trades, silver.TRADE_RULES)):
        pending = pending_table(spark, root, target)
        waiting = pending.read() if incremental else None
        if waiting is not None and waiting.isEmpty():
            waiting = None
        if name not in rows and ("bronze_customers" not in rows or waiting is None):
            continue
        if name not in rows:
            candidates = waiting
        else:       # the source has one row a key already
            candidates = source(rows[name], now) if waiting is None else latest(source(rows[name], now).unionByName(waiting))
        known, orphans, staging = _split_known(spark, root, target, candidates, clients, strict)
        staged.append(staging)
        if incremental:
            touched |= (refresh.months_of_deposits(known, stored["deposits"].read()) if target == "deposits"
                        else refresh.months_in(known.select(refresh.month_of("trade_time"))))
        silver_table(spark, root, target).upsert(known, rules, now_col, stored=True)
        pending.write(orphans)
        changed.append(target)
    for path in staged:
        delete_path(spark, path)
    for name in changed:
        check_silver(spark, root, name, now)
    consumed = {name: {q: max(c["batch"] for c in cs if c["query"] == q) for q in {c["query"] for c in cs}} for name, cs in commits.items()}
    log.commit({"batch": run, "consumed": consumed, "touched": sorted(touched) if incremental else None})
    return {name: len(fresh[name]) for name in fresh}


def check_silver(spark: SparkSession, root: str, name: str, now=None, sample: int | None = None) -> None:
    """Quality row of a silver table: the ``sample`` most recently updated
    rows (key as tiebreak), or the whole table with ``sample=None``."""
    df = silver_table(spark, root, name).read()
    if sample is not None:
        df = quality.latest_sample(df, sample, [F.col("last_updated").desc(), *KEYS[name]])
    log_quality(spark, root, df, name, now)


def run_gold(spark: SparkSession, root: str, as_of) -> None:
    """Materialise the four gold views as snapshot tables."""
    s = {n: silver_table(spark, root, n).read() for n in SILVER_TABLES}
    bc = bronze_table(spark, root, "bronze_customers").read()
    daily = gold.gold_daily(s["clientaccount"], s["tradeactivities"], s["affiliateaccount"], as_of)
    views = {
        "gold_affiliate_daily_metrics": daily,
        "gold_affiliate_monthly_metrics": gold.gold_monthly(s["clientaccount"], s["tradeactivities"],
                                                            s["deposits"], s["affiliateaccount"], as_of),
        "gold_affiliate_performance": gold.gold_performance(s["affiliateaccount"], s["clientaccount"],
                                                            s["tradeactivities"], as_of),
    }
    for name, df in views.items():
        SnapshotTable(spark, f"{root}/gold/{name}").write(df)
    written_daily = SnapshotTable(spark, f"{root}/gold/gold_affiliate_daily_metrics").read()
    SnapshotTable(spark, f"{root}/gold/gold_etl_affiliate_dashboard").write(
        gold.gold_etl_dashboard(bc, s["clientaccount"], written_daily, s["affiliateaccount"], as_of))


def register_views(spark: SparkSession, root: str) -> None:
    """Make the materialised gold views readable by name in this session's SQL."""
    for name in GOLD_VIEWS:
        SnapshotTable(spark, f"{root}/gold/{name}").read().createOrReplaceTempView(name)


def run_all(spark: SparkSession, landing: str, root: str, as_of, *, days_back=None, now=None,
            dt_unit: str = "day", incremental: bool = False) -> None:
    run_bronze(spark, landing, root, as_of=as_of, days_back=days_back, load_time=now, dt_unit=dt_unit)
    run_silver(spark, root, now, incremental=incremental)
    run_gold(spark, root, as_of)


def table_counts(spark: SparkSession, root: str) -> DataFrame:
    """(layer, table_name, row_count) of every table under ``root``."""
    frames = [(("bronze", n), bronze_table(spark, root, n).read()) for n in ENDPOINT_TABLES.values()]
    frames += [(("silver", n), silver_table(spark, root, n).read()) for n in SILVER_TABLES]
    frames += [(("gold", n), SnapshotTable(spark, f"{root}/gold/{n}").read()) for n in GOLD_VIEWS]
    out = None
    for (layer, name), df in frames:
        c = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count")
        out = c if out is None else out.unionByName(c)
    return out


def _fixture_landing(spark: SparkSession, sf: str, landing: str, endpoints) -> None:
    names = {"customer_list": "customers", "deposits": "deposits", "trade_activities": "trades",
             "assets": "assets"}
    for endpoint in endpoints:
        pages.write_landing(getattr(fx, names[endpoint])(spark, sf, lineage=False), landing, endpoint,
                            request_time=fx.LOAD_TIME, dt_unit="year")


def _all_landed(spark: SparkSession, sf: str, name: str) -> tuple[str, str]:
    """Landing pages of all four endpoints, and the tables' root."""
    base = work_dir(spark, name)
    _fixture_landing(spark, sf, base + "/landing", ENDPOINT_TABLES)
    return base + "/landing", base + "/tables"


def q_run_bronze_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze job over all four endpoints, twice (the second load repeats every page): rows, clients,
    first and last load batch by table and affiliate; keyed tables keep the first arrival."""
    landing, root = _all_landed(spark, sf, "bronze_layer")
    for _ in range(2):
        run_bronze(spark, landing, root, load_time=fx.LOAD_TIME, dt_unit="year")
    out = None
    for name in ENDPOINT_TABLES.values():
        part = bronze_table(spark, root, name).read().groupBy(F.lit(name).alias("table_name"), "affiliate_id").agg(
            F.count(F.lit(1)).alias("row_count"), F.countDistinct("client_id").alias("clients"))
        out = part if out is None else out.unionByName(part)
    return out


def q_run_silver_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze + silver jobs over all four endpoints: the partitioned silver trade table."""
    landing, root = _all_landed(spark, sf, "silver_layer")
    run_bronze(spark, landing, root, load_time=fx.LOAD_TIME, dt_unit="year")
    run_silver(spark, root, fx.LOAD_TIME)
    return silver_table(spark, root, "tradeactivities").read()


def q_run_gold_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze + silver + gold jobs over all four endpoints: the materialised monthly view."""
    landing, root = _all_landed(spark, sf, "gold_layer")
    run_all(spark, landing, root, fx.AS_OF, now=fx.LOAD_TIME, dt_unit="year")
    return SnapshotTable(spark, f"{root}/gold/gold_affiliate_monthly_metrics").read()


# Fixed value: trades and customers up to here are delivered first.
FIRST_DELIVERY = "1998-01-01 00:00:00"


def _deliveries(spark: SparkSession, sf: str, base: str, after=None) -> str:
    """All trades and deposits of the first years, then the customers that the events announce, then the other trades
    and deposits; a bronze and an incremental silver run (and ``after``) follow each.  Returns the tables' root."""
    cut, root = ts_literal(FIRST_DELIVERY), base + "/tables"
    trades, deposits = fx.trades(spark, sf, lineage=False), fx.deposits(spark, sf, lineage=False)
    early = [(trades.filter(F.col("trade_time") < cut), "trade_activities"), (deposits.filter(F.col("deposit_time") < cut), "deposits")]
    late = [(trades.filter(F.col("trade_time") >= cut), "trade_activities"), (deposits.filter(F.col("deposit_time") >= cut), "deposits")]
    for n, delivery in enumerate((early, [(fx.customers_from_events(spark, sf), "customer_list")], late)):
        for rows, endpoint in delivery:
            pages.write_landing(rows, f"{base}/landing{n}", endpoint, request_time=fx.LOAD_TIME, dt_unit="year")
        run_bronze(spark, f"{base}/landing{n}", root, load_time=fx.LOAD_TIME, dt_unit="year")
        run_silver(spark, root, fx.LOAD_TIME, incremental=True)
        if after is not None:
            after(root)
    return root


def q_run_silver_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Three deliveries, a silver run after each that reads the new batches alone.  Rows that come before
    their clients wait, and enter silver with them; those whose client never comes still wait.  Returns all of them."""
    root = _deliveries(spark, sf, work_dir(spark, "silver_incremental"))
    out = None
    for name, at, amount in (("deposits", "deposit_time", "deposit_amount"), ("tradeactivities", "trade_time", "trade_volume")):
        for state, table in (("silver", silver_table(spark, root, name)), ("waiting", pending_table(spark, root, name))):
            rows = table.read().select(F.lit(name).alias("table_name"), F.lit(state).alias("state"), "client_id",
                                       F.col(at).alias("at"), F.col(amount).alias("amount"))
            out = rows if out is None else out.unionByName(rows)
    return out


def q_gold_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """The monthly view after three deliveries, each followed by a refresh of the months that it changed."""
    root = _deliveries(spark, sf, work_dir(spark, "gold_refresh"), lambda r: refresh.refresh_gold(spark, r, fx.AS_OF))
    return refresh.read_view(spark, root, "gold_affiliate_monthly_metrics")


def q_gold_refresh_daily(spark: SparkSession, sf: str) -> DataFrame:
    """The daily view, refreshed in the same way."""
    root = _deliveries(spark, sf, work_dir(spark, "gold_refresh"), lambda r: refresh.refresh_gold(spark, r, fx.AS_OF))
    return refresh.read_view(spark, root, "gold_affiliate_daily_metrics")


def q_run_all_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Fixture rows -> landing pages -> bronze -> silver -> gold; returns
    the row count of every table written."""
    base = work_dir(spark, "layers")
    landing, root = base + "/landing", base + "/tables"
    for endpoint, (name, _) in {"customer_list": ("customers", 0), "deposits": ("deposits", 0),
                                "trade_activities": ("trades", 0), "assets": ("assets", 0)}.items():
        pages.write_landing(getattr(fx, name)(spark, sf, lineage=False), landing, endpoint,
                            request_time=fx.LOAD_TIME, dt_unit="year")
    run_all(spark, landing, root, fx.AS_OF, now=fx.LOAD_TIME, dt_unit="year")
    register_views(spark, root)
    return table_counts(spark, root)
