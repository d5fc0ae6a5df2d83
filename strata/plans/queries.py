"""Registered queries: one callable per operator of the inventory.

Each callable takes ``(spark, sf_dir)``, reads the driver tables through the
fixture projections and returns a lazy DataFrame (queries over landing
files or streams first write those files under the shared work folder).
Output columns are aliased to match :mod:`strata.plans.oracle`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.expr import (days_before, epoch_ms_to_ts, parse_decimal, ratio_half_up, ts_literal,
                                   ts_to_epoch_ms, trunc_ntz)
from strata.operators import dedupe, quality
from strata.operators.paging import PagedTable
from strata.plans import gold, reports, silver
from strata.sources import fixtures as fx
from strata.sources import pages
from strata.session import work_dir

# The fixture clocks and batch boundaries used by the queries.
AS_OF = fx.AS_OF
NOW1 = dt.datetime(2001, 8, 1)
NOW2 = dt.datetime(2001, 8, 2)
SLICE = ("2000-01-01 00:00:00", "2000-04-01 00:00:00")
SLICE_CLIENT = "20"
LOOKBACK_DAYS = 365
DT_UNIT = "year"    # landing folders per year: the fixture history spans years
PAGE_NO, PAGE_ROWS = 3, 100
DEEP_PAGE = 50
SPLITS = {  # (end of first batch, start of second batch): overlapping loads
    "affiliates": ("1998-01-01 00:00:00", "1997-01-01 00:00:00"),
    "deposits": ("1998-01-01 00:00:00", "1997-07-01 00:00:00"),
    "trades": ("2000-01-01 00:00:00", "1999-07-01 00:00:00"),
}


def _before(df: DataFrame, col: str, t: str) -> DataFrame:
    return df.filter(F.col(col) < ts_literal(t))


def _from(df: DataFrame, col: str, t: str) -> DataFrame:
    return df.filter(F.col(col) >= ts_literal(t))


class Layers:
    """Lazy bronze / silver frames of one fixture directory.  Each frame is
    built once per query, so every branch of a plan uses the same subplan
    and Spark reuses its exchanges instead of recomputing them."""

    def __init__(self, spark: SparkSession, sf: str, now=NOW1):
        self.spark, self.sf, self.now = spark, sf, now
        self._memo: dict[str, DataFrame] = {}

    def _get(self, name, build):
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    def bronze_customers(self): return self._get("bc", lambda: fx.customers(self.spark, self.sf))
    def bronze_trades(self): return self._get("bt", lambda: fx.trades(self.spark, self.sf))
    def bronze_deposits(self): return self._get("bd", lambda: fx.deposits(self.spark, self.sf))
    def bronze_assets(self): return self._get("ba", lambda: fx.assets(self.spark, self.sf))

    def affiliates(self):
        return self._get("sa", lambda: silver.build_affiliates(self.bronze_customers(), self.now))

    def clients(self):
        return self._get("sc", lambda: silver.build_clients(self.bronze_customers(), self.now))

    def trades(self):
        return self._get("st", lambda: silver.build_trades(self.bronze_trades(), self.clients(), self.now)[0])

    def deposits(self):
        return self._get("sd", lambda: silver.build_deposits(self.bronze_deposits(), self.clients(), self.now)[0])

    def performance(self):
        return gold.gold_performance(self.affiliates(), self.clients(), self.trades(), AS_OF)

    def daily(self):
        return self._get("gd", lambda: gold.gold_daily(self.clients(), self.trades(), self.affiliates(), AS_OF))

    def dashboard(self):
        return gold.gold_etl_dashboard(self.bronze_customers(), self.clients(), gold.affiliates_in_daily(self.clients()),
                                       self.affiliates(), AS_OF)


# --- sources ------------------------------------------------------------------

_SCAN_SOURCES = {
    "customer_list": ("customers", ["affiliate_id", "client_id", "register_time"]),
    "deposits": ("deposits", ["affiliate_id", "order_id", "client_id", "deposit_time", "deposit_coin",
                              "deposit_amount"]),
    "trade_activities": ("trades", ["affiliate_id", "client_id", "trade_volume", "trade_time"]),
    "assets": ("assets", ["affiliate_id", "client_id", "balance", "update_time", "remark"]),
}


def _landing(spark: SparkSession, sf: str, endpoint: str) -> str:
    """Write the fixture rows of ``endpoint`` as landing pages; return root."""
    root = work_dir(spark, "landing")
    name, cols = _SCAN_SOURCES[endpoint]
    rows = getattr(fx, name)(spark, sf, lineage=False)
    pages.write_landing(rows, root, endpoint, request_time=NOW1, dt_unit=DT_UNIT)
    return root


def _scan(endpoint: str) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark: SparkSession, sf: str) -> DataFrame:
        root = _landing(spark, sf, endpoint)
        scan = pages.scan_pages(spark, root, endpoint, load_time=NOW1, dt_unit=DT_UNIT)
        return scan.rows.select(*_SCAN_SOURCES[endpoint][1], "load_status")
    return q


def q_lookback_filter(spark, sf):
    root = _landing(spark, sf, "trade_activities")
    scan = pages.scan_pages(spark, root, "trade_activities", as_of=AS_OF, days_back=LOOKBACK_DAYS,
                            load_time=NOW1, dt_unit=DT_UNIT)
    return scan.rows.select("affiliate_id", "client_id", "trade_volume", "trade_time")


def q_discover_affiliates(spark, sf):
    return pages.discover_affiliates(spark, _landing(spark, sf, "customer_list"))


def q_landing_write(spark, sf):
    root = _landing(spark, sf, "deposits")
    return pages.landing_summary(spark, root, "deposits").select("affiliate_id", "endpoint", "dt", "records")


def q_corrupt_quarantine(spark, sf):
    """Landing folders that also hold HTML error pages (the ``pages`` table)
    instead of JSON: the scan loads the valid pages and quarantines every
    unreadable line.  Records per affiliate and kind."""
    root = _landing(spark, sf, "trade_activities")
    junk = fx.table(spark, sf, "pages").select(
        F.col("html"), (F.col("page_id") % fx.AFFILIATE_SPREAD).cast("string").alias("affiliate_id"),
        F.lit("trade_activities").alias("endpoint"), F.lit(AS_OF).alias("dt"))
    junk.write.mode("append").partitionBy("affiliate_id", "endpoint", "dt").text(root)
    scan = pages.scan_pages(spark, root, "trade_activities", load_time=NOW1, dt_unit=DT_UNIT)
    valid = scan.rows.groupBy("affiliate_id").agg(F.count(F.lit(1)).alias("records")) \
        .select("affiliate_id", F.lit("valid").alias("kind"), "records")
    bad = scan.quarantine.groupBy("affiliate_id").agg(F.count(F.lit(1)).alias("records")) \
        .select("affiliate_id", F.lit("corrupt").alias("kind"), "records")
    return valid.unionByName(bad)


def q_validate_envelope(spark, sf):
    """Response-code check over every landing page: records per folder and
    code validity."""
    root = _landing(spark, sf, "trade_activities")
    env = pages.validate_envelope(pages.read_envelopes(spark, root, "trade_activities"))
    return (env.groupBy("affiliate_id", "dt", "code_valid")
            .agg(F.sum(F.size("data")).cast("long").alias("records")))


def q_batch_metadata(spark, sf):
    root = _landing(spark, sf, "trade_activities")
    rows = pages.scan_pages(spark, root, "trade_activities", load_time=NOW1, dt_unit=DT_UNIT).rows
    return pages.batch_metadata(rows, "trade_activities")


# --- sinks / bronze -----------------------------------------------------------

def q_bronze_insert_ignore(spark, sf):
    """Two overlapping deposit loads into an insert-once table keyed on
    order_id: first batch then the second, first row per key wins."""
    dep = fx.deposits(spark, sf, lineage=False)
    arrival = [F.col("deposit_time").asc(), F.col("deposit_amount").asc(), F.col("client_id").asc(),
               F.col("deposit_coin").asc()]
    b1 = _before(dep, "deposit_time", SPLITS["deposits"][0]).withColumn("load_batch", F.lit(1))
    b2 = _from(dep, "deposit_time", SPLITS["deposits"][1]).withColumn("load_batch", F.lit(2))
    t1 = dedupe.insert_ignore(None, b1, ["order_id"], arrival)
    delta2 = dedupe.insert_ignore(t1, b2, ["order_id"], arrival)
    return t1.unionByName(delta2)


def q_bronze_append(spark, sf):
    """Trades have no natural key: overlapping loads append duplicates."""
    tr = fx.trades(spark, sf, lineage=False)
    b1 = _before(tr, "trade_time", SPLITS["trades"][0]).withColumn("load_batch", F.lit(1))
    b2 = _from(tr, "trade_time", SPLITS["trades"][1]).withColumn("load_batch", F.lit(2))
    return b1.unionByName(b2)


# --- projections ----------------------------------------------------------------

def q_epoch_ms_to_ts(spark, sf):
    e = fx.table(spark, sf, "events")
    ms = ts_to_epoch_ms(F.col("ts")).cast("string")
    return e.select("event_id", ms.alias("ts_ms")).select("event_id", "ts_ms", epoch_ms_to_ts("ts_ms").alias("ts"))


def q_parse_amount(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     parse_decimal(F.col("l_extendedprice").cast("string")).alias("amount"))


def q_trunc_day_month(spark, sf):
    o = fx.table(spark, sf, "orders")
    return o.select("o_orderkey", trunc_ntz("day", "o_orderdate").alias("trade_day"),
                    trunc_ntz("month", "o_orderdate").alias("trade_month"))


# --- filters --------------------------------------------------------------------

def q_trailing_30d(spark, sf):
    t = Layers(spark, sf).trades()
    return t.filter(F.col("trade_time") >= days_before(AS_OF, 30)).select("client_id", "trade_time", "trade_volume")


def q_time_slice(spark, sf):
    return reports.time_slice(fx.trades(spark, sf, lineage=False), "trade_time", *SLICE)


def q_page_read(spark, sf):
    c = fx.customers(spark, sf, lineage=False)
    return reports.page_read(c, [F.col("client_id").asc()], PAGE_NO, PAGE_ROWS)


def q_page_read_ranges(spark, sf):
    """A page deep in all deposits, by time and order, from a range-partitioned copy: one or two ranges are read."""
    table = PagedTable(spark, work_dir(spark, "paged_deposits"))
    table.write(fx.deposits(spark, sf, lineage=False), [F.col("deposit_time").asc(), F.col("order_id").asc()])
    return table.page(DEEP_PAGE, PAGE_ROWS)


# --- joins ----------------------------------------------------------------------

def q_join_trades_clients(spark, sf):
    L = Layers(spark, sf)
    return gold.with_affiliate(L.trades(), L.clients()).select("client_id", "trade_time", "trade_volume",
                                                               "affiliate_id")


def q_join_deposits_clients(spark, sf):
    L = Layers(spark, sf)
    return gold.with_affiliate(L.deposits(), L.clients()).select(
        "order_id", "client_id", "deposit_time", "deposit_coin", "deposit_amount", "affiliate_id")


def q_active_clients_exists(spark, sf):
    L = Layers(spark, sf)
    m = gold.affiliate_metrics(L.affiliates(), L.clients(), L.trades(), AS_OF)
    return m.select("affiliate_id", "active_customers_30d")


def q_new_customers_anti(spark, sf):
    """Customers that the asset feed has not seen."""
    return dedupe.new_keys(fx.customers(spark, sf, lineage=False), fx.assets(spark, sf, lineage=False), ["client_id"])


def _fk(spark, sf):
    """All trades against the clients of the event feed, to which most traders are unknown."""
    tr = fx.trades(spark, sf, lineage=False).select("client_id", "trade_time", "trade_volume")
    return quality.fk_split(tr, silver.build_clients(fx.customers_from_events(spark, sf), NOW1), ["client_id"], prefilter=True)


def q_fk_valid(spark, sf):
    return _fk(spark, sf)[0]


def q_fk_orphans(spark, sf):
    return _fk(spark, sf)[1]


# --- aggregations -----------------------------------------------------------------

def q_daily_signups(spark, sf): return gold.daily_signups(Layers(spark, sf).clients())
def q_monthly_signups(spark, sf): return gold.monthly_signups(Layers(spark, sf).clients())


def q_daily_trades(spark, sf):
    L = Layers(spark, sf)
    return gold.daily_trades(L.trades(), L.clients())


def q_monthly_trades(spark, sf):
    L = Layers(spark, sf)
    return gold.monthly_trades(L.trades(), L.clients())


def q_monthly_deposits(spark, sf):
    L = Layers(spark, sf)
    return gold.monthly_deposits(L.deposits(), L.clients())


def q_trading_30d(spark, sf):
    L = Layers(spark, sf)
    return gold.trading_metrics(L.clients(), L.trades(), AS_OF)


def q_trading_30d_per_trader(spark, sf):
    L = Layers(spark, sf)
    return gold.trading_metrics_per_trader(L.clients(), L.trades(), AS_OF)


def q_layer_counts(spark, sf):
    L = Layers(spark, sf)
    return gold.layer_counts(L.bronze_customers(), L.clients())


def _trade_batches(spark, sf):
    tr = fx.trades(spark, sf)
    first, second = SPLITS["trades"]
    clients = Layers(spark, sf).clients()
    target, _ = silver.build_trades(_before(tr, "trade_time", first), clients, NOW1)
    src = _from(tr, "trade_time", second)
    return target, src, clients


def q_load_summary(spark, sf):
    """Row counts of an upsert: before, after, inserted, updated keys."""
    target, src, clients = _trade_batches(spark, sf)
    keys = ["client_id", "trade_time"]
    after, _ = silver.build_trades(src, clients, NOW2, target=target)
    incoming = silver.enforce_clients(silver.trades_source(src, NOW2), clients)[0].select(*keys)
    parts = [target.agg(F.count(F.lit(1)).alias("value")).select(F.lit("rows_before").alias("metric"), "value"),
             after.agg(F.count(F.lit(1)).alias("value")).select(F.lit("rows_after").alias("metric"), "value"),
             incoming.join(target.select(*keys), keys, "left_anti").agg(F.count(F.lit(1)).alias("value"))
             .select(F.lit("inserted").alias("metric"), "value"),
             incoming.join(target.select(*keys), keys, "left_semi").agg(F.count(F.lit(1)).alias("value"))
             .select(F.lit("updated").alias("metric"), "value")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- windows / dedupe ---------------------------------------------------------------

def q_latest_customers(spark, sf):
    return silver.latest_customers(fx.customers(spark, sf, lineage=False))


def q_latest_deposits(spark, sf):
    return silver.latest_deposits(fx.deposits(spark, sf, lineage=False))


def q_latest_trades(spark, sf):
    return silver.latest_trades(fx.trades(spark, sf, lineage=False))


def q_seen_keys_union(spark, sf):
    """Clients seen by any feed: customers, trades and asset updates, all of them."""
    return dedupe.union_keys(fx.customers(spark, sf, lineage=False), fx.trades(spark, sf, lineage=False),
                             fx.assets(spark, sf, lineage=False), keys=["client_id"])


# --- silver first loads and upserts ---------------------------------------------------

def q_silver_affiliates(spark, sf): return Layers(spark, sf).affiliates()
def q_silver_customers(spark, sf): return Layers(spark, sf).clients()
def q_silver_deposits(spark, sf): return Layers(spark, sf).deposits()
def q_silver_trades(spark, sf): return Layers(spark, sf).trades()


def q_upsert_affiliates(spark, sf):
    c = fx.customers(spark, sf)
    first, second = SPLITS["affiliates"]
    target = silver.build_affiliates(_before(c, "register_time", first), NOW1)
    return silver.build_affiliates(_from(c, "register_time", second), NOW2, target=target)


def q_upsert_customers(spark, sf):
    target = silver.build_clients(fx.customers(spark, sf), NOW1)
    return silver.build_clients(fx.customers_from_orders(spark, sf), NOW2, target=target)


def q_upsert_deposits(spark, sf):
    d = fx.deposits(spark, sf)
    clients = Layers(spark, sf).clients()
    first, second = SPLITS["deposits"]
    target, _ = silver.build_deposits(_before(d, "deposit_time", first), clients, NOW1)
    return silver.build_deposits(_from(d, "deposit_time", second), clients, NOW2, target=target)[0]


def q_upsert_trades(spark, sf):
    target, src, clients = _trade_batches(spark, sf)
    return silver.build_trades(src, clients, NOW2, target=target)[0]


# --- gold and reports ------------------------------------------------------------------

def q_gold_daily(spark, sf): return Layers(spark, sf).daily()


def q_gold_monthly(spark, sf):
    L = Layers(spark, sf)
    return gold.gold_monthly(L.clients(), L.trades(), L.deposits(), L.affiliates(), AS_OF)


def q_gold_monthly_merged(spark, sf):
    L = Layers(spark, sf)
    return gold.gold_monthly_merged(L.clients(), L.trades(), L.deposits(), L.affiliates(), AS_OF)


def q_gold_performance(spark, sf): return Layers(spark, sf).performance()
def q_gold_etl_dashboard(spark, sf): return Layers(spark, sf).dashboard()
def q_report_etl_status(spark, sf): return reports.report_etl_status(Layers(spark, sf).dashboard())
def q_top_affiliates(spark, sf): return reports.top_affiliates(Layers(spark, sf).performance(), 10)
def q_view_top_affiliates(spark, sf):
    """The top affiliates, selected in SQL from the performance view by its name."""
    Layers(spark, sf).performance().createOrReplaceTempView("gold_affiliate_performance")
    return spark.sql("""
        SELECT affiliate_name, new_signups_30d, trading_volume_30d FROM gold_affiliate_performance
        WHERE affiliate_name IS NOT NULL ORDER BY trading_volume_30d DESC NULLS FIRST, affiliate_name LIMIT 10""")


def q_report_etl_issues(spark, sf): return reports.report_etl_issues(Layers(spark, sf).dashboard())


def q_report_affiliate_metrics(spark, sf):
    return reports.report_affiliate_metrics(Layers(spark, sf).performance())


# --- data quality ------------------------------------------------------------------------

def q_dq_null_pct(spark, sf):
    p = quality.null_profile(fx.documents_labeled(spark, sf))
    return p.select("column_name", "total_records", "null_count",
                    ratio_half_up(F.col("null_count") * 100, "total_records", 4).alias("null_pct"))


def q_dq_duplicate_pct(spark, sf):
    d = fx.documents_labeled(spark, sf)
    s = quality.duplicate_stats(d, ["lang", "source", "quality", "toxic"])
    return s.select("total_records", "duplicate_count",
                    ratio_half_up(F.col("duplicate_count") * 100, "total_records", 4).alias("duplicate_pct"))


def q_dq_report(spark, sf):
    d = fx.documents_labeled(spark, sf)
    r = quality.dq_report(d, "documents_labeled", check_time=ts_literal(NOW1))
    return r.select("table_name", "check_timestamp", "total_records",
                    ratio_half_up(F.col("duplicate_count") * 100, "total_records", 4).alias("duplicate_percentage"),
                    "validation_passed", F.size("issues").alias("issue_count"),
                    F.array_join("issues", " | ").alias("issues_text"))


def q_dq_sample(spark, sf):
    """Quality row of the 1000 most recently updated silver trades after an
    upsert (key as tiebreak)."""
    sample = quality.latest_sample(q_upsert_trades(spark, sf), 1000,
                                   [F.col("last_updated").desc(), "client_id", "trade_time"])
    r = quality.dq_report(sample, "tradeactivities", check_time=ts_literal(NOW2))
    return r.select("table_name", "check_timestamp", "total_records",
                    ratio_half_up(F.col("duplicate_count") * 100, "total_records", 4).alias("duplicate_percentage"), "validation_passed",
                    F.size("issues").alias("issue_count"), F.array_join("issues", " | ").alias("issues_text"))


def q_dq_log(spark, sf):
    """Quality row of an incoming bronze batch written through the quality
    log sink and read back."""
    from strata.plans import jobs
    root = work_dir(spark, "dq_log")
    jobs.log_quality(spark, root, fx.deposits(spark, sf), "bronze_deposits", NOW1)
    log = jobs.read_quality_log(spark, root)
    return log.select("table_name", "total_records", ratio_half_up(F.col("duplicate_count") * 100, "total_records", 4).alias("duplicate_percentage"),
                      "validation_passed", F.size("issues").alias("issue_count"))


def q_dq_bronze(spark, sf):
    """Quality row of an incoming bronze batch, before conflict handling."""
    r = quality.dq_report(fx.deposits(spark, sf), "bronze_deposits", check_time=ts_literal(NOW1))
    return r.select("table_name", "total_records", ratio_half_up(F.col("duplicate_count") * 100, "total_records", 4).alias("duplicate_percentage"),
                    "validation_passed", F.size("issues").alias("issue_count"))


def deposit_rules() -> dict:
    """Record constraints of a bronze deposit (model rules and the silver
    column limits)."""
    return {
    "load_status_known": F.col("load_status").isin("SUCCESS", "ERROR", "PARTIAL"),
    "amount_non_negative": F.col("deposit_amount") >= 0,
    "order_id_present": F.col("order_id").isNotNull(),
    "client_id_present": F.col("client_id").isNotNull(),
    "coin_present": F.col("deposit_coin").isNotNull(),
    "coin_fits_silver": F.length("deposit_coin") <= 10,
    "amount_fits_silver": F.col("deposit_amount").try_cast("decimal(18,8)").isNotNull(),
    }


def q_validate_records(spark, sf):
    d = fx.deposits(spark, sf)
    v = quality.validate_records(d, deposit_rules())
    return v.select("order_id", "client_id", "deposit_amount", "is_valid",
                    F.array_join("failed_rules", ",").alias("failed_rules"))


def q_validate_counts(spark, sf):
    r = reports.report_etl_status(Layers(spark, sf).dashboard())
    return r.select("data_source", "total_records", "success_count", "error_count", "partial_count",
                    quality.counts_consistent("total_records", ["success_count", "error_count", "partial_count"])
                    .alias("counts_consistent"))


def q_check_pk(spark, sf):
    return quality.check_pk(fx.deposits(spark, sf, lineage=False), ["order_id"])


def q_check_constraints(spark, sf):
    d = fx.deposits(spark, sf)
    row_checks = quality.constraint_violations(d, deposit_rules())
    pk = quality.check_pk(d, ["order_id"]).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("violations")) \
        .select(F.lit("order_id_unique").alias("constraint_name"), "violations")
    known = silver.build_clients(fx.customers_from_events(spark, sf), NOW1)
    fk = quality.fk_split(d, known, ["client_id"], prefilter=True)[1].agg(F.count(F.lit(1)).alias("violations")) \
        .select(F.lit("client_id_known").alias("constraint_name"), "violations")
    return row_checks.unionByName(pk).unionByName(fk)


# --- the same operators on rows with both outcomes -------------------------------------------

def q_latest_customers_feeds(spark, sf):
    """Keep-latest over three customer feeds that announce most clients many times, under several affiliates."""
    cols = ["affiliate_id", "client_id", "register_time"]
    feeds = (fx.customers(spark, sf, lineage=False).select(cols).unionByName(fx.customers_from_orders(spark, sf).select(cols))
             .unionByName(fx.customers_from_events(spark, sf).select(cols)))
    return silver.latest_customers(feeds)


def _mixed_dashboard(spark, sf):
    """Layers that know different affiliates: bronze those of the parts (by size), silver those of the customers
    (by nation), gold those of the events (by user): every rung of the status ladder occurs."""
    bronze = fx.table(spark, sf, "part").select(F.col("p_size").cast("string").alias("affiliate_id"), F.col("p_partkey").cast("string").alias("client_id"))
    daily = fx.table(spark, sf, "events").select((F.col("user_id") % 15).cast("string").alias("affiliate_id"))
    L = Layers(spark, sf)
    return gold.gold_etl_dashboard(bronze, L.clients(), daily, L.affiliates(), AS_OF)


def q_etl_dashboard_mixed(spark, sf): return _mixed_dashboard(spark, sf)
def q_report_etl_issues_mixed(spark, sf): return reports.report_etl_issues(_mixed_dashboard(spark, sf))


def q_validate_records_mixed(spark, sf):
    """Record rules over account balances as deposits: some are negative, suppliers have no coin, and the part names are too long for one."""
    def feed(table, key, amount, coin):
        t = fx.table(spark, sf, table)
        return t.select(F.concat(F.lit(f"{table}-"), F.col(key).cast("string")).alias("order_id"),
                        F.when(F.col(key) % 10 != 0, F.col(key).cast("string")).alias("client_id"),
                        coin.alias("deposit_coin"), F.col(amount).cast("decimal(20,8)").alias("deposit_amount"),
                        F.when(F.col(key) % 7 != 0, F.lit("SUCCESS")).otherwise(F.lit("LOST")).alias("load_status"))
    rows = (feed("customer", "c_custkey", "c_acctbal", F.col("c_mktsegment"))
            .unionByName(feed("supplier", "s_suppkey", "s_acctbal", F.lit(None).cast("string")))
            .unionByName(feed("part", "p_partkey", "p_retailprice", F.col("p_name"))))
    v = quality.validate_records(rows, deposit_rules())
    return v.select("order_id", "client_id", "deposit_amount", "is_valid", F.array_join("failed_rules", ",").alias("failed_rules"))


def q_validate_counts_mixed(spark, sf):
    """Count consistency of each supplier's lines: total against returned, open and discounted ones, which overlap for some."""
    flag = lambda c: F.sum(c.cast("int")).cast("long")
    r = fx.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("total_records"), flag(F.col("l_returnflag") == "N").alias("success_count"),
        flag(F.col("l_returnflag") == "R").alias("error_count"),
        flag((F.col("l_returnflag") == "A") & (F.col("l_suppkey") % 2 == 0) | (F.col("l_discount") > 0.09) & (F.col("l_suppkey") % 3 == 0)).alias("partial_count"))
    return r.select("*", quality.counts_consistent("total_records", ["success_count", "error_count", "partial_count"]).alias("counts_consistent"))


def q_validate_envelope_mixed(spark, sf):
    """Response codes over landing pages of which the error events answer with a word, one page an event."""
    root = work_dir(spark, "codes")
    e = fx.table(spark, sf, "events")
    code = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.lit(pages.OK_CODE))
    page = F.to_json(F.struct(code.alias("code"), F.array(F.struct(F.col("user_id").cast("string").alias("uid"))).alias("data")))
    e.select((F.col("user_id") % fx.AFFILIATE_SPREAD).cast("string").alias("affiliate_id"), F.lit("assets").alias("endpoint"),
             F.to_date("ts").alias("dt"), page.alias("value")).write.partitionBy("affiliate_id", "endpoint", "dt").text(root)
    env = pages.validate_envelope(pages.read_envelopes(spark, root, "assets"))
    return env.groupBy("affiliate_id", "dt", "code_valid").agg(F.sum(F.size("data")).cast("long").alias("records"))


def q_time_slice_client(spark, sf):
    """The deposits of one client in a time slice."""
    return reports.time_slice(fx.deposits(spark, sf, lineage=False), "deposit_time", *SLICE, client_id=SLICE_CLIENT)


def q_batch_log(spark, sf):
    """Batch log of deposit pages, one page an order: records, pages, first and last event, record time as ISO text."""
    root = work_dir(spark, "batch_log")
    d = fx.deposits(spark, sf, lineage=False)
    record = F.struct(F.col("order_id").alias("orderId"), F.col("client_id").alias("uid"), ts_to_epoch_ms("deposit_time").cast("string").alias("depositTime"),
                      F.col("deposit_coin").alias("depositCoin"), F.col("deposit_amount").cast("string").alias("depositAmount"))
    page = F.to_json(F.struct(F.lit(pages.OK_CODE).alias("code"), F.collect_list(record).alias("data")))     # the lines of an order
    (d.groupBy("affiliate_id", F.split("order_id", "-")[0].alias("order")).agg(page.alias("value"))
     .select("affiliate_id", F.lit("deposits").alias("endpoint"), F.lit(AS_OF).alias("dt"), "value")
     .write.partitionBy("affiliate_id", "endpoint", "dt").text(root))
    return pages.batch_log(pages.scan_lines(spark, root, "deposits", load_time=NOW1), "deposits", NOW1)


def q_gold_daily_sorted(spark, sf): return reports.in_order(q_gold_daily(spark, sf), "gold_affiliate_daily_metrics")
def q_gold_monthly_sorted(spark, sf): return reports.in_order(q_gold_monthly(spark, sf), "gold_affiliate_monthly_metrics")
def q_gold_etl_dashboard_sorted(spark, sf): return reports.in_order(_mixed_dashboard(spark, sf), "gold_etl_affiliate_dashboard")


def q_dq_log_text(spark, sf):
    """The quality log as exported: null percentages as JSON text, issues as one text."""
    from strata.plans import jobs
    root = work_dir(spark, "dq_log_text")
    jobs.log_quality(spark, root, fx.documents_labeled(spark, sf).select("lang", "source", "n_chars"), "documents", NOW1)
    return quality.log_as_text(jobs.read_quality_log(spark, root)).select("table_name", "total_records", "null_percentages", "issues", "validation_passed")


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from strata.streaming import ingest as st
    from strata.plans import jobs
    return {
        "scan_customers": _scan("customer_list"),
        "scan_deposits": _scan("deposits"),
        "scan_trades": _scan("trade_activities"),
        "scan_assets": _scan("assets"),
        "lookback_filter": q_lookback_filter,
        "discover_affiliates": q_discover_affiliates,
        "landing_write": q_landing_write,
        "batch_metadata": q_batch_metadata,
        "validate_envelope": q_validate_envelope,
        "corrupt_quarantine": q_corrupt_quarantine,
        "bronze_insert_ignore": q_bronze_insert_ignore,
        "bronze_append": q_bronze_append,
        "epoch_ms_to_ts": q_epoch_ms_to_ts,
        "parse_amount": q_parse_amount,
        "trunc_day_month": q_trunc_day_month,
        "trailing_30d": q_trailing_30d,
        "time_slice": q_time_slice,
        "page_read": q_page_read,
        "page_read_ranges": q_page_read_ranges,
        "join_trades_clients": q_join_trades_clients,
        "join_deposits_clients": q_join_deposits_clients,
        "active_clients_exists": q_active_clients_exists,
        "new_customers_anti": q_new_customers_anti,
        "fk_valid": q_fk_valid,
        "fk_orphans": q_fk_orphans,
        "daily_signups": q_daily_signups,
        "monthly_signups": q_monthly_signups,
        "daily_trades": q_daily_trades,
        "monthly_trades": q_monthly_trades,
        "monthly_deposits": q_monthly_deposits,
        "trading_30d": q_trading_30d,
        "trading_30d_per_trader": q_trading_30d_per_trader,
        "layer_counts": q_layer_counts,
        "load_summary": q_load_summary,
        "latest_customers": q_latest_customers,
        "latest_deposits": q_latest_deposits,
        "latest_trades": q_latest_trades,
        "seen_keys_union": q_seen_keys_union,
        "silver_affiliates": q_silver_affiliates,
        "silver_customers": q_silver_customers,
        "silver_deposits": q_silver_deposits,
        "silver_trades": q_silver_trades,
        "upsert_affiliates": q_upsert_affiliates,
        "upsert_customers": q_upsert_customers,
        "upsert_deposits": q_upsert_deposits,
        "upsert_trades": q_upsert_trades,
        "gold_daily": q_gold_daily,
        "gold_monthly": q_gold_monthly,
        "gold_monthly_merged": q_gold_monthly_merged,
        "gold_performance": q_gold_performance,
        "gold_etl_dashboard": q_gold_etl_dashboard,
        "report_etl_status": q_report_etl_status,
        "top_affiliates": q_top_affiliates,
        "view_top_affiliates": q_view_top_affiliates,
        "report_etl_issues": q_report_etl_issues,
        "report_affiliate_metrics": q_report_affiliate_metrics,
        "dq_null_pct": q_dq_null_pct,
        "dq_duplicate_pct": q_dq_duplicate_pct,
        "dq_report": q_dq_report,
        "dq_bronze": q_dq_bronze,
        "dq_sample": q_dq_sample,
        "dq_log": q_dq_log,
        "validate_records": q_validate_records,
        "validate_counts": q_validate_counts,
        "check_pk": q_check_pk,
        "check_constraints": q_check_constraints,
        "stream_ingest": st.q_stream_ingest,
        "stream_new_customers": st.q_stream_new_customers,
        "stream_trades_dedup": st.q_stream_trades_dedup,
        "stream_trades_upsert": st.q_stream_trades_upsert,
        "stream_daily_trades": st.q_stream_daily_trades,
        "stream_quarantine": st.q_stream_quarantine,
        "stream_late_rows": st.q_stream_late_rows,
        "stream_daily_affiliate": st.q_stream_daily_affiliate,
        "latest_customers_feeds": q_latest_customers_feeds,
        "etl_dashboard_mixed": q_etl_dashboard_mixed,
        "report_etl_issues_mixed": q_report_etl_issues_mixed,
        "validate_records_mixed": q_validate_records_mixed,
        "validate_counts_mixed": q_validate_counts_mixed,
        "validate_envelope_mixed": q_validate_envelope_mixed,
        "time_slice_client": q_time_slice_client,
        "batch_log": q_batch_log,
        "gold_daily_sorted": q_gold_daily_sorted,
        "gold_monthly_sorted": q_gold_monthly_sorted,
        "gold_etl_dashboard_sorted": q_gold_etl_dashboard_sorted,
        "dq_log_text": q_dq_log_text,
        "run_all_layers": jobs.q_run_all_layers,
        "run_bronze_layer": jobs.q_run_bronze_layer,
        "run_silver_layer": jobs.q_run_silver_layer,
        "run_gold_layer": jobs.q_run_gold_layer,
        "run_silver_incremental": jobs.q_run_silver_incremental,
        "gold_refresh": jobs.q_gold_refresh,
        "gold_refresh_daily": jobs.q_gold_refresh_daily,
    }
