"""Gold layer: metric views over silver (and bronze for pipeline status).

Views are functions returning lazy DataFrames; nothing is sorted inside a
view (sorting happens at the report boundary).  ``as_of`` replaces the
wall clock everywhere, so a view is reproducible.

Scale notes: every aggregate is keyed by (period, affiliate) or affiliate
and runs with partial aggregation before its shuffle, so a hot affiliate is
pre-reduced on the map side.  Trades and deposits are pre-aggregated per
(period, client) before they meet the client table (Spark does not push an
aggregate below a join by itself), so a client with a huge share of trades
reaches the join as one row per period; the join itself is an equi-join on
``client_id`` that AQE's skew handling can split further.  The affiliate dimension is joined last, after
aggregation, to a per-affiliate result; AQE turns that join into a
broadcast only when the runtime size is under its threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.expr import days_before, ratio_half_up, ts_literal, trunc_ntz

DEC = "decimal(28,8)"


def _zd() -> Column:
    return F.lit(0).cast(DEC)


def _now(as_of) -> Column:
    if as_of is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return ts_literal(as_of)


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0)).cast("long")


def _zero_dec(c: str) -> Column:
    return F.coalesce(F.col(c), _zd()).cast(DEC)


def with_affiliate(rows: DataFrame, clients: DataFrame) -> DataFrame:
    """Attach the client's affiliate (inner join on client_id): the
    affiliate on the silver client, not the one on the raw row."""
    return rows.join(clients.select("client_id", "affiliate_id"), on="client_id", how="inner")


def signups(clients: DataFrame, unit: str, name: str) -> DataFrame:
    return (clients.groupBy(trunc_ntz(unit, "register_time").alias(name), "affiliate_id")
            .agg(F.count(F.lit(1)).alias("new_signups")))


def daily_signups(clients: DataFrame) -> DataFrame:
    return signups(clients, "day", "date")


def monthly_signups(clients: DataFrame) -> DataFrame:
    return signups(clients, "month", "month")


def per_client(rows: DataFrame, ts_col: str, amount_col: str, unit: str | None, name: str | None) -> DataFrame:
    """Pre-aggregate facts per (period, client) *before* they meet the client
    table: a client with millions of trades leaves the map side as one row
    per period (partial aggregation), so neither the join nor the final
    aggregate sees the hot key.  Counts and decimal sums stay exact."""
    keys = ["client_id"] if unit is None else [trunc_ntz(unit, ts_col).alias(name), "client_id"]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.sum(amount_col).alias("__v"))


def daily_trades(trades: DataFrame, clients: DataFrame) -> DataFrame:
    pc = per_client(trades, "trade_time", "trade_volume", "day", "date")
    return (with_affiliate(pc, clients).groupBy("date", "affiliate_id")
            .agg(F.sum("__n").cast("long").alias("total_trades"),
                 F.sum("__v").cast(DEC).alias("total_volume")))


def monthly_trades(trades: DataFrame, clients: DataFrame) -> DataFrame:
    """Per (month, affiliate): trades, volume and distinct traders; after the
    per-client pre-aggregation each (month, client) is one row, so distinct
    traders is a plain count."""
    pc = per_client(trades, "trade_time", "trade_volume", "month", "month")
    return (with_affiliate(pc, clients).groupBy("month", "affiliate_id")
            .agg(F.sum("__n").cast("long").alias("total_trades"),
                 F.sum("__v").cast(DEC).alias("total_volume"),
                 F.count(F.lit(1)).alias("active_traders")))


def monthly_deposits(deposits: DataFrame, clients: DataFrame) -> DataFrame:
    pc = per_client(deposits, "deposit_time", "deposit_amount", "month", "month")
    return (with_affiliate(pc, clients).groupBy("month", "affiliate_id")
            .agg(F.sum("__n").cast("long").alias("total_deposits"),
                 F.sum("__v").cast(DEC).alias("deposit_volume")))


def _prefixed(df: DataFrame, p: str) -> DataFrame:
    return df.select(*[F.col(c).alias(p + c) for c in df.columns])


def _name_lookup(df: DataFrame, affiliates: DataFrame) -> DataFrame:
    dim = affiliates.select("affiliate_id", F.col("name").alias("affiliate_name"))
    return df.join(dim, on="affiliate_id", how="left")


def gold_daily(clients: DataFrame, trades: DataFrame, affiliates: DataFrame, as_of=None, signed_up: DataFrame | None = None) -> DataFrame:
    """Daily signups and trading per affiliate (full outer on (date, affiliate)).  ``signed_up``: the
    clients whose signup counts, if not all."""
    s = _prefixed(daily_signups(clients if signed_up is None else signed_up), "s_")
    t = _prefixed(daily_trades(trades, clients), "t_")
    j = s.join(t, (s.s_date == t.t_date) & (s.s_affiliate_id == t.t_affiliate_id), "full")
    base = j.select(F.coalesce("s_date", "t_date").alias("date"),
                    F.coalesce("s_affiliate_id", "t_affiliate_id").alias("affiliate_id"),
                    _zero("s_new_signups").alias("new_signups"),
                    _zero("t_total_trades").alias("total_trades"),
                    _zero_dec("t_total_volume").alias("total_volume"))
    return _name_lookup(base, affiliates).select(
        "date", "affiliate_id", "affiliate_name", "new_signups", "total_trades", "total_volume",
        _now(as_of).alias("last_updated"), F.lit("daily_metrics").alias("view_type"))


def gold_monthly(clients: DataFrame, trades: DataFrame, deposits: DataFrame, affiliates: DataFrame,
                 as_of=None, signed_up: DataFrame | None = None) -> DataFrame:
    """Monthly metrics, faithful chained full outer join: the deposit branch
    is matched to the *signup* branch only, so a month/affiliate with trades
    and deposits but no signups yields two rows."""
    s = _prefixed(monthly_signups(clients if signed_up is None else signed_up), "s_")
    t = _prefixed(monthly_trades(trades, clients), "t_")
    d = _prefixed(monthly_deposits(deposits, clients), "d_")
    j = (s.join(t, (s.s_month == t.t_month) & (s.s_affiliate_id == t.t_affiliate_id), "full")
         .join(d, (s.s_month == d.d_month) & (s.s_affiliate_id == d.d_affiliate_id), "full"))
    base = j.select(F.coalesce("s_month", "t_month", "d_month").alias("month"),
                    F.coalesce("s_affiliate_id", "t_affiliate_id", "d_affiliate_id").alias("affiliate_id"),
                    _zero("s_new_signups").alias("new_signups"),
                    _zero("t_total_trades").alias("total_trades"),
                    _zero_dec("t_total_volume").alias("trading_volume"),
                    _zero("t_active_traders").alias("active_traders"),
                    _zero("d_total_deposits").alias("total_deposits"),
                    _zero_dec("d_deposit_volume").alias("deposit_volume"))
    return _monthly_out(base, affiliates, as_of)


def _monthly_out(base: DataFrame, affiliates: DataFrame, as_of) -> DataFrame:
    return _name_lookup(base, affiliates).select(
        "month", "affiliate_id", "affiliate_name", "new_signups", "total_trades", "trading_volume",
        "active_traders", "total_deposits", "deposit_volume", _now(as_of).alias("last_updated"),
        F.lit("monthly_metrics").alias("view_type"))


def gold_monthly_merged(clients: DataFrame, trades: DataFrame, deposits: DataFrame,
                        affiliates: DataFrame, as_of=None) -> DataFrame:
    """Monthly metrics with one row per (month, affiliate): the three
    per-key aggregates are padded, unioned and summed - no outer joins.
    Distinct traders are counted before the union, so the sum is exact."""
    z, zd = F.lit(0).cast("long"), _zd()
    s = monthly_signups(clients).select("month", "affiliate_id", "new_signups",
                                        z.alias("total_trades"), zd.alias("trading_volume"),
                                        z.alias("active_traders"), z.alias("total_deposits"),
                                        zd.alias("deposit_volume"))
    t = monthly_trades(trades, clients).select("month", "affiliate_id", z.alias("new_signups"),
                                               "total_trades", F.col("total_volume").alias("trading_volume"),
                                               "active_traders", z.alias("total_deposits"),
                                               zd.alias("deposit_volume"))
    d = monthly_deposits(deposits, clients).select("month", "affiliate_id", z.alias("new_signups"),
                                                   z.alias("total_trades"), zd.alias("trading_volume"),
                                                   z.alias("active_traders"), "total_deposits",
                                                   "deposit_volume")
    u = s.unionByName(t).unionByName(d)
    base = u.groupBy("month", "affiliate_id").agg(
        F.sum("new_signups").cast("long").alias("new_signups"),
        F.sum("total_trades").cast("long").alias("total_trades"),
        F.sum("trading_volume").cast(DEC).alias("trading_volume"),
        F.sum("active_traders").cast("long").alias("active_traders"),
        F.sum("total_deposits").cast("long").alias("total_deposits"),
        F.sum("deposit_volume").cast(DEC).alias("deposit_volume"))
    return _monthly_out(base, affiliates, as_of)


def active_client_ids(trades: DataFrame, since: Column) -> DataFrame:
    """Distinct clients with at least one trade at or after ``since``
    (the EXISTS subquery, decorrelated to a semi-join key set)."""
    return trades.filter(F.col("trade_time") >= since).select("client_id").distinct()


def affiliate_metrics(affiliates: DataFrame, clients: DataFrame, trades: DataFrame, as_of) -> DataFrame:
    """Per affiliate (all affiliates, LEFT JOIN clients): total customers,
    customers registered in the trailing 30 days, customers with a trade in
    the trailing 30 days.  ``client_id`` is the key of the client table, so
    the distinct counts are plain conditional counts (no Expand)."""
    cutoff = days_before(as_of, 30)
    active = active_client_ids(trades, cutoff).withColumn("__active", F.lit(True))
    flagged = clients.select("client_id", "affiliate_id", "register_time") \
        .join(active, on="client_id", how="left")
    per_aff = flagged.groupBy("affiliate_id").agg(
        F.count("client_id").alias("total_customers"),
        F.count(F.when(F.col("register_time") >= cutoff, F.col("client_id"))).alias("new_signups_30d"),
        F.count(F.when(F.col("__active"), F.col("client_id"))).alias("active_customers_30d"))
    a = affiliates.select("affiliate_id", F.col("name").alias("affiliate_name"))
    return a.join(per_aff, on="affiliate_id", how="left").select(
        "affiliate_id", "affiliate_name",
        *[_zero(c).alias(c) for c in ("total_customers", "new_signups_30d", "active_customers_30d")])


def trading_metrics(clients: DataFrame, trades: DataFrame, as_of) -> DataFrame:
    """Trailing-30-day trading per affiliate: trades, volume, mean trade size
    (volume / number of trades)."""
    cutoff = days_before(as_of, 30)
    recent = per_client(trades.filter(F.col("trade_time") >= cutoff), "trade_time", "trade_volume", None, None)
    agg = (with_affiliate(recent, clients).groupBy("affiliate_id")
           .agg(F.sum("__n").cast("long").alias("trades_30d"),
                F.coalesce(F.sum("__v"), _zd()).cast(DEC).alias("trading_volume_30d")))
    return agg.withColumn("avg_trade_size", ratio_half_up("trading_volume_30d", "trades_30d", 4, 8))


def trading_metrics_per_trader(clients: DataFrame, trades: DataFrame, as_of) -> DataFrame:
    """Variant: mean volume per *distinct trader* over the trailing 30 days."""
    cutoff = days_before(as_of, 30)
    recent = per_client(trades.filter(F.col("trade_time") >= cutoff), "trade_time", "trade_volume", None, None)
    agg = (with_affiliate(recent, clients).groupBy("affiliate_id")
           .agg(F.count(F.lit(1)).alias("traders_30d"),
                F.coalesce(F.sum("__v"), _zd()).cast(DEC).alias("trading_volume_30d")))
    return agg.withColumn("avg_volume_per_trader", ratio_half_up("trading_volume_30d", "traders_30d", 4, 8))


def gold_performance(affiliates: DataFrame, clients: DataFrame, trades: DataFrame, as_of) -> DataFrame:
    """Performance per affiliate in one pass: the recent trades are reduced to a row per client, joined
    to the clients once, and everything is counted in one aggregate by affiliate."""
    cutoff = days_before(as_of, 30)
    recent = per_client(trades.filter(F.col("trade_time") >= cutoff), "trade_time", "trade_volume", None, None)
    per_affiliate = (clients.select("client_id", "affiliate_id", "register_time").join(recent, "client_id", "left")
                     .groupBy("affiliate_id").agg(
                         F.count("client_id").alias("total_customers"),
                         F.count(F.when(F.col("register_time") >= cutoff, 1)).alias("new_signups_30d"),
                         F.count("__n").alias("active_customers_30d"), F.sum("__n").alias("trades_30d"),
                         F.sum("__v").cast(DEC).alias("trading_volume_30d")))
    named = affiliates.select("affiliate_id", F.col("name").alias("affiliate_name")).join(per_affiliate, "affiliate_id", "left")
    whole = named.select("affiliate_id", "affiliate_name", *[_zero(c).alias(c) for c in (
        "total_customers", "new_signups_30d", "active_customers_30d", "trades_30d")], _zero_dec("trading_volume_30d").alias("trading_volume_30d"))
    return whole.select(
        "*", ratio_half_up("trading_volume_30d", "trades_30d", 4, 8).alias("avg_trade_size"),
        ratio_half_up(F.col("active_customers_30d") * 100, "total_customers", 2).alias("monthly_activation_rate"),
        _now(as_of).alias("last_updated"), F.lit("performance_metrics").alias("view_type"))


# Status word and completion percentage by the number of layers reached in order.
RUNGS = [("Not Started", 0), ("Bronze Complete", 33), ("Silver Complete", 66), ("Complete", 100)]


def layer_counts(bronze_customers: DataFrame, clients: DataFrame) -> DataFrame:
    """Distinct clients per affiliate in bronze and in silver."""
    b = bronze_customers.groupBy("affiliate_id").agg(F.countDistinct("client_id").alias("bronze_clients"))
    s = clients.groupBy("affiliate_id").agg(F.countDistinct("client_id").alias("silver_clients"))
    return b.join(s, on="affiliate_id", how="full").select(
        "affiliate_id", _zero("bronze_clients").alias("bronze_clients"),
        _zero("silver_clients").alias("silver_clients"))


def affiliates_in_daily(clients: DataFrame) -> DataFrame:
    """The affiliates of the daily view, without building it: each signup has
    a day there, and trades are counted under the affiliate of a signed-up client."""
    return clients.select("affiliate_id").distinct()


def gold_etl_dashboard(bronze_customers: DataFrame, clients: DataFrame, daily: DataFrame,
                       affiliates: DataFrame, as_of=None) -> DataFrame:
    """Pipeline status per affiliate, faithful to the chained full outer
    join (silver and gold branches matched to bronze only)."""
    now = _now(as_of)
    b = bronze_customers.groupBy(F.col("affiliate_id").alias("b_aff")) \
        .agg(F.countDistinct("client_id").alias("bronze_customers")) \
        .withColumn("bronze_update_time", now)
    s = clients.groupBy(F.col("affiliate_id").alias("s_aff")) \
        .agg(F.countDistinct("client_id").alias("silver_customers")) \
        .withColumn("silver_update_time", now)
    g = daily.select(F.col("affiliate_id").alias("g_aff")).distinct().withColumn("gold_update_time", now)
    j = b.join(s, F.col("b_aff") == F.col("s_aff"), "full").join(g, F.col("b_aff") == F.col("g_aff"), "full")
    n = F.col("bronze_customers")
    in_silver, in_gold = F.col("s_aff").isNotNull(), F.col("g_aff").isNotNull()
    reached = F.when(F.coalesce(n, F.lit(0)) == 0, 0).otherwise(1 + in_silver.cast("int") + (in_silver & in_gold).cast("int"))
    rung = F.get(F.array(*[F.struct(F.lit(w).alias("word"), F.lit(p).alias("percent")) for w, p in RUNGS]), reached)
    base = j.select(F.coalesce("b_aff", "s_aff", "g_aff").alias("affiliate_id"), "bronze_customers",
                    "bronze_update_time", "silver_update_time", "gold_update_time", reached.alias("reached"), rung.alias("rung"))
    count_if = lambda *rungs: F.when(F.col("reached").isin(*rungs), n).otherwise(F.lit(0).cast("long"))
    return _name_lookup(base, affiliates).select(
        "affiliate_id", "affiliate_name", F.col("bronze_customers").alias("total_records"),
        count_if(3).alias("success_count"), count_if(0).alias("error_count"), count_if(1, 2).alias("partial_count"),
        F.col("rung.percent").alias("success_rate"),
        "bronze_update_time", "silver_update_time", "gold_update_time", F.col("rung.word").alias("etl_status"),
        now.alias("last_updated"))
