"""Silver layer: bronze -> cleaned, keyed tables.

Each build is *source select* (required-key filter + keep-latest dedupe) and
then either a first load (the source select itself) or an upsert into the
existing table with the per-column rules below.  Deposits and trades are
split against the client table: rows of unknown clients are quarantined
(``strict=True`` raises instead, like a foreign-key violation would).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.expr import affiliate_email, affiliate_name, ts_literal
from strata.operators.dedupe import keep_latest
from strata.operators.merge import UpsertRule, merge_upsert
from strata.operators.quality import fk_split

# Per-column conflict rules of each silver table (fixed by the data model).
AFFILIATE_RULES = {"name": UpsertRule.REPLACE, "email": UpsertRule.REPLACE, "join_date": UpsertRule.LEAST}
CLIENT_RULES = {"affiliate_id": UpsertRule.REPLACE, "register_time": UpsertRule.LEAST}
DEPOSIT_RULES = {"client_id": UpsertRule.REPLACE, "deposit_time": UpsertRule.REPLACE,
                 "deposit_coin": UpsertRule.REPLACE, "deposit_amount": UpsertRule.REPLACE}
TRADE_RULES = {"trade_volume": UpsertRule.REPLACE}


def _stamp(now) -> Column:
    if now is None:
        return F.current_timestamp().cast("timestamp_ntz")
    return now if isinstance(now, Column) else ts_literal(now)


def affiliates_source(bronze_customers: DataFrame, now=None) -> DataFrame:
    """One row per affiliate seen in bronze: synthesized name and e-mail,
    join date = date of its earliest customer registration."""
    return (bronze_customers.filter(F.col("affiliate_id").isNotNull())
            .groupBy("affiliate_id")
            .agg(F.min("register_time").alias("first_registration"))
            .select("affiliate_id", affiliate_name(F.col("affiliate_id")).alias("name"),
                    affiliate_email(F.col("affiliate_id")).alias("email"),
                    F.to_date("first_registration").alias("join_date"),
                    _stamp(now).alias("last_updated")))


def latest_customers(bronze_customers: DataFrame) -> DataFrame:
    """Keep the latest registration per client (ties: lowest affiliate id)."""
    src = bronze_customers.filter(F.col("client_id").isNotNull() & F.col("affiliate_id").isNotNull())
    return keep_latest(src, ["client_id"], [F.col("register_time").desc_nulls_first(),
                                            F.col("affiliate_id").asc_nulls_last()])


def clients_source(bronze_customers: DataFrame, now=None) -> DataFrame:
    return latest_customers(bronze_customers).select(
        "client_id", "affiliate_id", "register_time", _stamp(now).alias("last_updated"))


def latest_deposits(bronze_deposits: DataFrame) -> DataFrame:
    """Keep the latest deposit per order id; ties broken on every remaining
    column so the choice is deterministic."""
    src = bronze_deposits.filter(F.col("order_id").isNotNull() & F.col("client_id").isNotNull())
    return keep_latest(src, ["order_id"], [F.col("deposit_time").desc_nulls_first(),
                                           F.col("deposit_amount").desc_nulls_last(),
                                           F.col("client_id").asc_nulls_last(),
                                           F.col("deposit_coin").asc_nulls_last()])


def deposits_source(bronze_deposits: DataFrame, now=None) -> DataFrame:
    return latest_deposits(bronze_deposits).select(
        "order_id", "client_id", "deposit_time", "deposit_coin",
        F.col("deposit_amount").try_cast("decimal(18,8)").alias("deposit_amount"),
        _stamp(now).alias("last_updated"))


def latest_trades(bronze_trades: DataFrame) -> DataFrame:
    """Keep one trade per (client, trade time): the largest volume."""
    src = bronze_trades.filter(F.col("client_id").isNotNull())
    return keep_latest(src, ["client_id", "trade_time"], [F.col("trade_volume").desc_nulls_last()])


def trades_source(bronze_trades: DataFrame, now=None) -> DataFrame:
    return latest_trades(bronze_trades).select(
        "client_id", "trade_time",
        F.col("trade_volume").try_cast("decimal(18,8)").alias("trade_volume"),
        _stamp(now).alias("last_updated"))


def enforce_clients(rows: DataFrame, clients: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows of known clients, orphan rows)."""
    return fk_split(rows, clients, ["client_id"], strict=strict)


# --- first loads and upserts -------------------------------------------------

def build_affiliates(bronze_customers: DataFrame, now=None, target: DataFrame | None = None) -> DataFrame:
    src = affiliates_source(bronze_customers, now)
    return src if target is None else merge_upsert(target, src, ["affiliate_id"], AFFILIATE_RULES, _stamp(now))


def build_clients(bronze_customers: DataFrame, now=None, target: DataFrame | None = None) -> DataFrame:
    src = clients_source(bronze_customers, now)
    return src if target is None else merge_upsert(target, src, ["client_id"], CLIENT_RULES, _stamp(now))


def build_deposits(bronze_deposits: DataFrame, clients: DataFrame, now=None,
                   target: DataFrame | None = None, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    valid, orphans = enforce_clients(deposits_source(bronze_deposits, now), clients, strict)
    out = valid if target is None else merge_upsert(target, valid, ["order_id"], DEPOSIT_RULES, _stamp(now))
    return out, orphans


def build_trades(bronze_trades: DataFrame, clients: DataFrame, now=None,
                 target: DataFrame | None = None, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    valid, orphans = enforce_clients(trades_source(bronze_trades, now), clients, strict)
    out = valid if target is None else merge_upsert(target, valid, ["client_id", "trade_time"],
                                                    TRADE_RULES, _stamp(now))
    return out, orphans
