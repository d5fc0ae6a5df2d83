"""Refresh of the periodic gold views from what a load has changed.

Each silver run records the months whose daily and monthly metrics it can have
changed.  A refresh takes the runs since the last one, computes the views of
those months alone and puts them in the place of their month folders; other
months are neither read nor written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.plans import gold
from strata.sources.batches import CommitLog
from strata.sources.catalog import delete_path

MONTH = "period_month"
VIEWS = {"gold_affiliate_daily_metrics": "date", "gold_affiliate_monthly_metrics": "month"}


def month_of(c) -> Column:
    return F.date_format(c, "yyyy-MM")


def months_in(*columns: DataFrame) -> set[str]:
    """Different months of one-column frames of months; a row for each month reaches the driver."""
    out: set[str] = set()
    for frame in columns:
        out |= {r[0] for r in frame.distinct().collect() if r[0] is not None}
    return out


def months_of_clients(batch: DataFrame, clients: DataFrame, trades: DataFrame, deposits: DataFrame) -> set[str]:
    """Months that a batch of clients changes: those of its registrations, before and after, and all
    months of trades and deposits of clients that move to another affiliate."""
    old = clients.select("client_id", F.col("affiliate_id").alias("old_affiliate"), F.col("register_time").alias("old_time"))
    both = batch.select("client_id", "affiliate_id", "register_time").join(old, "client_id", "left")
    moved = both.filter("old_affiliate is not null and old_affiliate != affiliate_id").select("client_id")
    return months_in(both.select(month_of("register_time")), both.select(month_of("old_time")),
                     trades.join(moved, "client_id", "left_semi").select(month_of("trade_time")),
                     deposits.join(moved, "client_id", "left_semi").select(month_of("deposit_time")))


def months_of_deposits(batch: DataFrame, deposits: DataFrame) -> set[str]:
    """Months of a batch of deposits, and of the stored rows that it replaces."""
    return months_in(batch.select(month_of("deposit_time")),
                     deposits.join(batch.select("order_id"), "order_id", "left_semi").select(month_of("deposit_time")))


def refresh_log(spark: SparkSession, root: str) -> CommitLog:
    return CommitLog(spark, f"{root}/gold_periods/_refreshes")


def read_view(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/gold_periods/{name}").drop(MONTH)


def month_sources(spark: SparkSession, root: str, months: list[str] | None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Clients (all, for their affiliates), and the signups, trades and deposits of the months."""
    from strata.plans.jobs import silver_table
    clients = silver_table(spark, root, "clientaccount").read()
    trades, deposits = silver_table(spark, root, "tradeactivities"), silver_table(spark, root, "deposits").read()
    if months is None:
        return clients, clients, trades.read(), deposits
    first, last = f"{months[0]}-01", f"{months[-1]}-01"
    # A range for the Parquet statistics beside the exact months.
    within = lambda c: ((F.col(c) >= F.lit(first).cast("timestamp_ntz")) & (F.col(c) < F.add_months(F.lit(last).cast("date"), 1).cast("timestamp_ntz"))
                        & month_of(c).isin(months))
    return clients, clients.filter(within("register_time")), trades.read_partitions(months), deposits.filter(within("deposit_time"))


def refresh_gold(spark: SparkSession, root: str, as_of) -> list[str] | None:
    """Bring the daily and monthly views up to date with silver; returns the months computed (None: all, the first time).

    Interrupted, it is simply run again: the same months are replaced by the same rows.
    """
    from strata.plans.jobs import silver_runs, silver_table
    log, runs = refresh_log(spark, root), silver_runs(spark, root).entries()
    done = log.entries()
    seen = done[max(done)]["silver_run"] if done else None
    new = [r for n, r in sorted(runs.items()) if seen is None or n > seen]
    if not new:
        return []
    whole = seen is None or any(r.get("touched") is None for r in new)
    months = None if whole else sorted(set().union(*[r["touched"] for r in new]))
    if months != []:
        clients, signups, trades, deposits = month_sources(spark, root, months)
        affiliates = silver_table(spark, root, "affiliateaccount").read()
        views = {"gold_affiliate_daily_metrics": gold.gold_daily(clients, trades, affiliates, as_of, signups),
                 "gold_affiliate_monthly_metrics": gold.gold_monthly(clients, trades, deposits, affiliates, as_of, signups)}
        for name, view in views.items():
            path = f"{root}/gold_periods/{name}"
            seen_months = Observation()
            out = view.withColumn(MONTH, month_of(VIEWS[name])).observe(seen_months, F.collect_set(MONTH).alias("months"))
            (out.write.mode("overwrite").option("partitionOverwriteMode", "static" if whole else "dynamic").partitionBy(MONTH).parquet(path))
            if not whole:       # a month that has no row any more is not overwritten
                for month in set(months) - set(seen_months.get["months"]):
                    delete_path(spark, f"{path}/{MONTH}={month}")
    log.commit({"batch": max(done, default=-1) + 1, "silver_run": max(runs), "months": months})
    return months
