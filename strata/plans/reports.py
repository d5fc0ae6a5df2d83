"""End-user reports over the gold views, plus paging and time slicing.

Sorting and limits live only here, at the report boundary.  Top-N is
``orderBy().limit()`` which Spark plans as TakeOrderedAndProject (a bounded
heap per partition); every sort names its NULL placement and has a
tiebreak, so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.expr import as_column, ts_literal


def report_etl_status(dashboard: DataFrame) -> DataFrame:
    return dashboard.select(
        F.col("affiliate_name").alias("data_source"), F.col("last_updated").alias("last_load_time"),
        "etl_status", "total_records", "success_count", "error_count", "partial_count").distinct() \
        .orderBy(F.col("data_source").asc_nulls_last())


def top_affiliates(performance: DataFrame, limit: int = 10) -> DataFrame:
    cols = ["affiliate_name", "new_signups_30d", "trading_volume_30d", "monthly_activation_rate",
            "avg_trade_size"]
    return (performance.filter(F.col("affiliate_name").isNotNull()).select(*cols).distinct()
            .orderBy(F.col("trading_volume_30d").desc_nulls_first(), F.col("affiliate_name").asc(),
                     F.col("new_signups_30d").desc(), F.col("monthly_activation_rate").desc(),
                     F.col("avg_trade_size").desc())
            .limit(limit))


def report_etl_issues(dashboard: DataFrame) -> DataFrame:
    return dashboard.filter(F.col("affiliate_name").isNotNull()).select(
        F.col("affiliate_name").alias("data_source"), F.col("last_updated").alias("last_load_time"),
        "error_count", "partial_count")


def report_affiliate_metrics(performance: DataFrame) -> DataFrame:
    cols = ["affiliate_name", "total_customers", "new_signups_30d", "active_customers_30d",
            "trading_volume_30d", "monthly_activation_rate", "avg_trade_size"]
    return (performance.filter(F.col("affiliate_name").isNotNull()).select(*cols).distinct()
            .orderBy(F.col("trading_volume_30d").desc_nulls_first(), F.col("affiliate_name").asc()))


# The order in which each view is shown (newest period first, NULL placement as in the source's database).
VIEW_ORDERS = {
    "gold_affiliate_daily_metrics": [("date", False), ("affiliate_id", True)],
    "gold_affiliate_monthly_metrics": [("month", False), ("affiliate_id", True)],
    "gold_affiliate_performance": [("trading_volume_30d", False)],
    "gold_etl_affiliate_dashboard": [("affiliate_id", True)],
}


def in_order(view: DataFrame, name: str) -> DataFrame:
    """A gold view sorted as it is shown: descending with NULLs first, ascending with NULLs last."""
    return view.orderBy(*[F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_first() for c, up in VIEW_ORDERS[name]])


def page_read(df: DataFrame, order_by: list, page_no: int, page_size: int) -> DataFrame:
    """Page ``page_no`` (1-based) of ``page_size`` rows in ``order_by`` order
    (give a unique ordering).  Deep pages cost O(page_no * page_size) per
    partition; prefer :func:`page_after` for sequential reads."""
    if page_no < 1 or page_size < 1:
        raise ValueError("page_no and page_size must be positive")
    return df.orderBy(*[as_column(c) for c in order_by]).offset((page_no - 1) * page_size).limit(page_size)


def page_after(df: DataFrame, key: str, last_key, page_size: int) -> DataFrame:
    """Keyset paging: the next ``page_size`` rows after ``last_key``.  The
    key filter is pushed to the scan, so every page costs the same."""
    rest = df if last_key is None else df.filter(F.col(key) > F.lit(last_key))
    return rest.orderBy(F.col(key).asc()).limit(page_size)


def time_slice(df: DataFrame, ts_col: str, start, end, client_id=None) -> DataFrame:
    """Rows with ``start <= ts < end`` (half-open) and an optional client."""
    cond = (F.col(ts_col) >= ts_literal(start)) & (F.col(ts_col) < ts_literal(end))
    if client_id is not None:
        cond = cond & (F.col("client_id") == F.lit(str(client_id)))
    return df.filter(cond)
