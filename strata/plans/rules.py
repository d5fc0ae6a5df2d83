"""Record rules of the bronze tables: what a row must meet to enter silver.

A rule is a condition that must be TRUE (NULL fails).  Rows that fail go to the
quarantine with the names of the rules they fail; amounts that the narrower
silver decimal cannot hold are among them, so that none becomes NULL unseen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Load states and the silver column limits.
LOAD_STATUSES = ("SUCCESS", "ERROR", "PARTIAL")
COIN_LENGTH = 10
SILVER_AMOUNT = "decimal(18,8)"


def _present(*columns: str) -> dict[str, Column]:
    return {f"{c}_present": F.col(c).isNotNull() for c in columns}


def _amount(column: str, name: str) -> dict[str, Column]:
    return {f"{name}_non_negative": F.col(column) >= 0, f"{name}_fits_silver": F.col(column).try_cast(SILVER_AMOUNT).isNotNull()}


def record_rules() -> dict[str, dict[str, Column]]:
    """Rules by bronze table."""
    known = {"load_status_known": F.col("load_status").isin(*LOAD_STATUSES)}
    return {
        "bronze_customers": known | _present("affiliate_id", "client_id", "register_time"),
        "bronze_deposits": known | _present("order_id", "client_id", "deposit_time", "deposit_coin") | _amount("deposit_amount", "amount")
        | {"coin_fits_silver": F.length("deposit_coin") <= COIN_LENGTH},
        "bronze_trades": known | _present("client_id", "trade_time") | _amount("trade_volume", "volume"),
    }
