"""Declared schemas: landing page envelopes, bronze, silver, quality log.

JSON landing data is never inferred: every field of the page envelopes is a
string, exactly as the upstream API delivers it (timestamps are epoch-ms
text, amounts decimal text).
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()


def _envelope(fields: list[str]) -> T.StructType:
    record = T.StructType([T.StructField(f, S, True) for f in fields])
    return T.StructType([
        T.StructField("code", S, True),
        T.StructField("msg", S, True),
        T.StructField("requestTime", S, True),
        T.StructField("data", T.ArrayType(record, True), True),
    ])


# Endpoint folder names and the API field names of each record.
ENDPOINT_FIELDS = {
    "customer_list": ["uid", "registerTime"],
    "deposits": ["orderId", "uid", "depositTime", "depositCoin", "depositAmount"],
    "trade_activities": ["uid", "volumn", "time"],
    "assets": ["balance", "uid", "uTime", "remark"],
}

ENVELOPES = {name: _envelope(fields) for name, fields in ENDPOINT_FIELDS.items()}


def _struct(*cols: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in cols])


TS = T.TimestampNTZType()
D20 = T.DecimalType(20, 8)
D18 = T.DecimalType(18, 8)

BRONZE = {
    "bronze_customers": _struct(
        ("affiliate_id", S, False), ("client_id", S, False), ("register_time", TS, False),
        ("source_file", S, True), ("load_time", TS, True), ("load_status", S, True)),
    "bronze_deposits": _struct(
        ("order_id", S, False), ("affiliate_id", S, False), ("client_id", S, False),
        ("deposit_time", TS, False), ("deposit_coin", S, False), ("deposit_amount", D20, False),
        ("source_file", S, True), ("load_time", TS, True), ("load_status", S, True)),
    "bronze_trades": _struct(
        ("affiliate_id", S, False), ("client_id", S, False), ("trade_volume", D20, False),
        ("trade_time", TS, False), ("source_file", S, True), ("load_time", TS, True),
        ("load_status", S, True)),
    "bronze_assets": _struct(
        ("affiliate_id", S, False), ("client_id", S, False), ("balance", D20, False),
        ("update_time", TS, False), ("remark", S, True), ("source_file", S, True),
        ("load_time", TS, True), ("load_status", S, True)),
}

SILVER = {
    "affiliateaccount": _struct(
        ("affiliate_id", S, False), ("name", S, True), ("email", S, True),
        ("join_date", T.DateType(), True), ("last_updated", TS, True)),
    "clientaccount": _struct(
        ("client_id", S, False), ("affiliate_id", S, True), ("register_time", TS, True),
        ("last_updated", TS, True)),
    "deposits": _struct(
        ("order_id", S, False), ("client_id", S, True), ("deposit_time", TS, True),
        ("deposit_coin", S, True), ("deposit_amount", D18, True), ("last_updated", TS, True)),
    "tradeactivities": _struct(
        ("client_id", S, False), ("trade_time", TS, False), ("trade_volume", D18, True),
        ("last_updated", TS, True)),
}

# Primary keys of every table (fixed by the data model).
KEYS = {
    "bronze_customers": ["affiliate_id", "client_id"],
    "bronze_deposits": ["order_id"],
    "bronze_trades": [],
    "bronze_assets": [],
    "affiliateaccount": ["affiliate_id"],
    "clientaccount": ["client_id"],
    "deposits": ["order_id"],
    "tradeactivities": ["client_id", "trade_time"],
}

# Endpoint -> bronze table, and the arrival order that decides
# which row of a batch is "first" for insert-once tables.
ENDPOINT_TABLES = {"customer_list": "bronze_customers", "deposits": "bronze_deposits",
                   "trade_activities": "bronze_trades", "assets": "bronze_assets"}
ARRIVAL = {"bronze_customers": ["register_time", "source_file"],
           "bronze_deposits": ["deposit_time", "deposit_amount", "client_id", "deposit_coin", "source_file"]}
