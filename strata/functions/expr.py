"""Scalar column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "EPOCH_NTZ", "as_column", "epoch_ms_to_ts", "ts_to_epoch_ms", "parse_decimal",
    "trunc_ntz", "ts_literal",
    "date_literal", "days_before", "affiliate_name", "affiliate_email", "ratio_half_up",
]

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def as_column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(value) -> Column:
    """A ``timestamp_ntz`` literal from a date/datetime/ISO string."""
    if isinstance(value, _dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        text = value.strftime("%Y-%m-%d 00:00:00")
    else:
        text = str(value)
    return F.expr(f"TIMESTAMP_NTZ'{text}'")


def date_literal(value) -> Column:
    if isinstance(value, (_dt.date, _dt.datetime)):
        value = value.strftime("%Y-%m-%d")
    return F.expr(f"DATE'{value}'")


def epoch_ms_to_ts(c) -> Column:
    """Epoch-millisecond value (string or number) -> ``timestamp_ntz``.

    Time-zone independent: the wall clock is UTC.  Unparseable text and
    values outside the years 1 to 9999 -> NULL.
    """
    ms = as_column(c).try_cast("bigint")
    ms = F.when(ms.between(-62135596800000, 253402300799999), ms)
    return F.timestamp_add("MILLISECOND", ms, F.expr(EPOCH_NTZ))


def ts_to_epoch_ms(c) -> Column:
    """``timestamp_ntz`` -> epoch milliseconds (BIGINT), UTC wall clock."""
    return F.timestamp_diff("MILLISECOND", F.expr(EPOCH_NTZ), as_column(c))


def parse_decimal(c, precision: int = 20, scale: int = 8) -> Column:
    """Numeric text -> DECIMAL(p,s) exactly (no float hop); bad text -> NULL."""
    return as_column(c).try_cast(f"decimal({precision},{scale})")


def trunc_ntz(unit: str, c) -> Column:
    """``DATE_TRUNC(unit, ts)`` keeping ``timestamp_ntz`` (Spark's
    date_trunc returns a session-zone timestamp)."""
    return F.date_trunc(unit, as_column(c)).cast("timestamp_ntz")


def ratio_half_up(num, den, digits: int, num_scale: int = 0) -> Column:
    """``num / den`` rounded half-up to ``digits`` decimals *exactly*, as
    DOUBLE; 0 when ``den`` is not positive.

    ``num`` is an integer or a decimal with ``num_scale`` fraction digits,
    ``den`` an integer count.  The quotient is formed in integer units
    (no binary floating point before the final conversion), so a value
    like 257558.95125 rounds to .9513 as decimal arithmetic would.
    """
    num, den = as_column(num), as_column(den)
    k = 10 ** num_scale
    units = (num * F.lit(k)).cast("decimal(38,0)")
    mag = (F.abs(units) * F.lit(2 * 10 ** digits) + den.cast("decimal(38,0)") * F.lit(k)).cast("decimal(38,0)")
    step = (den.cast("decimal(38,0)") * F.lit(2 * k)).cast("decimal(38,0)")
    # exact integer quotient: subtract the remainder, then divide
    whole = ((mag - F.pmod(mag, step)) / step).cast("decimal(38,0)")
    signed = F.when(units < 0, -whole).otherwise(whole)
    return F.when(den > 0, signed.cast("double") / F.lit(float(10 ** digits))).otherwise(F.lit(0.0))


def days_before(as_of, days: int) -> Column:
    """Midnight of ``as_of`` minus ``days`` days, as ``timestamp_ntz``."""
    return F.timestamp_add("DAY", F.lit(-days), F.to_date(ts_literal(as_of)).cast("timestamp_ntz"))


def affiliate_name(affiliate_id) -> Column:
    # Fixed value: display-name prefix of an affiliate.
    return F.concat(F.lit("Affiliate "), as_column(affiliate_id))


def affiliate_email(affiliate_id) -> Column:
    # Synthesized e-mail prefix and domain.
    return F.concat(F.lit("affiliate"), as_column(affiliate_id), F.lit("@example.com"))
