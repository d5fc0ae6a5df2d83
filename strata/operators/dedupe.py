"""Keep-latest dedupe, insert-ignore and key-set operators.

All of them are one shuffle on the key.  Keep-latest is written as
``row_number() = 1`` which Catalyst turns into a *partial* WindowGroupLimit
before the exchange and a final one after it, so a hot key (say a third of
all rows under one client) is cut down to one row per map task before it is
shuffled; no task ever holds the whole hot group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.expr import as_column

_RN = "__rn"


def _not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def keep_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """``SELECT DISTINCT ON (keys) * ... ORDER BY keys, order_by``: one row per
    key, the first under ``order_by`` (give explicit ``desc_nulls_first`` etc.
    and enough tiebreak columns for a deterministic result)."""
    order = [as_column(c) for c in order_by]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def insert_ignore(target: DataFrame | None, incoming: DataFrame, keys: Sequence[str],
                  arrival_order: Sequence[Column | str], broadcast_max_keys: int | None = 1_000_000,
                  rows: int | None = None) -> DataFrame:
    """Rows of ``incoming`` that an ``INSERT ... ON CONFLICT DO NOTHING`` would
    add to ``target``: the first row per key in arrival order, minus keys
    already present.  Rows with a NULL key are rejected (NOT NULL keys).
    Returns only the delta, to be appended.  ``target=None`` is a table without rows: nothing is probed.

    When the batch has at most ``broadcast_max_keys`` keys (bounded count),
    its keys are broadcast and the target's key column is only scanned and
    semi-joined map-side: the big table is never shuffled.  Larger batches
    use a shuffled anti-join.  ``rows``, if the caller has counted them, are the batch's rows:
    with more than ``broadcast_max_keys`` the batch is not stored first, and its one
    shuffle on the key serves keep-latest and anti-join."""
    from strata.operators.merge import has_at_most
    from strata.session import materialize
    fresh = incoming.filter(_not_null(keys))
    if target is None:
        return keep_latest(fresh, keys, arrival_order)
    if broadcast_max_keys is None or rows is not None and rows > broadcast_max_keys:
        return keep_latest(fresh, keys, arrival_order).join(target.select(*keys), on=list(keys), how="left_anti")
    # Used three times below (size check, key probe, delta): compute it once.
    first = materialize(keep_latest(fresh, keys, arrival_order))
    if rows is not None or has_at_most(first.select(*keys), broadcast_max_keys):
        present = target.select(*keys).join(F.broadcast(first.select(*keys)), on=list(keys), how="left_semi")
        # ``present`` is a subset of the batch keys: bounded by the check above.
        return first.join(F.broadcast(present), on=list(keys), how="left_anti")
    return first.join(target.select(*keys), on=list(keys), how="left_anti")


def new_keys(candidates: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidates whose key is not in ``seen`` (NOT EXISTS)."""
    return candidates.join(seen.select(*keys), on=list(keys), how="left_anti")


def union_keys(*frames: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Set union of the key columns of several frames."""
    out = None
    for f in frames:
        part = f.select(*keys)
        out = part if out is None else out.unionByName(part)
    return out.distinct()
