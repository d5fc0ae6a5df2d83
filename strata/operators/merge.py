"""Keyed upsert with per-column conflict rules (``INSERT ... ON CONFLICT DO
UPDATE`` on a parquet table, which has no MERGE).

Two physical strategies, chosen by a bounded size check of the incoming
batch (the batch is one row per key after keep-latest):

* **small batch** (at most ``broadcast_max_keys`` keys): the batch is
  broadcast and looked up while the target is *scanned* once; the target's
  keys are read a second time to find the batch rows that are new.  The
  big target is never shuffled.
* **large batch** (backfills, first loads): one full outer join on the key;
  both sides shuffle once.

Either way the result is the complete next state of the table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_IN_T = "__in_target"
_IN_S = "__in_source"

# Largest key count of a batch that is broadcast (about 64 bytes per key).
BROADCAST_MAX_KEYS = 1_000_000


class UpsertRule:
    """Named conflict rules.  A rule maps (old, new) column -> merged column."""

    REPLACE = "replace"   # SET c = EXCLUDED.c
    KEEP = "keep"         # leave the target value
    LEAST = "least"       # SET c = LEAST(t.c, EXCLUDED.c)  (NULL-ignoring)
    GREATEST = "greatest"

    @staticmethod
    def resolve(rule) -> Callable[[Column, Column], Column]:
        if callable(rule):
            return rule
        return {
            "replace": lambda old, new: new,
            "keep": lambda old, new: old,
            "least": lambda old, new: F.least(old, new),
            "greatest": lambda old, new: F.greatest(old, new),
        }[rule]


def has_at_most(df: DataFrame, n: int) -> bool:
    """Size check: does ``df`` hold at most ``n`` rows?  A plain count: every
    task sends one number, where a limit would ship rows to one task."""
    return df.count() <= n


def _sides(target: DataFrame, source: DataFrame, keys: Sequence[str], updated_col: str | None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Target and source with their columns and presence marked apart, and the source's merged columns."""
    cols = [c for c in target.columns if c not in keys]
    s_cols = [c for c in cols if c in source.columns and c != updated_col]
    t = target.select(*keys, *[F.col(c).alias("__t_" + c) for c in cols], F.lit(True).alias(_IN_T))
    return t, source.select(*keys, *[F.col(c).alias("__s_" + c) for c in s_cols], F.lit(True).alias(_IN_S)), s_cols


def _merged_columns(target: DataFrame, keys: Sequence[str], s_cols: Sequence[str], rules: Mapping[str, object], stamp: Column,
                    updated_col: str | None) -> list[Column]:
    """The target's columns after the merge of two joined sides."""
    in_t, in_s = F.col(_IN_T).isNotNull(), F.col(_IN_S).isNotNull()
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
            continue
        old = F.col("__t_" + c)
        if c == updated_col:
            merged = F.when(in_s, stamp).otherwise(old)
        elif c in s_cols:
            new = F.col("__s_" + c)
            rule = UpsertRule.resolve(rules.get(c, UpsertRule.REPLACE))
            merged = F.when(in_t & in_s, rule(old, new)).when(in_s, new).otherwise(old)
        else:
            merged = old
        out.append(merged.cast(target.schema[c].dataType).alias(c))
    return out


def as_inserts(target: DataFrame, source: DataFrame, now: Column | None = None, updated_col: str | None = "last_updated") -> DataFrame:
    """The rows of ``source`` as an upsert into an empty table with the columns of ``target`` leaves them: nothing is joined or shuffled."""
    stamp = now if now is not None else F.current_timestamp().cast("timestamp_ntz")
    new = {c: stamp if c == updated_col else F.col(c) if c in source.columns else F.lit(None) for c in target.columns}
    return source.select(*[v.cast(target.schema[c].dataType).alias(c) for c, v in new.items()])


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 rules: Mapping[str, object] | None = None, now: Column | None = None,
                 updated_col: str | None = "last_updated",
                 broadcast_max_keys: int | None = BROADCAST_MAX_KEYS, stored: bool = False) -> DataFrame:
    """Next state of ``target`` after upserting ``source`` (one row per key).

    * keys only in target: row unchanged;
    * keys only in source: source row inserted, ``updated_col`` = ``now``;
    * keys in both: each column merged by its rule (default ``replace``),
      ``updated_col`` = ``now``.

    ``broadcast_max_keys=None`` skips the size check (always full outer).
    ``stored`` says that ``source`` is read from files as it is: it is not stored again.
    """
    from strata.session import materialize
    rules = dict(rules or {})
    stamp = now if now is not None else F.current_timestamp().cast("timestamp_ntz")
    # The batch is read by the size check, the key probes and the merge:
    # compute it once (and cut its lineage).
    source = source if stored else materialize(source)
    t, s, s_cols = _sides(target, source, keys, updated_col)
    columns = _merged_columns(target, keys, s_cols, rules, stamp, updated_col)
    if broadcast_max_keys is not None and has_at_most(source.select(*keys), broadcast_max_keys):
        # Updates are looked up as the target streams by; its keys alone are read again for the inserts.
        updated = t.join(F.broadcast(s), on=list(keys), how="left").select(*columns)
        present = target.select(*keys).join(F.broadcast(source.select(*keys)), on=list(keys), how="left_semi")
        absent = s.join(F.broadcast(present), on=list(keys), how="left_anti")
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in t.schema.fields if f.name not in keys]
        return updated.unionByName(absent.select("*", *nothing).select(*columns))
    return t.join(s, on=list(keys), how="full").select(*columns)
