"""Data-quality operators: null and duplicate profiles, verdicts, record
rules with quarantine, key and foreign-key checks.

Profiles are one aggregation pass (partial aggregation on the map side);
nothing is collected to the driver.  Percentages are on the 0-100 scale and
thresholds are percent points, as in the source system.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Default thresholds (percent points) and lineage columns that
# never take part in duplicate detection by default.
MAX_NULL_PERCENTAGE = 0.1
MAX_DUPLICATE_PERCENTAGE = 0.05
LINEAGE_COLUMNS = ("source_file", "load_time", "load_status", "last_updated")


def _pct(part: Column, total: Column) -> Column:
    return F.when(total > 0, F.lit(100.0) * part.cast("double") / total.cast("double")).otherwise(F.lit(0.0))


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """128 bits of the columns' text with their lengths: equal rows (NULLs equal, -0.0 equal to 0.0), equal digests."""
    floats = {f.name for f in df.schema if f.dataType.typeName() in ("float", "double")}
    plain = {c: F.when(F.col(c) == 0, F.lit(0.0)).otherwise(F.col(c)) if c in floats else F.col(c) for c in columns}
    text = {c: plain[c].cast("string") if df.schema[c].dataType.typeName() not in ("array", "map", "struct") else F.to_json(F.struct(plain[c]))
            for c in columns}
    return F.unhex(F.md5(F.concat(*[F.coalesce(F.concat(F.length(text[c]).cast("string"), F.lit(":"), text[c]), F.lit("n")) for c in columns])))


def _profile_counts(df: DataFrame, dup_cols: Sequence[str], null_cols: Sequence[str]) -> DataFrame:
    """Row count, duplicate count (NULLs equal) and per-column NULL counts
    as one row: ``__total``, ``__dups``, ``__null<i>``.

    One read of the input and one shuffle of 16-byte row digests with their
    counters, combined on the map side: the rows themselves stay where they are.
    """
    inner = [F.count(F.lit(1)).alias("__n")]
    inner += [F.count(F.when(F.col(c).isNull(), 1)).alias(f"__nn{i}") for i, c in enumerate(null_cols)]
    groups = df.groupBy(row_digest(df, dup_cols).alias("__digest")).agg(*inner) if dup_cols else df.agg(*inner)
    dups = F.sum(F.col("__n") - 1) if dup_cols else F.lit(0)
    return groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("__total"), F.coalesce(dups, F.lit(0)).cast("long").alias("__dups"),
        *[F.coalesce(F.sum(f"__nn{i}"), F.lit(0)).cast("long").alias(f"__null{i}") for i in range(len(null_cols))])


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: total_records, null_count, null_pct (0 on empty input)."""
    columns = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("__total")]
    aggs += [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(f"__null{i}") for i, c in enumerate(columns)]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', CAST(coalesce(__null{i}, 0) AS BIGINT)" for i, c in enumerate(columns))
    long = wide.selectExpr("__total", f"stack({len(columns)}, {pairs}) AS (column_name, null_count)")
    return long.select("column_name", F.col("__total").alias("total_records"), "null_count",
                       _pct(F.col("null_count"), F.col("__total")).alias("null_pct"))


def duplicate_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows after the first of each identical group on ``columns`` (NULLs
    compare equal): total_records, duplicate_count, duplicate_pct."""
    columns = list(columns or df.columns)
    c = _profile_counts(df, columns, [])
    return c.select(F.col("__total").alias("total_records"), F.col("__dups").alias("duplicate_count"),
                    _pct(F.col("__dups"), F.col("__total")).alias("duplicate_pct"))


def dq_report(df: DataFrame, table_name: str, *, check_time: Column | None = None,
              dup_columns: Sequence[str] | None = None, include_lineage: bool = False,
              max_null_pct: float = MAX_NULL_PERCENTAGE,
              max_dup_pct: float = MAX_DUPLICATE_PERCENTAGE) -> DataFrame:
    """One quality-log row: null % per column, duplicate %, verdict, issues.

    Null % covers every column; duplicates use ``dup_columns`` (default: all
    columns except lineage ones).  Both come from a single aggregation pass.
    Thresholds are strict ``>`` on the 0-100 scale.
    """
    cols = list(df.columns)
    if dup_columns is None:
        dup_columns = [c for c in cols if include_lineage or c not in LINEAGE_COLUMNS]
    return verdict(_profile_counts(df, list(dup_columns), cols), cols, table_name, check_time, max_null_pct, max_dup_pct)


def measured_report(spark: SparkSession, table_name: str, total: int, nulls: Mapping[str, int], duplicates: int,
                    check_time: Column | None = None) -> DataFrame:
    """The quality-log row of counts that the writing job has taken (``Observation``): no pass of its own."""
    counts = spark.range(1).select(F.lit(total).cast("long").alias("__total"), F.lit(duplicates).cast("long").alias("__dups"),
                                   *[F.lit(n).cast("long").alias(f"__null{i}") for i, n in enumerate(nulls.values())])
    return verdict(counts, list(nulls), table_name, check_time, MAX_NULL_PERCENTAGE, MAX_DUPLICATE_PERCENTAGE)


def duplicates_of(df: DataFrame, columns: Sequence[str]) -> int:
    """Rows after the first of each group of equal rows."""
    return _profile_counts(df, columns, []).first()["__dups"]


def verdict(counts: DataFrame, cols: Sequence[str], table_name: str, check_time: Column | None, max_null_pct: float,
            max_dup_pct: float) -> DataFrame:
    """The quality-log row of one row of counts (``__total``, ``__dups``, ``__null<i>`` of ``cols``)."""
    total = F.col("__total")
    null_pcts = [_pct(F.col(f"__null{i}"), total) for i in range(len(cols))]
    dup_pct = _pct(F.col("__dups"), total)
    # Messages print percentages with two decimals like '%.2f' on a float:
    # the exact binary value, ties to even (format_number; values <= 100).
    issues = [F.when(p > max_null_pct,
                     F.concat(F.lit(f"Column '{c}' has "), F.format_number(p, 2),
                              F.lit(f"% null values (threshold: {max_null_pct}%)")))
              for c, p in zip(cols, null_pcts)]
    issues.append(F.when(dup_pct > max_dup_pct,
                         F.concat(F.lit("Table has "), F.format_number(dup_pct, 2),
                                  F.lit(f"% duplicate records (threshold: {max_dup_pct}%)"))))
    issue_arr = F.filter(F.array(*issues), lambda x: x.isNotNull())
    stamp = check_time if check_time is not None else F.current_timestamp().cast("timestamp_ntz")
    return counts.select(
        F.lit(table_name).alias("table_name"),
        stamp.alias("check_timestamp"),
        total.alias("total_records"),
        F.map_from_arrays(F.array(*[F.lit(c) for c in cols]), F.array(*null_pcts)).alias("null_percentages"),
        dup_pct.alias("duplicate_percentage"),
        F.col("__dups").alias("duplicate_count"),
        (F.size(issue_arr) == 0).alias("validation_passed"),
        issue_arr.alias("issues"),
    )


def log_as_text(log: DataFrame) -> DataFrame:
    """The quality log for export to a store without maps and arrays: null percentages as JSON, issues joined."""
    return log.withColumn("null_percentages", F.to_json("null_percentages")).withColumn("issues", F.array_join("issues", "; "))


def latest_sample(df: DataFrame, n: int, order_by: Sequence) -> DataFrame:
    """The latest ``n`` rows (quality check on a bounded sample, e.g. the
    1000 most recently updated silver rows).  ``order_by`` should end in a
    unique column so the sample is deterministic; planned as a top-N
    (TakeOrderedAndProject), never a global sort."""
    return df.orderBy(*order_by).limit(n)


def validate_records(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Adds ``failed_rules`` (array of rule names whose condition is not TRUE;
    NULL counts as failed) and ``is_valid``."""
    flags = [F.when(~F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()]
    failed = F.filter(F.array(*flags), lambda x: x.isNotNull())
    return df.withColumn("failed_rules", failed).withColumn("is_valid", F.size("failed_rules") == 0)


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with ``failed_rules``); together they are
    exactly the input."""
    checked = validate_records(df, rules)
    return (checked.filter("is_valid").drop("failed_rules", "is_valid"),
            checked.filter(~F.col("is_valid")).drop("is_valid"))


def check_pk(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once (or are NULL): key, n."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter((F.col("n") > 1) | F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))))


# A parent filter: this many bits a key, at most this many words of 64 bits (some 24 bytes each where they are broadcast).
FILTER_BITS = 12
MAX_FILTER_WORDS = 2_000_000


def _filter_word(keys: Sequence[str], words: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(words))


def _filter_mask(keys: Sequence[str]) -> Column:
    """Four bits of a word, by other bits of the key's hash."""
    h = F.xxhash64(F.lit(17), *keys)
    mask = F.lit(0).cast("long")
    for k in range(4):
        place = F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def key_filter(parent: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, int] | None:
    """A blocked Bloom filter of the parent's keys, ``__word, __bits``, and its number of words; None beyond the bound.

    Each key sets four bits of one word, so a probe is one lookup.  Built by an
    ordinary aggregation: words are combined on the map side.
    """
    words = max(1, parent.count() * FILTER_BITS // 64)
    if words > MAX_FILTER_WORDS:
        return None
    return (parent.select(_filter_word(keys, words).alias("__word"), _filter_mask(keys).alias("__mask"))
            .groupBy("__word").agg(F.bit_or("__mask").alias("__bits"))), words


def fk_split(child: DataFrame, parent: DataFrame, keys: Sequence[str] | Mapping[str, str],
             strict: bool = False, prefilter: bool = False) -> tuple[DataFrame, DataFrame]:
    """Foreign-key enforcement: (rows whose key exists in ``parent``, orphans).

    ``keys`` is a list of shared names or a mapping child column -> parent
    column.  With ``strict`` a non-empty orphan set raises (the source system
    aborts the load); the check is a single ``isEmpty`` probe.  With
    ``prefilter`` a Bloom filter of the parent keys is broadcast first, if its size
    is within its bound: rows that it rejects are orphans at once and never
    shuffled, the rest is joined exactly.
    """
    mapping = dict(keys) if isinstance(keys, Mapping) else {k: k for k in keys}
    par = parent.select(*[F.col(p).alias(c) for c, p in mapping.items()])
    on = list(mapping)   # a semi or anti join needs no distinct parent, and stays open to skew splitting
    found = key_filter(par, on) if prefilter else None
    if found is None:
        valid, orphans = child.join(par, on=on, how="left_semi"), child.join(par, on=on, how="left_anti")
    else:
        table, words = found
        missing = F.greatest(*[F.col(k).isNull() for k in on], F.lit(False))
        probed = (child.withColumn("__word", F.when(~missing, _filter_word(on, words))).join(F.broadcast(table), "__word", "left")
                  .withColumn("__maybe", F.coalesce(F.col("__bits").bitwiseAND(_filter_mask(on)) == _filter_mask(on), F.lit(False))))
        maybe = probed.filter("__maybe").select(child.columns)
        valid = maybe.join(par, on=on, how="left_semi")
        orphans = probed.filter("not __maybe").select(child.columns).unionByName(maybe.join(par, on=on, how="left_anti").select(child.columns))
    if strict and not orphans.isEmpty():
        raise ValueError("foreign key violation: child rows without a parent")
    return valid, orphans


def counts_consistent(total, parts: Sequence) -> Column:
    """success + error + partial = total and every count >= 0 (NULL -> 0)."""
    t = F.coalesce(F.col(total) if isinstance(total, str) else total, F.lit(0))
    cs = [F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit(0)) for p in parts]
    ok = t >= 0
    s = F.lit(0)
    for c in cs:
        ok = ok & (c >= 0)
        s = s + c
    return ok & (s == t)


def constraint_violations(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Long table (constraint, violations) for row-level constraints, all in
    one aggregation pass.  A check is violated when not TRUE."""
    aggs = [F.sum(F.when(F.coalesce(c, F.lit(False)), 0).otherwise(1)).alias(f"__c{i}")
            for i, c in enumerate(checks.values())]
    wide = df.agg(*aggs)
    pairs = ", ".join(f"'{n}', CAST(coalesce(__c{i}, 0) AS BIGINT)" for i, n in enumerate(checks))
    return wide.selectExpr(f"stack({len(checks)}, {pairs}) AS (constraint_name, violations)")
