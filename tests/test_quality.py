"""Quality profiles, verdicts and record / key / FK checks."""

import pytest
from pyspark.sql import functions as F

from strata.operators import quality


def test_null_profile_counts_and_empty_input(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None), (4, "y")], "a int, b string")
    got = {r.column_name: (r.total_records, r.null_count, r.null_pct) for r in quality.null_profile(df).collect()}
    assert got == {"a": (4, 1, 25.0), "b": (4, 2, 50.0)}
    empty = quality.null_profile(df.limit(0)).collect()
    assert all(r.null_pct == 0.0 and r.total_records == 0 for r in empty)


def test_duplicates_treat_nulls_as_equal(spark):
    # count(DISTINCT a, b) would skip the NULL rows; the reference counts them.
    df = spark.createDataFrame([(None, 1), (None, 1), (2, 2)], "a int, b int")
    r = quality.duplicate_stats(df).collect()[0]
    assert (r.total_records, r.duplicate_count) == (3, 1)
    assert r.duplicate_pct == pytest.approx(100 / 3)


def test_dq_report_thresholds_are_percent_points_and_strict(spark):
    # 1 null in 1000 rows = 0.1 % -> not above the 0.1 threshold.
    df = spark.range(1000).select(F.when(F.col("id") == 0, None).otherwise(F.col("id")).alias("x"))
    r = quality.dq_report(df, "t").collect()[0]
    assert r.validation_passed and r.issues == []
    df2 = spark.range(1000).select(F.when(F.col("id") < 2, None).otherwise(F.col("id")).alias("x"))
    r2 = quality.dq_report(df2, "t").collect()[0]
    assert not r2.validation_passed
    # the two NULL rows are duplicates of each other (NULLs compare equal)
    assert r2.issues == ["Column 'x' has 0.20% null values (threshold: 0.1%)",
                         "Table has 0.10% duplicate records (threshold: 0.05%)"]
    assert r2.null_percentages["x"] == pytest.approx(0.2)


def test_dq_report_excludes_lineage_from_duplicates(spark):
    df = spark.createDataFrame([("a", "f1"), ("a", "f2")], "client_id string, source_file string")
    assert quality.dq_report(df, "t").collect()[0].duplicate_percentage == 50.0
    assert quality.dq_report(df, "t", include_lineage=True).collect()[0].duplicate_percentage == 0.0


def test_validate_records_split_is_a_partition_of_the_input(spark):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "id int, amount double")
    rules = {"amount_non_negative": F.col("amount") >= 0}
    valid, quarantine = quality.split_valid(df, rules)
    assert sorted(r.id for r in valid.collect()) == [1]
    q = {r.id: r.failed_rules for r in quarantine.collect()}
    assert q == {2: ["amount_non_negative"], 3: ["amount_non_negative"]}
    assert valid.count() + quarantine.count() == df.count()


def test_check_pk_and_fk_split(spark):
    df = spark.createDataFrame([("o1", "c1"), ("o1", "c2"), ("o2", "c9"), (None, "c1")],
                               "order_id string, client_id string")
    dup = {r.order_id: r.n for r in quality.check_pk(df, ["order_id"]).collect()}
    assert dup == {"o1": 2, None: 1}
    parent = spark.createDataFrame([("c1",), ("c2",)], "client_id string")
    valid, orphans = quality.fk_split(df, parent, ["client_id"])
    assert valid.count() == 3 and [r.order_id for r in orphans.collect()] == ["o2"]
    with pytest.raises(ValueError):
        quality.fk_split(df, parent, ["client_id"], strict=True)


def test_counts_consistent_and_constraints(spark):
    df = spark.createDataFrame([(10, 5, 0, 5), (10, 5, 1, 5), (None, None, None, None), (3, -1, 4, 0)],
                               "t long, s long, e long, p long")
    got = [r.ok for r in df.select(quality.counts_consistent("t", ["s", "e", "p"]).alias("ok")).collect()]
    assert got == [True, False, True, False]
    v = quality.constraint_violations(df, {"t_present": F.col("t").isNotNull(), "s_ge_0": F.col("s") >= 0})
    assert {r.constraint_name: r.violations for r in v.collect()} == {"t_present": 1, "s_ge_0": 2}


def test_key_filter_gives_the_same_split_and_rejects_most_orphans_before_the_join(spark):
    parent = spark.range(0, 4000, 2).select(F.col("id").cast("string").alias("k"))
    child = spark.range(0, 6000).select(F.when(F.col("id") % 50 != 0, F.col("id").cast("string")).alias("k"), "id")
    plain, filtered = (quality.fk_split(child, parent, ["k"], prefilter=p) for p in (False, True))
    for a, b in zip(plain, filtered):
        assert sorted(r.id for r in a.collect()) == sorted(r.id for r in b.collect())
    table, words = quality.key_filter(parent, ["k"])
    assert table.count() <= words == 2000 * quality.FILTER_BITS // 64
    probed = child.withColumn("w", quality._filter_word(["k"], words)).join(table, F.col("w") == table["__word"], "left")
    passed = probed.filter(F.col("__bits").bitwiseAND(quality._filter_mask(["k"])) == quality._filter_mask(["k"])).filter("k is not null")
    wrong = passed.join(parent, "k", "left_anti").count()
    assert passed.join(parent, "k", "left_semi").count() == plain[0].count() and wrong < 0.06 * child.count()
    assert quality.fk_split(child, parent.limit(0), ["k"], prefilter=True)[0].count() == 0


def test_key_filter_beyond_its_bound_is_not_built(spark, monkeypatch):
    monkeypatch.setattr(quality, "MAX_FILTER_WORDS", 10)
    parent, child = spark.range(1000).selectExpr("id as k"), spark.range(990, 1010).selectExpr("id as k")
    assert quality.key_filter(parent, ["k"]) is None
    valid, orphans = quality.fk_split(child, parent, {"k": "k"}, prefilter=True)
    assert (valid.count(), orphans.count()) == (10, 10)
