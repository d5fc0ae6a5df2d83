"""Property tests: operators against brute-force Python models."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions.expr import ts_literal
from strata.operators import dedupe, quality
from strata.operators.merge import merge_upsert

KEYS = st.sampled_from(["a", "b", "c", "d"])
ROWS = st.lists(st.tuples(KEYS, st.integers(0, 5)), max_size=12)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(target=ROWS, incoming=ROWS)
def test_insert_ignore_matches_model(spark, target, incoming):
    t = {}
    for k, v in target:
        t.setdefault(k, v)
    tdf = spark.createDataFrame(sorted(t.items()), "k string, v int")
    idf = spark.createDataFrame(incoming, "k string, v int")
    delta = dedupe.insert_ignore(tdf, idf, ["k"], [F.col("v").asc()])
    model = {}
    for k, v in sorted(incoming, key=lambda r: r[1]):
        if k not in t and k not in model:
            model[k] = v
    assert sorted(tuple(r) for r in delta.collect()) == sorted(model.items())


@SETTINGS
@given(target=ROWS, source=ROWS, big=st.booleans())
def test_merge_upsert_matches_model(spark, target, source, big):
    t = dict(target)
    s = dict(source)
    tdf = spark.createDataFrame(sorted((k, v, 0) for k, v in t.items()), "k string, v int, last_updated int")
    sdf = spark.createDataFrame(sorted(s.items()), "k string, v int")
    out = merge_upsert(tdf, sdf, ["k"], {"v": "least"}, now=F.lit(1), broadcast_max_keys=0 if big else 1000)
    model = {k: (v, 0) for k, v in t.items()}
    for k, v in s.items():
        model[k] = (min(v, t[k]) if k in t else v, 1)
    assert sorted((r.k, r.v, r.last_updated) for r in out.collect()) == sorted((k, *v) for k, v in model.items())


@SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(st.none(), KEYS), st.one_of(st.none(), st.integers(0, 2))), max_size=15))
def test_duplicate_profile_matches_model(spark, rows):
    df = spark.createDataFrame(rows, "a string, b int")
    r = quality.duplicate_stats(df).collect()[0]
    assert r.total_records == len(rows)
    assert r.duplicate_count == len(rows) - len(set(rows))
    nulls = {x.column_name: x.null_count for x in quality.null_profile(df).collect()}
    assert nulls == {"a": sum(x[0] is None for x in rows), "b": sum(x[1] is None for x in rows)}


def test_keep_latest_matches_model(spark):
    data = [(k, v) for k in "abc" for v in range(5)] + [("a", 4)]
    df = spark.createDataFrame(data, "k string, v int")
    got = dict(tuple(r) for r in dedupe.keep_latest(df, ["k"], [F.col("v").desc()]).collect())
    assert got == {"a": 4, "b": 4, "c": 4}
    _ = ts_literal("2024-01-01 00:00:00")


@SETTINGS
@given(pairs=st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(0, 5000)), min_size=1, max_size=20))
def test_ratio_half_up_matches_decimal(spark, pairs):
    from decimal import ROUND_HALF_UP, Decimal

    from strata.functions.expr import ratio_half_up
    rows = [(Decimal(n).scaleb(-8), d) for n, d in pairs]
    df = spark.createDataFrame(rows, "v decimal(28,8), n long")
    got = [r.x for r in df.select(ratio_half_up("v", "n", 4, 8).alias("x")).collect()]
    want = [float((v / d).quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP)) if d > 0 else 0.0 for v, d in rows]
    assert got == want


def test_ratio_half_up_exact_tie(spark):
    from decimal import Decimal

    from strata.functions.expr import ratio_half_up
    df = spark.createDataFrame([(Decimal("14423301.27"), 56)], "v decimal(28,8), n long")
    assert df.select(ratio_half_up("v", "n", 4, 8).alias("x")).collect()[0].x == 257558.9513
