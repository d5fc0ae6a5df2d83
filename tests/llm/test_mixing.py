import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import mixing, queries
from strata.llm.tables import read

SF = "/root/testdata/sf0.001"


def size(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def brute_targets(rows):
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += size(t)
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: [5, 2, 1][k % 3] for k, s in enumerate(order)}
    want, out, left = 1.5 * sum(sizes.values()), {}, set(sizes)
    while left:
        rest = want - sum(out.values())
        level = rest / sum(weight[s] for s in left)
        full = {s for s in left if weight[s] * level > 2 * sizes[s]}
        if not full:
            out |= {s: weight[s] * level for s in left}
            break
        out |= {s: 2.0 * sizes[s] for s in full}
        left -= full
    return sizes, out


def check(rows, df):
    out = df.collect()
    sizes, targets = brute_targets(rows)
    assert sorted(((r.doc_id, r["size"]) for r in out), key=str) == sorted(((i, size(t)) for i, t, _ in rows), key=str)
    source = {i: s for i, _, s in rows}
    taken = defaultdict(int)
    for r in out:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(targets[s], rel=1e-9, abs=1e-9)
        assert 0 <= r.taken <= 2 * r["size"] and 0 <= r.position <= 1
        taken[s] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 0.5 for s in sizes)
    return out


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text, r.source) for r in read(spark, SF, "documents").collect()]
    first = check(rows, queries.op3_mix_sources(spark, SF))
    again = queries.op3_mix_sources(spark, SF).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))


def test_odd_rows(docs_of):
    rows = [(k, "w " * (k % 11), f"s{k % 5}") for k in range(200)] + [(300, None, None), (301, "a b c", None),
            (302, "", "empty"), (303, "x y " * 4000, "\U0001F600"), (304, "one", "￿")]
    check(rows, mixing.mix_sources(docs_of(rows, {"target": F.lit(1), "kind": F.lit("k")})))


def test_empty_table_and_no_words(docs_of):
    assert mixing.mix_sources(docs_of([])).count() == 0
    r = mixing.mix_sources(docs_of([(1, None, None)])).first()
    assert (r["size"], r.target, r.taken) == (0, 0.0, 0)


def test_demand_is_inverted(spark):
    at = [k / 20 for k in range(21)]
    frame = spark.createDataFrame([(x, k) for x in at for k in range(3)], "x double, k int")
    for r in frame.withColumn("t", mixing.demand_time(F.col("x"), F.col("k"))).collect():
        a, m, b = mixing.SCHEDULES[r.k]
        area = lambda t: (a * t + (m - a) * t * t) if t <= .5 else (a + m) / 4 + m * (t - .5) + (b - m) * (t - .5) ** 2
        assert area(r.t) / area(1) == pytest.approx(r.x, abs=1e-9)


def test_training_order_follows_the_schedule(docs_of):
    rows = [(k, "w " * 10, f"s{k % 3}") for k in range(900)]
    order = mixing.training_order(mixing.mix_sources(docs_of(rows))).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    lead = [r.doc_id % 3 for r in order[:len(order) // 4]]
    assert lead.count(0) / len(lead) > [r.doc_id % 3 for r in order].count(0) / len(order)


def test_query_is_sorted_and_lists_all_copies(spark):
    out = queries.op3_mix_sources(spark, SF).collect()
    assert [r.position for r in out] == sorted(r.position for r in out)
    want = {r.doc_id: r.copies for r in mixing.mix_sources(read(spark, SF, "documents")).collect()}
    assert {r.doc_id: r.copies for r in out} == want and any(len(c) == 2 for c in want.values())
    assert all(r.copies[0] == r.position and r.copies == sorted(r.copies) for r in out if r.copies)
