import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import near_dedup, queries
from strata.llm.components import components
from strata.llm.tables import read, shuffled, stored

SF = "/root/testdata/sf0.001"


def shingles(t, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def brute(rows, size, percent):
    sets = [(i, shingles(t, size)) for i, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1:]:
            if a and b and i is not None and j is not None and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    out = [(i, len(s), None if i is None else find(i)) for i, s in sets]
    return sorted(((i, n, c, i == c) for i, n, c in out), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    assert got(queries.op5_near_dedup(spark, SF)) == brute(rows, 3, 85)


@pytest.mark.parametrize("block", [1024, 8])
def test_near_copies_and_odd_rows(docs_of, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(5))
    base = [[word() for _ in range(120)] for _ in range(4)]
    rows = []
    for k in range(90):
        w = list(base[k % 4])
        for _ in range(rng.randrange(0, 12)):
            w[rng.randrange(len(w))] = word()
        rows.append((k, " ".join(w)))
    rows += [(200, None), (201, ""), (202, "  "), (203, "one two"), (204, "ONE\ttwo"), (205, "two one"), (None, rows[0][1]),
             (206, " ".join(word() for _ in range(20000))), (207, rows[5][1].upper()), (208, rows[5][1])]
    docs = docs_of(rows, {"class": F.lit(1), "rep": F.lit("r"), "node": F.lit(2)})
    assert got(near_dedup.near_duplicates(docs, 5, 80)) == brute(rows, 5, 80)


def test_empty_table_and_dropping(docs_of):
    assert near_dedup.near_duplicates(docs_of([])).count() == 0
    text = " ".join(map(str, range(100)))
    kept = near_dedup.drop_near_duplicates(docs_of([(3, text), (2, text + " x"), (4, "other"), (None, text), (5, None)]))
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [2, 4, 5, None]


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(20)] + [(100, k) for k in range(101, 140)] + [(7, 7), (300, 301), (301, 300)]
    out = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {**{k: 0 for k in range(1, 21)}, **{k: 100 for k in range(101, 140)}, 301: 300}


def joined(m, pairs):
    root = list(range(m))
    for a, b in pairs:
        old, new = root[b], root[a]
        root = [new if r == old else r for r in root]
    return root


@settings(max_examples=60, deadline=None)
@given(st.integers(2, 25), st.integers(0, 2**32))
def test_bucket_leaves_no_survivor_between_groups(m, seed):
    rng = np.random.default_rng(seed)
    sig = rng.integers(0, 2, (m, near_dedup.BANDS * near_dedup.ROWS)).astype(np.uint8)
    for i in range(1, m):
        if rng.random() < 0.6:
            j = rng.integers(0, i)
            same = rng.random(sig.shape[1]) < 0.9
            sig[i, same] = sig[j, same]
    make = lambda band=None: near_dedup.Bucket(np.arange(m), np.full(m, 50), sig, np.zeros(m, int), np.arange(m), 85, band)
    every = {(i, int(j)) for i in range(m) for j in make().survivors(i)}
    pairs = make().pairs()
    assert {(int(a), int(b)) for a, b in pairs} <= every
    root = joined(m, pairs)
    assert len(pairs) < m and all(root[a] == root[b] for a, b in every)
    # Each pair that shares a band belongs to one band's task.
    bands = [{(i, int(j)) for i in range(m) for j in make(b).survivors(i)} for b in range(near_dedup.BANDS)]
    share = {(i, j) for i, j in every if (sig[i] == sig[j]).reshape(-1, near_dedup.ROWS).all(axis=1).any()}
    assert sorted(share) == sorted(p for b in bands for p in b if p in share)
    assert set(make(0).needed()) == {x for p in bands[0] for x in p}


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 25), st.integers(0, 2**32))
def test_links_within_a_bucket_against_brute_force(m, seed):
    rng = np.random.default_rng(seed)
    sets = [np.sort(rng.choice(60, rng.integers(40, 60), replace=False)).astype(np.uint64) for _ in range(m)]
    order = rng.permutation(m)
    sig = np.zeros((m, near_dedup.BANDS * near_dedup.ROWS), np.uint8)
    n = np.array([len(x) for x in sets], dtype=np.int64)
    bucket = near_dedup.Bucket(order, n, sig, np.zeros(m, int), order.copy(), 75, 0)
    links = bucket.links(sets)
    ok = {tuple(sorted((order[i], order[j]))) for i in range(m) for j in range(i)
          if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))}
    assert {(int(a), int(b)) for a, b in links} <= {(int(a), int(b)) for a, b in ok}
    root = joined(m, links)
    want = joined(m, ok)
    assert [root.index(r) for r in root] == [want.index(r) for r in want]


def test_many_pairs_just_below_the_threshold(docs_of, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(6))
    base = [word() for _ in range(200)]
    rows = []
    for k in range(120):
        w = list(base)
        for _ in range(rng.randrange(2, 6)):
            w[rng.randrange(len(w))] = word()
        rows.append((k, " ".join(w)))
    assert got(near_dedup.near_duplicates(docs_of(rows), 5, 80)) == brute(rows, 5, 80)


def test_pruning_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(3)
    need = near_dedup.least_matches(85)
    equal = (rng.random((200_000, 125)) < 0.85 + 0.15 / 256).cumsum(axis=1)[:, 24::25]
    assert (equal < need).any(axis=1).sum() <= 3


def test_dropping_takes_rows_not_ids(docs_of):
    rng = random.Random(6)
    a, b, c = (" ".join("".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(60)) for _ in range(3))
    rows = [(5, a), (7, a), (5, b), (2, b), (9, c), (9, c), (None, c), (3, None), (3, None)]
    kept = near_dedup.drop_near_duplicates(docs_of(rows, {"key": F.lit(1), "row": F.lit(2), "component": F.lit(3)}))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(5, a), (2, b), (9, c), (None, c), (3, None), (3, None)], key=str)


def test_joins_that_grow_with_the_corpus_are_not_broadcast(spark):
    """Spark expects 25 band rows of a class to be as small as its row in the file; broadcast, they filled the driver."""
    reps = stored(spark.range(400).selectExpr("id AS rep", "50L AS n_shingles", "array_repeat(id, 25) AS bands",
                                              "unhex(repeat('ab', 125)) AS sig"), "join-test")
    docs = stored(spark.range(400).selectExpr("id AS doc_id", "repeat('same words ', 50) AS text"), "join-test")
    pairs = spark.range(200).selectExpr("id AS a", "id + 1 AS b")
    for frame in (near_dedup.bucket_tasks(reps), pairs.join(shuffled(docs.withColumnRenamed("doc_id", "a")), "a")):
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
