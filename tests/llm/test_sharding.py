import hashlib
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.llm import queries, sharding
from strata.llm.tables import read

SF = "/root/testdata/sf0.001"


def brute_capacity(sizes, shards):
    def fits(c):
        n, at = 1, 0
        for s in sizes:
            if at + s > c:
                n, at = n + 1, 0
            at += s
        return n <= shards
    c = max(max(sizes), -(-sum(sizes) // shards))
    while not fits(c):
        c += 1
    return c


def check(rows, df, shards):
    out = df.collect()
    groups = defaultdict(int)
    for i, t in rows:
        groups[hashlib.sha256((t or "").encode()).hexdigest()] += len((t or "").encode()) + 1
    sizes = [groups[k] for k in sorted(groups)]
    assert len(out) == len(rows)
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r)
    for s, mine in by.items():
        assert 0 <= s < shards and sorted(r.slot for r in mine) == list(range(len(mine)))
    if sizes:
        assert max(sum(r["size"] for r in mine) for mine in by.values()) == brute_capacity(sizes, shards)
    assert sorted(((r.doc_id, r.text_crc32, r["size"]) for r in out), key=str) == sorted(
        ((i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t in rows), key=str)
    texts = defaultdict(set)
    for r in out:
        texts[(r.text_crc32, r["size"])].add(r.shard)
    assert all(len(x) == 1 for x in texts.values())
    assert all(r.law == "bytes" and r.grown_shard is None for r in out)


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    check(rows, queries.op6_shard(spark, SF), 16)


@pytest.mark.parametrize("knots", [4, 64, 8192])
def test_levels_of_knots_and_odd_rows(docs_of, knots):
    rows = [(k, f"text {k * k} " * (k % 7)) for k in range(300)] + [(None, None), (None, None), (1, ""), (2, "é" * 5000)]
    rows += [(1000 + k, "copy of one text") for k in range(150)]
    df = sharding.assign_shards(docs_of(rows, {"shard": F.lit(9), "digest": F.lit("d")}), 5, knots=knots)
    check(rows, df, 5)


def test_few_rows_and_none(docs_of):
    check([(1, "a")], sharding.assign_shards(docs_of([(1, "a")]), 16), 16)
    assert sharding.assign_shards(docs_of([]), 16).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=60), st.integers(1, 8), st.integers(1, 9))
def test_search_on_knots_finds_the_minimum(sizes, shards, block):
    ends = [sum(sizes[:k + 1]) for k in range(len(sizes))]
    known = sharding.Knots(ends[-1], len(sizes))
    low, high, width = max(max(sizes), -(-ends[-1] // shards)), -(-ends[-1] // shards) + max(sizes), block * 16
    while True:
        high = known.smallest(shards, low, high, 0)
        low = known.smallest(shards, low, high, 1)
        first, last = known.cuts(low, shards), known.cuts(high, shards)
        open_ = known.unknown([(a, b) for (a, _), (_, b) in zip(first, last)])
        if not open_:
            break
        width = max(1, width // 2)
        for s, e in open_:
            cells = defaultdict(list)
            for x in ends:
                if s < x <= e:
                    cells[(x - 1) // width].append(x)
            known.refine(s, e, sorted((max(c), len(c)) for c in cells.values()))
    assert high == brute_capacity(sizes, shards)
    assert all(a == b for a, b in known.cuts(high, shards)) and known.cuts(high, shards)[-1][0] == ends[-1]
