import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strata.llm import chunk_dedup as C
from strata.llm import kernels, queries
from strata.llm.tables import read

SF = "/root/testdata/sf0.001"


def slow_chunks(text):
    """The chunk rule byte by byte."""
    data = text.encode()
    marks, h = [], 0
    for i, b in enumerate(data):
        h = ((h << 1) + int(C._GEAR[b])) % 2**C.WINDOW
        if i + 1 >= C.WINDOW and h >> (C.WINDOW - C.MARK_BITS) == 0:
            marks.append(i + 1)
    ends = [m for k, m in enumerate(marks) if k == 0 or m - marks[k - 1] > C.LEAST]
    ends = sorted(set(ends + ([len(data)] if data else [])))
    out, at = [], 0
    for e in ends:
        while e - at > C.MOST:
            out.append((at, at + C.MOST))
            at += C.MOST
        out.append((at, e))
        at = e
    return [(a, b, data[a:b]) for a, b in out]


def brute(rows):
    docs = {i: slow_chunks(t) for i, t in rows if i is not None and t}
    where = defaultdict(set)
    for i, cs in docs.items():
        for _, _, body in cs:
            where[body].add(i)
    out = []
    for i, cs in docs.items():
        runs = []
        for a, b, body in cs:
            if len(where[body]) > 1:
                kept = min(where[body]) == i
                if runs and runs[-1][1] == a and runs[-1][2] == kept:
                    runs[-1][1] = b
                else:
                    runs.append([a, b, kept])
        out += [(i, a, b, k) for a, b, k in runs if b - a >= C.PASSAGE]
    return sorted(out)


def got(df):
    return sorted((r.doc_id, r.begin, r.end, r.kept) for r in df.collect())


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    assert got(queries.op4_substring_dedup(spark, SF)) == brute(rows)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghiklmnoprstuvwé") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_planted_passages_and_odd_rows(docs_of):
    rng = random.Random(4)
    passage = words(rng, 60)
    rows = [(k, words(rng, rng.randint(5, 80)) + (" " + passage + " " + words(rng, 9) if k % 4 == 0 else "")) for k in range(1, 80)]
    rows += [(100, None), (101, ""), (None, passage), (102, words(rng, 20000)), (103, "x" * 3000), (104, "x" * 3000), (105, words(rng, 30))]
    out = C.repeated_passages(docs_of(rows, {"digest": F.lit(1), "begin": F.lit("b")}))
    assert got(out) == brute(rows)
    assert {r.doc_id for r in out.collect() if r.doc_id < 100} == {k for k in range(1, 80) if k % 4 == 0}
    assert C.repeated_passages(docs_of([])).count() == 0


def test_repeated_ids_are_one_document(docs_of):
    text = words(random.Random(1), 100)
    assert C.repeated_passages(docs_of([(1, text), (1, text)])).count() == 0
    assert {r.doc_id for r in C.repeated_passages(docs_of([(1, text), (1, text), (2, text)])).collect()} == {1, 2}


def test_removal_keeps_one_copy(docs_of):
    rng = random.Random(9)
    passage, tail = words(rng, 70), [words(rng, 40) for _ in range(3)]
    docs = docs_of([(k, f"{tail[k]} {passage} {tail[k][::-1]}") for k in range(3)] + [(7, None)])
    texts = {r.doc_id: r.text for r in C.remove_repeats(docs).collect()}
    middle = passage[100:200]
    assert middle in texts[0] and middle not in texts[1] and middle not in texts[2] and texts[7] is None
    assert all(tail[k] in texts[k] for k in range(3))


def test_insertion_moves_only_near_boundaries():
    rng = random.Random(2)
    a = words(rng, 2000).encode()
    b = a[:5000] + b"inserted " + a[5000:]
    cut = [set(int(h) for h in kernels.span_hashes(d, np.r_[0, e[:-1]], e)) for d, e in (
        (d, C.chunk_ends(d, np.array([0, len(d)]))) for d in (np.frombuffer(x, dtype=np.uint8) for x in (a, b)))]
    assert len(cut[0] - cut[1]) <= 4


def test_slices_do_not_matter(docs_of, monkeypatch):
    rng = random.Random(3)
    passage = words(rng, 80)
    rows = [(k, words(rng, 30) + " " + passage) for k in range(12)]
    texts = pa.array([t for _, t in rows])

    def ends(limit):
        return [(at + r, int(e - o[r])) for at, d, o in kernels.slices(texts, limit) for e in C.chunk_ends(d, o)
                for r in [int(np.searchsorted(o, e, side="left")) - 1]]
    assert ends(1 << 20) == ends(900) == ends(1)


def test_documents_are_counted_once_and_with_first_holder(docs_of):
    rng = random.Random(12)
    passage, other = words(rng, 80), words(rng, 60)
    twice = f"{passage} {words(rng, 5)} {passage}"
    rows = [(3, twice), (5, passage + " " + other), (9, other)]
    out = C.repeated_passages(docs_of(rows)).collect()
    assert {r.n_docs for r in out if r.doc_id == 3} == {2}           # twice in one text is one document
    assert all(r.n_bytes == r.end - r.begin and r.n_docs == 2 for r in out)
    assert {(r.doc_id, r.first_doc_id) for r in out} == {(3, 3), (5, 3), (5, 5), (9, 5)}


def test_texts_that_share_an_id_are_cut_apart(docs_of):
    rng = random.Random(13)
    passage, mine = words(rng, 90), words(rng, 120)
    rows = [(1, passage), (2, words(rng, 40) + " " + passage), (2, mine)]
    kept = sorted(r.text for r in C.remove_repeats(docs_of(rows)).collect())
    assert mine in kept and passage in kept                          # what repeats nowhere stays whole
    assert not any(passage[150:300] in t for t in kept if t != passage)


def test_equal_hashes_do_not_make_equal_chunks():
    data = np.frombuffer(b"abcdefgh" * 40, dtype=np.uint8)
    starts, ends = np.array([0, 8, 3]), np.array([30, 38, 33])
    one, two = kernels.span_hashes(data, starts, ends), kernels.span_hashes(data, starts, ends, kernels.SECOND_CODE)
    assert one[0] == one[1] != one[2] and two[0] == two[1] != two[2] and set(one) & set(two) == set()
