import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strata.llm import column_bwt as B
from strata.llm.tables import read

SF = "/root/testdata/sf0.001"


def brute(rows):
    """By the definition; rows are (doc_id, text), equal ids and texts included, in their order."""
    seen, out = set(), []
    for doc_id, text in rows:
        body = (text or "").encode()
        gone = np.zeros(len(body) + 1, dtype=int)
        for s in range(len(body) - 99):
            w = body[s:s + 100]
            if w in seen:
                gone[s:s + 100] = 1
            seen.add(w)
        kept = bytes(b for b, g in zip(body, gone) if not g)
        out.append((doc_id, len(body), int(gone.sum()), int((np.diff(gone, prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def copied_texts(seed, n, words=("le", "or", "ént", "of", "aux", "chè", "the")):
    """Texts made of fresh words and of passages taken from earlier texts, some of them changed by a letter."""
    rnd, pool, out = random.Random(seed), [], []
    for i in range(n):
        parts = []
        for _ in range(rnd.randint(0, 6)):
            if pool and rnd.random() < 0.6:
                src = rnd.choice(pool)
                a = rnd.randint(0, max(0, len(src) - 40))
                piece = src[a:a + rnd.choice((60, 99, 100, 101, 130, 400))]
                if rnd.random() < 0.3 and piece:
                    k = rnd.randrange(len(piece))
                    piece = piece[:k] + "#" + piece[k + 1:]
            else:
                piece = " ".join("".join(rnd.choices(words, k=rnd.randint(1, 4))) for _ in range(rnd.randint(1, 60)))
            parts.append(piece)
        text = rnd.choice(("", " ")).join(parts)
        pool.append(text)
        out.append((i, text))
    return out


def test_query_against_brute_force(spark):
    from strata.llm import queries
    rows = sorted((r.doc_id, r.text) for r in read(spark, SF, "documents").collect())
    assert got(queries.op12_suffix_dedup(spark, SF)) == brute(rows)


def test_passages_of_all_lengths(docs_of):
    rows = copied_texts(3, 300)
    want = brute(rows)
    assert got(B.repeated_substrings(docs_of(rows).repartition(7))) == want
    # Anchors with more than a few segments, decided window by window.
    for table in (2, 40):
        assert got(B.repeated_substrings(docs_of(rows).repartition(7), table=table)) == want


def test_runs_periods_and_long_texts(docs_of):
    rnd = random.Random(9)
    passage = "".join(rnd.choices("abcdefgh ", k=3000))
    rows = [(1, "a" * 99), (2, "a" * 100), (3, "a" * 101), (4, "a" * 5000 + "b"), (5, "abc" * 900), (6, "bca" * 900), (7, "xy" * 70),
            (8, "".join(rnd.choices("abcdefgh ", k=1_300_000)) + passage), (9, passage[:2000] + "é" + passage[2000:]),
            (10, "é" * 700), (11, "è" * 49 + "é" * 60), (12, passage[1:101]), (13, passage[1:100]), (14, "z" + passage)]
    assert got(B.repeated_substrings(docs_of(rows))) == brute(rows)


def test_one_passage_in_every_text(docs_of):
    rnd = random.Random(4)
    passage = "".join(rnd.choices("abcdefgh", k=260))
    rows = [(i, "".join(rnd.choices("ijklmnop", k=150)) + passage + "".join(rnd.choices("qrstuvw", k=150))) for i in range(400)]
    want = brute(rows)
    assert all(r[2] >= 260 for r in want if r[0] != min(x[0] for x in rows)) and got(B.repeated_substrings(docs_of(rows).repartition(5))) == want
    assert got(B.repeated_substrings(docs_of(rows).repartition(5), table=100)) == want


def test_nulls_repeats_and_extra_columns(docs_of):
    t = "".join(random.Random(1).choices("abcdefgh ", k=500))
    rows = [(3, t), (5, None), (5, ""), (5, t[100:400]), (6, "short"), (6, "short"), (7, t), (7, t), (None, t[:250]), (None, None)]
    df = docs_of(rows, {c: F.lit(4) for c in ("ord", "tie", "begin", "end", "copies", "copy", "spans", "anchor", "n_bytes")})
    assert got(B.repeated_substrings(df)) == brute(rows)
    # Different texts under one id, and rows without an id, each keep what no other row before them has.
    two = [(1, t), (1, t[:300]), (None, t + "x" * 10), (None, t + "y" * 10)]
    out = got(B.repeated_substrings(docs_of(two)))
    assert sum(r[1] - r[2] for r in out) == len({w for _, x in two for w in [x[s:s + 100] for s in range(len(x) - 99)]}) + 99 or \
        sorted(r[1] for r in out) == sorted(len(x) for _, x in two)
    assert sorted(r[2] for r in out if r[0] == 1) in ([0, 300], [0, 500], [300, 300])


def test_empty_table(docs_of):
    assert B.repeated_substrings(docs_of([])).count() == 0
    assert got(B.repeated_substrings(docs_of([(1, None)]))) == brute([(1, None)])


def test_rounds_mark_what_the_definition_marks():
    """The table alone: random rows over a small alphabet, all windows compared."""
    rnd = np.random.default_rng(3)
    rows = 60
    columns = np.full((B.COLUMNS, rows), B.PAD, dtype=np.uint8)
    base = rnd.integers(97, 99, B.COLUMNS)
    for i in range(rows):
        line = base.copy()
        line[rnd.integers(0, B.COLUMNS, rnd.integers(0, 3))] = 120
        most, least = sorted(rnd.integers(0, B.REACH + 1, 2))[::-1]
        columns[B.REACH - most:B.REACH - least + B.MATCH, i] = line[B.REACH - most:B.REACH - least + B.MATCH]
    rank = rnd.permutation(rows)
    marked = B.repeated_windows(columns, rank)
    for r in range(B.REACH + 1):
        windows = [bytes(columns[B.REACH - r:B.REACH - r + B.MATCH, i]) for i in range(rows)]
        for i, w in enumerate(windows):
            earlier = 255 not in w and any(rank[j] < rank[i] and x == w for j, x in enumerate(windows))
            assert marked[i, r] == earlier


def test_segments_do_not_depend_on_their_surroundings():
    rnd = random.Random(8)
    text = "".join(rnd.choices("abcde ", k=4000))
    found = []
    for before in ("", "zzz" * 50):
        data, offsets = B.kernels.utf8(pa.array(["q" * 300, before + text]))
        first, last, at, anchor, *_ = B.segments(data, offsets)
        shift = 300 + len(before)
        found.append({(int(f) - shift, int(l) - shift, int(a) - shift, int(h)) for f, l, a, h in zip(first, last, at, anchor) if f >= shift + 200})
    assert found[0] == found[1] and len(found[0]) > 50
