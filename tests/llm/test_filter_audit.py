import re
from itertools import permutations

from pyspark.sql import functions as F
from strata.llm import filter_audit
from strata.llm.tables import read

SF = "/root/testdata/sf0.001"


def failed(rows):
    """(part, doc_id, set of failed filters) by the definitions."""
    out = []
    for doc_id, text, part in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A"} if len(words) < 200 else set()
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t):
            fails.add("C")
        if re.search(r"[#$%&*|]", t):
            fails.add("D")
        if doc_id is not None and any(d is not None and d < doc_id and (x or "") == t for d, x, _ in rows):
            fails.add("E")
        out.append((part or "", doc_id, frozenset(fails)))
    return out


def brute(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    docs, out = failed(rows), {}
    for part in {p for p, _, _ in docs}:
        mine = [(d, f) for p, d, f in docs if p == part]
        first = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for _, f in mine:
                if f:
                    first[next(x for x in order if x in f)] += 1
        for order in permutations("ABCDE"):
            gone = set()
            for step, x in enumerate(order, 1):
                hits = [i for i, (_, f) in enumerate(mine) if x in f]
                here = [i for i in hits if i not in gone]
                unique = sum(f == {x} for _, f in mine)
                lost = [mine[i][0] for i in here]
                redundant = len(hits) - len(here)
                gone |= set(here)
                out[part, "".join(order), step] = (len(mine) - len(gone), len(here), redundant, unique,
                                                   sum(d in good for d in lost), sum(d in toxic for d in lost), first[x])
    return out


def got(df):
    cols = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = df.collect()
    out = {(r.part, r.filter_order, r.step): tuple(r[c] for c in cols) for r in rows}
    assert len(out) == len(rows)
    return out


LONG = " ".join(f"w{i}" for i in range(300))
ROWS = [(1, LONG, "en"), (2, LONG, None), (3, LONG + " $", ""), (4, None, "fr"), (5, "", "fr"), (6, " \t\n", "fr"),
        (7, "a " * 400, "en"), (8, "A" * 50 + " x " * 250, "en"), (8, "A" * 50 + " x " * 250, "en"), (None, LONG, "en"),
        (None, LONG, "en"), (9, "é" * 97 + "ABC", "en"), (10, "é" * 96 + "ABCD", "en"), (11, "a b " * 200, "en"),
        (12, "one " * 200, "en"), (13, "x" * 100000 + " " + LONG, "en"), (14, "z " * 200000, "en")]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (7, 0, 1), (7, 1, None), (8, 1, 1), (None, 1, 1), (99, 1, 1), (4, None, 1)]


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, p, "s", 0) for i, t, p in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in read(spark, SF, "documents").collect()]
    labels = [tuple(r) for r in read(spark, SF, "labels").select("doc_id", "quality", "toxic").collect()]
    from strata.llm import queries
    assert got(queries.op11_filter_audit(spark, SF)) == brute(rows, labels)


def test_nulls_ties_repeats_and_extra_columns(spark):
    docs, labels = frames(spark, ROWS, LABELS)
    noisy = docs.withColumns({c: F.lit(7) for c in ("part", "failed", "word", "shard", "digest", "step", "good")})
    assert got(filter_audit.audit(noisy, labels.withColumn("part", F.lit("z")))) == brute(ROWS, LABELS)


def test_small_shards_and_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", 5000)
    monkeypatch.setattr(filter_audit, "BLOCK_BYTES", 1000)
    monkeypatch.setattr(filter_audit.shard_batches, "__module__", "__main__")   # sent by value, with the bounds above
    docs, labels = frames(spark, ROWS, LABELS)
    assert got(filter_audit.audit(docs, labels)) == brute(ROWS, LABELS)


def test_empty_tables(spark):
    docs, labels = frames(spark, [], [])
    assert filter_audit.audit(docs, labels).count() == 0
    some, _ = frames(spark, ROWS[:3], [])
    assert got(filter_audit.audit(some, labels)) == brute(ROWS[:3], [])


def test_matrix_is_encoded_globally(spark):
    docs, _ = frames(spark, ROWS, [])
    cells, words = {}, set()
    texts = {}
    for i, t, _ in ROWS:
        texts.setdefault(i, []).append(t or "")
    for r in filter_audit.term_matrix(docs.repartition(5)).collect():
        at = 0
        for doc, end in zip(r.doc, r.row_end):
            cells.setdefault(doc.doc_id, []).append(sorted(zip(r.word_id[at:end], r.n[at:end])))
            at = end
        words |= set(r.word_id)
    distinct = {w for ts in texts.values() for t in ts for w in re.findall(r"[^\x20\x09-\x0D]+", t)}
    assert words == set(range(len(distinct)))          # dense, one number a word
    for i, ts in texts.items():
        want = sorted(sorted(re.findall(r"[^\x20\x09-\x0D]+", t).count(w) for w in set(re.findall(r"[^\x20\x09-\x0D]+", t))) for t in ts)
        assert sorted(sorted(n for _, n in row) for row in cells[i]) == want
    assert cells[1] == cells[2] == cells[None][:1]      # the same words, the same numbers, in whatever shard


def test_few_blocks_to_a_file(spark, monkeypatch):
    """A reader takes all rows of a small file into memory at once, and a block has megabytes."""
    tables, stored = {}, filter_audit.stored
    monkeypatch.setattr(filter_audit, "stored", lambda df, name, *more: tables.setdefault(name, stored(df, name, *more)))
    docs = spark.range(36, numPartitions=1).selectExpr("id AS doc_id", "'en' AS lang", "repeat(concat(id, ' b '), 300000) AS text")
    flags = filter_audit.failed_filters(docs).collect()
    assert {r.n_words for r in flags} == {600000} and len(flags) == 36
    sizes = [spark.read.parquet(f).count() for f in tables["term-blocks"].inputFiles()]
    assert sum(sizes) > 8 and max(sizes) <= 8
