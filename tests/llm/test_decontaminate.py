import hashlib
import re

import duckdb
from pyspark.sql import functions as F

from strata.llm import decontaminate, queries

SF = "/root/testdata/sf0.01"


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, size=10):
    windows = {}
    for i, t in items:
        w = words(t)
        if i is not None and w:
            for k in range(max(1, len(w) - size + 1)):
                windows.setdefault(tuple(w[k:k + size]), set()).add(str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        out.append((i, len(w), len(hit), sorted(found), bool(hit)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in df.collect()), key=str)


def test_query_against_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = sorted(map(str, con.execute(queries.OP8_SQL).fetchall()))
    out = queries.op8_decontaminate(spark, SF)
    assert out.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(str(tuple(r)) for r in out.collect()) == want
    assert any("True" in r for r in want) and any("False" in r for r in want)


def test_odd_rows(spark, docs_of, monkeypatch):
    long = " ".join(f"w{k % 37}" for k in range(20000))
    items = [(1, "a b c d e f g h i j k l"), (2, "Short ITEM"), (2, "c d e f g h i j k l"), (3, None), (4, " .,- "),
             (None, "x y z"), (10, "the the the the the the the the the the the"), (5, "never seen words in any document")]
    docs = [(1, "zz a b c d e f g h i j k zz"), (2, "short, item! short item"), (3, None), (4, ""), (None, "SHORT item"),
            (5, long), (6, "the " * 25), (6, "the " * 9), (7, "a b c d e f g h i x j"), (8, "É short é item"), (9, "item|short|item"),
            (10, "c d e f g h i j k l a b c d e f g h i j k l")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("word", F.lit(1))
    frame = docs_of(docs, {"w": F.lit(1), "begin": F.lit(2), "window": F.lit("x")})
    assert got(decontaminate.contamination(frame, benchmark)) == brute(docs, items)
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 2)      # several rounds of windows
    assert got(decontaminate.contamination(frame, benchmark)) == brute(docs, items)
    assert decontaminate.contamination(docs_of([]), benchmark).count() == 0
    none = decontaminate.contamination(frame, benchmark.limit(0)).collect()
    assert len(none) == len(docs) and not any(r.contaminated for r in none)
    assert all(hashlib.sha256(b"").hexdigest() for _ in none)


def test_dropping_takes_rows_not_ids(spark, docs_of):
    item = " ".join(f"w{i}" for i in range(12))
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, "clean text"), (1, f"x {item} y"), (None, item), (None, "clean too"), (2, None), (2, item), (3, "w1 w2 w3")]
    out = decontaminate.drop_contaminated(docs_of(rows, {"key": F.lit(1), "row": F.lit(2), "n_hit": F.lit(3)}), benchmark)
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(
        [(1, "clean text"), (None, "clean too"), (2, None), (3, "w1 w2 w3")], key=str)


def test_plan_has_no_python(spark):
    plan = queries.op8_decontaminate(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_words_without_a_regular_expression(spark):
    """Looking for words by a regular expression took most of the time; every ASCII character and some others."""
    texts = ["".join(f"a{chr(c)}Z{chr(c)}" for c in range(128)), "", None, " ", "\0", "x\0", "É|é  Ü\u00a0ß 𝒳Y\U0001F600z \u2028K\u212a\r\n\tİ"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").select(decontaminate.words_of(F.col("text")).alias("w"))
    assert [r.w for r in frame.collect()] == [words(t) for t in texts]
    assert "regexp" not in frame._jdf.queryExecution().toString()
