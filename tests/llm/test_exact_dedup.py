import hashlib
import re

from pyspark.sql import functions as F

from strata.llm import exact_dedup, queries
from strata.llm.tables import read

SF = "/root/testdata/sf0.001"


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest(), []).append(i)
    out = []
    for h, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for k, i in enumerate(sorted(ids, key=lambda x: (x is None, x or 0))):
            out.append((i, keep, len(ids), k == 0, h))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    assert got(queries.op10_exact_dedup(spark, SF)) == brute(rows)


def test_edge_rows_with_and_without_heavy_hitters(docs_of):
    rows = [(1, "a  b"), (2, "a\tb"), (3, None), (4, ""), (5, " "), (None, "x"), (7, "a b"), (8, "long " * 30000),
            (9, "long\n" * 30000), (10, "A b"), (10, "a b"), (10, "a b"), (None, "x")] + [(100 + k, "hot") for k in range(200)]
    for tracked in (1, 4, 1024):
        df = exact_dedup.exact_groups(docs_of(rows, {"digest": F.lit(1), "keep_id": F.lit("z")}), tracked=tracked)
        assert got(df) == brute(rows)


def test_empty_table_and_dropping(docs_of):
    assert exact_dedup.exact_groups(docs_of([])).count() == 0
    kept = exact_dedup.drop_copies(docs_of([(2, "a"), (1, "a"), (3, "b")]))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_dropping_takes_rows_not_ids(docs_of):
    rows = [(1, "A"), (1, "A"), (2, "B"), (None, "B"), (None, "C"), (None, "C"), (2, "A"), (5, None), (4, " "), (4, "")]
    kept = sorted(((r.doc_id, r.text) for r in exact_dedup.drop_copies(docs_of(rows, {"key": F.lit(0), "row": F.lit("r"), "n": F.lit(1)})).collect()), key=str)
    assert kept == sorted([(1, "A"), (2, "B"), (None, "C"), (4, " "), (4, "")], key=str)


def test_plan_has_no_python(spark):
    plan = queries.op10_exact_dedup(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
