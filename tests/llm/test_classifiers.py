import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import ngrams, quality, queries, toxicity
from strata.llm.tables import read

SF = "/root/testdata/sf0.01"


def result(spark, query, label, modulus, held):
    out = {r.doc_id: r for r in query(spark, SF).collect()}
    assert len(out) == read(spark, SF, "documents").count()
    for i, r in out.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % modulus == held)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    marked = [(out[r.doc_id], r[label]) for r in read(spark, SF, "labels").collect() if r.doc_id in out]
    return [(r.predicted, y) for r, y in marked if r.held_out]


def test_quality_on_held_out_rows(spark):
    pairs = result(spark, queries.op7_quality, "quality", 5, 0)
    assert sum(p == y for p, y in pairs) / len(pairs) > 0.9


def test_toxicity_on_held_out_rows(spark):
    pairs = result(spark, queries.op1_toxicity, "toxic", 4, 2)
    assert sum(p == y for p, y in pairs) / len(pairs) > 0.9
    assert not [1 for p, y in pairs if p and not y]


@pytest.mark.parametrize("report", [quality.quality_report, toxicity.toxicity_report])
def test_odd_rows(spark, docs_of, report):
    rows = [(k, "fine words here " * (k % 5 + 1) if k % 3 else "idiot ### *** " * 3) for k in range(90)]
    rows += [(None, None), (200, None), (201, ""), (202, " \n"), (203, "long text " * 20000), (203, "é\U0001F600 ü")]
    docs = docs_of(rows, {"score": F.lit("x"), "y": F.lit(None).cast("string")})
    labels = spark.createDataFrame(
        [(k, int(k % 3 != 0), int(k % 3 == 0)) for k in range(90)] + [(1, None, None), (2, 1, 0), (2, 0, 1), (None, 1, 1), (999, 0, 0)],
        "doc_id long, quality int, toxic int")
    out = report(docs, labels).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.held_out is not None for r in out)
    assert len({r.score for r in out if r.doc_id in (200, 201)}) == 1     # null is an empty text
    assert report(docs_of([]), labels).count() == 0
    none = report(docs, labels.limit(0)).collect()                        # nothing to learn from
    assert {r.score for r in none} == {0.5}


def test_ngrams_do_not_cross_rows_and_count_once():
    from strata.llm import kernels
    both = list(kernels.slices(pa.array(["ab ab", "ab", "", None, "é é", "cd ab"])))
    (_, data, offsets), = both
    for grams in (ngrams.char_ngrams, ngrams.word_ngrams):
        bucket, row = grams(data, offsets)
        alone = []
        for k, t in enumerate(["ab ab", "ab", "", "", "é é", "cd ab"]):
            for _, d, o in kernels.slices(pa.array([t])):
                alone += [(int(b), k) for b in grams(d, o)[0]]
        assert sorted(zip(bucket.tolist(), row.tolist())) == sorted(alone) and len(set(alone)) == len(alone)


def test_follow_the_leader_learns_and_stays_sparse():
    texts = [("good words only", 1.0), ("### bad ###", 0.0)] * 200
    table = pa.table({"text": [t for t, _ in texts], "y": [y for _, y in texts], "pick": list(range(400))})
    fitted = quality.fit_rows(table)
    assert 0 < len(fitted) < 40
