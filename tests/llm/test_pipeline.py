from collections import Counter

import corpus_pipeline as P
from pyspark.sql import functions as F

from strata.llm import decontaminate, mixing, near_dedup
from strata.llm.tables import read, stored

SF = "/root/testdata/sf0.001"


def test_stages_and_their_effects(spark):
    assert [n for n, _ in P.STAGES] == ["quality", "near_dedup", "decontamination", "mixing", "sharding"]
    docs = read(spark, SF, "documents")
    for name, stage in P.STAGES:
        before, docs = docs.cache(), stage(spark, docs, SF)
        after = docs.collect()
        if name != "sharding":
            assert docs.columns == before.columns
        if name == "quality":
            labels = {r.doc_id: r.quality for r in read(spark, SF, "labels").collect()}
            gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in after}
            assert gone and sum(labels.get(i, 0) for i in gone) <= 0.1 * len(gone)
        if name == "near_dedup":
            assert near_dedup.near_duplicates(docs, 5, 80).filter("not kept").count() == 0
        if name == "decontamination":
            assert decontaminate.contamination(docs, read(spark, SF, "benchmark")).filter("contaminated").count() == 0
        if name == "mixing":
            want = {r.doc_id: len(r.copies) for r in mixing.mix_sources(before).collect()}
            got = {r.doc_id: r["count"] for r in docs.groupBy("doc_id").count().collect()}
            assert got == {i: n for i, n in want.items() if n}
        if name == "sharding":
            assert len(after) == before.count() and {r.shard for r in after} <= set(range(16))


def test_stages_take_empty_and_extra_columns(spark, docs_of):
    docs = docs_of([(1, "some words here"), (2, None), (None, "x")], {"copies": F.lit(1), "shard": F.lit("s")})
    for name, stage in P.STAGES[1:]:
        out = stage(spark, docs, SF)
        if name != "sharding":
            assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_mixing_takes_rows_not_ids(spark, docs_of):
    rows = [(None, "a b c", "s"), (None, "d e f", "s")] + [(7, f"same id {k}", "s") for k in range(5)] + [(8, "g h i", "s")]
    docs = docs_of(rows)
    want = sorted(len(r.copies) for r in mixing.mix_sources(docs).collect())
    out = P.mixing_stage(spark, docs, SF).collect()
    got = Counter(r.text for r in out)
    assert len(out) == sum(want) and sorted(got[t] for _, t, _ in rows) == want
    assert {(r.doc_id, r.text) for r in out} <= {(i, t) for i, t, _ in rows} and max(want) == 2


def test_mixing_is_in_training_order(spark, docs_of):
    docs = docs_of([(k, f"{k} " * 10, f"s{k % 3}") for k in range(600)])
    want = [r.doc_id for r in mixing.training_order(mixing.mix_sources(docs)).collect()]
    out = stored(P.mixing_stage(spark, docs, SF), "order-test")
    files = sorted(out.inputFiles())
    assert [r.doc_id for f in files for r in spark.read.parquet(f).collect()] == want
