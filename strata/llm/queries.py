"""One registered query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (chunk_dedup, column_bwt, conversations, decontaminate, exact_dedup, filter_audit, hmm, html_text, mixing, near_dedup, quality,
                        sharding, toxicity)
from strata.llm.tables import read


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = toxicity.toxicity_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return report.select("doc_id", "held_out", "score", "predicted")


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = hmm.language_model_scores(read(spark, sf_dir, "documents"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(read(spark, sf_dir, "documents"))
    return (mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "position")
            .orderBy("position", "doc_id"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.repeated_passages(read(spark, sf_dir, "documents"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"), size=3, percent=85)


def op6_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read(spark, sf_dir, "documents"), shards=16)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.quality_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return report.select("doc_id", "held_out", "score", "predicted")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(read(spark, sf_dir, "pages"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_bwt.repeated_substrings(read(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.damage_and_repair(read(spark, sf_dir, "conversations")).drop("n_rows")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_language_model, op3_mix_sources, op4_substring_dedup, op5_near_dedup, op6_shard,
                                     op7_quality, op8_decontaminate, op9_html_text, op10_exact_dedup, op11_filter_audit,
                                     op12_suffix_dedup, op13_conversation_repair, pipeline)}


OP8_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(w[s:s + 9], ' ') AS g, least(len(w), 10) AS m
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS s FROM b WHERE len(w) > 0)),
place AS (SELECT doc_id, k AS m, s, array_to_string(w[s:s + k - 1], ' ') AS g
          FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s
                FROM d, (SELECT DISTINCT m AS k FROM win) WHERE len(w) >= k)),
hit AS (SELECT p.doc_id, p.s, p.m, win.item_id FROM place p JOIN win USING (g, m)),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
          FROM hit GROUP BY doc_id),
covered AS (SELECT doc_id, count(DISTINCT word_no) AS n_hit
            FROM (SELECT doc_id, unnest(range(s, s + m)) AS word_no FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN items USING (doc_id) LEFT JOIN covered USING (doc_id)
"""

OP10_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

OP11_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first_id FROM t),
lab AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
        FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
f AS (SELECT part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
             100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS c,
             regexp_matches(text, '[#$%&*|]') AS d, coalesce(first_id < w.doc_id, false) AS e,
             coalesce(good, 0) = 1 AS good, coalesce(toxic, 0) = 1 AS toxic
      FROM w LEFT JOIN lab USING (doc_id)),
fails AS (SELECT *, map {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} AS m, a::INT + b::INT + c::INT + d::INT + e::INT AS n_fails FROM
          (SELECT part, a, b, c, d, e, good, toxic, count(*) AS docs FROM f GROUP BY ALL)),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM letters p, letters q, letters r, letters s, letters t
           WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
steps AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own, string_split(substr(filter_order, 1, step - 1), '') AS earlier
          FROM orders, (SELECT unnest(range(1, 6))::INT AS step)),
hit AS (SELECT part, filter_order, step, docs, good, toxic, n_fails, m[own] AS own_fails,
               len(list_filter(earlier, lambda x: x <> '' AND m[x])) > 0 AS gone
        FROM fails, steps)
SELECT part, filter_order, step,
       coalesce(sum(docs) FILTER (NOT gone AND NOT own_fails), 0)::BIGINT AS kept,
       coalesce(sum(docs) FILTER (NOT gone AND own_fails), 0)::BIGINT AS removed,
       coalesce(sum(docs) FILTER (gone AND own_fails), 0)::BIGINT AS redundant,
       coalesce(sum(docs) FILTER (own_fails AND n_fails = 1), 0)::BIGINT AS unique_fails,
       coalesce(sum(docs) FILTER (NOT gone AND own_fails AND good), 0)::BIGINT AS good_lost,
       coalesce(sum(docs) FILTER (NOT gone AND own_fails AND toxic), 0)::BIGINT AS toxic_lost,
       coalesce(sum(docs * (120 // greatest(n_fails, 1))) FILTER (own_fails), 0)::BIGINT AS shapley
FROM hit GROUP BY part, filter_order, step
"""

# Texts are cut into overlapping blocks first, as taking a piece of a blob costs its whole length.
OP12_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, encode(coalesce(text, '')) AS b FROM documents),
blocks AS (SELECT r, doc_id, s, b[s + 1:s + 599] AS b FROM (SELECT r, doc_id, b, unnest(range(0, octet_length(b) - 99, 500)) AS s FROM d WHERE octet_length(b) >= 100)),
w AS (SELECT r, doc_id, s + k AS s, row_number() OVER (PARTITION BY b[k + 1:k + 100] ORDER BY doc_id, s + k) > 1 AS again
      FROM (SELECT r, doc_id, s, b, unnest(range(0, octet_length(b) - 99)) AS k FROM blocks)),
marks AS (SELECT r, s, coalesce(s > lag(s) OVER (PARTITION BY r ORDER BY s) + 100, TRUE) AS starts FROM w WHERE again),
runs AS (SELECT r, s, sum(starts::INT) OVER (PARTITION BY r ORDER BY s) AS run FROM marks),
spans AS (SELECT r, run, min(s) AS a, max(s) + 100 AS e FROM runs GROUP BY r, run),
pieces AS (SELECT r, a, e, coalesce(lag(e) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans),
cut AS (SELECT r, sum(e - a)::BIGINT AS n_removed, count(*) AS n_spans, max(e) AS last,
               string_agg(hex(b[before + 1:a]), '' ORDER BY a) AS kept FROM pieces JOIN d USING (r) GROUP BY r)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(CASE WHEN n_spans IS NULL THEN b ELSE unhex(kept || hex(b[last + 1:octet_length(b)])) END) AS kept_sha256
FROM d LEFT JOIN cut USING (r)
"""


def oracle() -> dict[str, str]:
    return {"op8_decontaminate": OP8_SQL, "op10_exact_dedup": OP10_SQL, "op11_filter_audit": OP11_SQL, "op12_suffix_dedup": OP12_SQL}
