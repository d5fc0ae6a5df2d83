"""Exact duplicates by heavy-hitter split (built-in functions only).

Frequent digests are found with a mergeable Misra-Gries summary (Spark's
``approx_top_k`` keeps a frequent-items sketch of that family: every task
summarises its rows in bounded memory and the summaries merge).  The
candidates it names are verified by an exact count, and the verified
winners - at most ``tracked`` rows - are broadcast: their copies are decided
on the map side and never shuffled.  Every other digest occurs in less than
a ``1 / tracked`` share of the rows, so the ordinary shuffle has no hot key.

Text is read and hashed once; all later steps use the narrow table
(row columns, digest).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.tables import materialize, numbered, without_keys

TRACKED = 1024        # counters of the summary, and so the most rows that are broadcast
SUMMARY_GROUPS = 256  # summaries are merged in this many groups before the last merge


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def heavy_digests(digests: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """Exact ``(digest, keep_id, group_size)`` of the digests that the summary names; at most ``tracked`` rows."""
    part = digests.select("digest", F.pmod(F.spark_partition_id(), F.lit(SUMMARY_GROUPS)).alias("part"))
    summaries = part.groupBy("part").agg(F.expr(f"approx_top_k_accumulate(digest, {tracked})").alias("s"))
    # A constant key, so that an empty table has no summary instead of a broken one.
    named = (summaries.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(s, {tracked}), {tracked})").alias("top"))
             .select(F.explode("top").alias("t")).select(F.col("t.item").alias("digest"), F.col("t.count").alias("n"))
             .filter("n > 1 and digest is not null").select("digest"))
    return (digests.join(F.broadcast(named), "digest", "left_semi")
            .groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
            .filter("group_size > 1"))


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", tracked: int = TRACKED) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Null text counts as empty.  Of equal texts the smallest ``doc_id`` stays
    (a null id sorts after every other and stays only in a group of nulls).
    Rows that repeat an id are all returned; exactly one row of a group is
    ``kept``.  Extra columns are ignored, whatever their names; an empty
    table gives an empty result.
    """
    digests = materialize(docs.select(F.col(doc_id).alias("doc_id"), F.sha2(normalised(F.col(text)), 256).alias("digest")))
    heavy = materialize(heavy_digests(digests, tracked))
    split = digests.join(F.broadcast(heavy.withColumnRenamed("keep_id", "heavy_id")), "digest", "left")
    # Of the rows that repeat the id that stays, one stays: a bounded set, the first rows of the winners.
    first = Window.partitionBy("digest", "doc_id").orderBy(F.lit(0))
    keepers = (split.filter("group_size is not null and doc_id <=> heavy_id")
               .withColumn("kept", F.row_number().over(first) == 1))
    decided = (split.filter("group_size is not null and not (doc_id <=> heavy_id)").withColumn("kept", F.lit(False))
               .unionByName(keepers)
               .select("doc_id", F.col("heavy_id").alias("keep_id"), "group_size", "kept", "digest"))
    group = Window.partitionBy("digest")
    rest = (split.filter("group_size is null").drop("heavy_id", "group_size")
            .withColumn("rn", F.row_number().over(group.orderBy(F.col("doc_id").asc_nulls_last())))
            .select("doc_id", F.min("doc_id").over(group).alias("keep_id"),
                    F.count("*").over(group).alias("group_size"), (F.col("rn") == 1).alias("kept"), "digest"))
    return decided.unionByName(rest).withColumnRenamed("digest", "text_sha256")


def drop_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without the copies: of equal texts one row stays, that of the smallest id (null ids last)."""
    keyed = numbered(docs, "copy-rows")
    digest = F.sha2(normalised(F.col(f"row.`{text}`")), 256)
    place = F.struct(F.col(f"row.`{doc_id}`").isNull(), F.col(f"row.`{doc_id}`"), F.col("key").alias("key"))
    rows = materialize(keyed.select("key", digest.alias("digest"), place.alias("place")))
    stays = rows.groupBy("digest").agg(F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1")
    return without_keys(keyed, rows.join(stays, "digest").filter("key != first.key"))
