"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

Counted as part of ``strata.llm``.  ``STAGES`` names the stages in order;
``run(spark, sf_dir)`` applies them to the documents table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, mixing, near_dedup, quality, sharding
from strata.llm.tables import read, stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    weights = quality.train(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return quality.keep_good(docs, weights)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8)."""
    return near_dedup.drop_near_duplicates(docs, size=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the curriculum takes it (none, one or two whole copies), in training order."""
    return mixing.mixed_documents(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row, shards as even in bytes as whole groups of equal texts allow."""
    return sharding.assign_shards(docs, shards=16).select("doc_id", "size", "text_crc32", "law", "shard", "slot")


STAGES = [("quality", quality_stage), ("near_dedup", near_dedup_stage), ("decontamination", decontamination_stage),
          ("mixing", mixing_stage), ("sharding", sharding_stage)]
ORACLE_SQL = None   # classifier, signatures and schedules have no SQL form; tests hold each stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
