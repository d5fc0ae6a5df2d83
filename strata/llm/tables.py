"""Small helpers shared by the operators: input columns, stored intermediates, column functions on text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import kernels
from strata.session import materialize, work_dir

__all__ = ["materialize", "read", "stored", "numbered", "shuffled", "without_keys", "word_count", "crc_remainder"]

BLOCKS_PER_FILE = 8           # rows that hold some megabytes each
BROADCAST_KEYS = 1_000_000   # row keys of 8 or 16 bytes


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back:
    lineage is cut, columns can be pruned, and a lost executor loses nothing.

    Readers take thousands of rows of a file into memory at once; rows of megabytes need ``rows_per_file``.
    """
    path = work_dir(df.sparkSession, "llm", name)
    df.write.option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` to be joined by sorting, never broadcast: the size that Spark expects of rows out of compressed
    files, of pruned columns and of exploded arrays can be a fraction of theirs, and a broadcast fills the driver."""
    return df.hint("merge")


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``key`` (a number of its own for every row) and ``row`` (all columns, whatever their names), written once,
    so that null and repeated ids are rows like any other and every reader sees the same numbers."""
    return stored(docs.select(F.monotonically_increasing_id().alias("key"), F.struct("*").alias("row")), name)


def without_keys(keyed: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of documents as ``key`` and ``row`` without the keys ``gone``, which are broadcast up to ``BROADCAST_KEYS``."""
    gone = materialize(gone.select("key"))
    return keyed.join(F.broadcast(gone) if gone.count() <= BROADCAST_KEYS else shuffled(gone), "key", "left_anti").select("row.*")


def crc_remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % modulus


def count_words(texts: pa.Array) -> pa.Array:
    out = np.zeros(len(texts), dtype=np.int64)
    for at, data, offsets in kernels.slices(texts):
        _, _, row = kernels.words(data, offsets)
        out[at:at + len(offsets) - 1] = np.bincount(row, minlength=len(offsets) - 1)
    return pa.array(out)


def word_count(text: Column) -> Column:
    """Number of words between white space; 0 for null."""
    @F.arrow_udf(T.LongType())
    def counted(texts: pa.Array) -> pa.Array:
        return count_words(texts)
    return counted(text)
