"""Tables on a shared file system: insert-once (bronze) and versioned
snapshots (silver / gold), plus catalog helpers.

A :class:`SnapshotTable` is a folder of versions ``v=<n>``; a version counts
once Spark's commit has written ``_SUCCESS`` into it.  An upsert reads the
current version and writes the next one, so a table is never overwritten
while it is being read, a failed job leaves the current version intact,
and a retried task is handled by Spark's output committer.  An
:class:`AppendTable` is a single parquet folder that only ever receives
appended files.  Listing uses the Hadoop FileSystem of the path, so the same
code runs on a local disk, HDFS or an object store.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.dedupe import insert_ignore
from strata.operators.merge import as_inserts, merge_upsert


def table_exists(spark: SparkSession, name: str) -> bool:
    """Source-existence guard (catalog tables and temp views)."""
    return spark.catalog.tableExists(name)


def table_columns(spark: SparkSession, name: str) -> list[str]:
    return spark.table(name).columns


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath, jvm


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path`` on its file system (no-op if absent)."""
    fs, jpath, _ = _fs(spark, path)
    return bool(fs.exists(jpath) and fs.delete(jpath, True))


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a glob matches (listing only, no file is opened)."""
    fs, jpath, _ = _fs(spark, pattern)
    return [st.getPath().toString() for st in fs.globStatus(jpath) or []]


def has_data(spark: SparkSession, path: str) -> bool:
    """Does a table folder hold data (any entry not starting with _ or .)?"""
    fs, jpath, _ = _fs(spark, path)
    if not fs.exists(jpath):
        return False
    return any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(jpath))


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath, _ = _fs(spark, path)
    return fs.exists(jpath)


class SnapshotTable:
    """Versioned parquet table with snapshot-swap writes."""

    def __init__(self, spark: SparkSession, root: str, schema=None, keys: Sequence[str] = ()):
        self.spark, self.root, self.schema, self.keys = spark, root.rstrip("/"), schema, list(keys)

    def versions(self) -> list[int]:
        fs, jpath, jvm = _fs(self.spark, self.root)
        if not fs.exists(jpath):
            return []
        out = []
        for st in fs.listStatus(jpath):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith("v="):
                if fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                    out.append(int(name[2:]))
        return sorted(out)

    def current_version(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def path(self, version: int) -> str:
        return f"{self.root}/v={version:08d}"

    def read(self, version: int | None = None) -> DataFrame:
        version = self.current_version() if version is None else version
        if version is None or not has_data(self.spark, self.path(version)):
            if self.schema is None:
                raise FileNotFoundError(f"no data under {self.root}")
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.parquet(self.path(version))

    def write(self, df: DataFrame, partition_cols: Sequence[str] = ()) -> int:
        """Commit ``df`` as the next version; returns its number.  A version
        that a failed write left behind keeps its number and is skipped."""
        fs, jpath, _ = _fs(self.spark, self.root)
        names = [st.getPath().getName() for st in fs.listStatus(jpath)] if fs.exists(jpath) else []
        nxt = max([int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit()], default=0) + 1
        w = df.write.mode("errorifexists")
        if partition_cols:
            w = w.partitionBy(*partition_cols)
        w.parquet(self.path(nxt))
        return nxt

    def upsert(self, source: DataFrame, rules=None, now: Column | None = None,
               updated_col: str | None = "last_updated") -> int:
        merged = merge_upsert(self.read(), source, self.keys, rules, now, updated_col)
        if self.keys:
            # Co-locate rows by key so the next merge's join input is clustered.
            merged = merged.repartition(*self.keys)
        return self.write(merged)


class AppendTable:
    """Insert-once parquet table (bronze)."""

    def __init__(self, spark: SparkSession, root: str, schema=None, keys: Sequence[str] = ()):
        self.spark, self.root, self.schema, self.keys = spark, root.rstrip("/"), schema, list(keys)

    def read(self) -> DataFrame:
        if self._has_files():
            return self.spark.read.parquet(self.root)
        if self.schema is None:
            raise FileNotFoundError(self.root)
        return self.spark.createDataFrame([], self.schema)

    def _has_files(self) -> bool:
        fs, jpath, _ = _fs(self.spark, self.root)
        return fs.exists(jpath) and any(st.getPath().getName().endswith(".parquet")
                                        for st in fs.listStatus(jpath))

    def append(self, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.root)

    def insert_ignore(self, incoming: DataFrame, arrival_order: Sequence) -> DataFrame:
        """Append only rows whose key is new (first per key in arrival order).
        Tables without a natural key append everything.  The delta is
        materialised to a staging folder first, so the append never reads
        the folder it writes to."""
        if not self.keys:
            self.append(incoming)
            return incoming
        delta = insert_ignore(self.read(), incoming, self.keys, arrival_order)
        stage = f"{self.root}.__staging"
        delta.write.mode("overwrite").parquet(stage)
        staged = self.spark.read.parquet(stage)
        self.append(staged)
        return staged


class PartitionedTable:
    """Keyed parquet table partitioned by a column derived from the key;
    an upsert rewrites only the partitions its batch touches.

    ``part_expr`` must depend on key columns only, so a key never moves
    between partitions: e.g. the month of ``trade_time`` for trades keyed on
    (client_id, trade_time) - a daily load touches one or two months - or a
    hash bucket of the key.  The upsert merges the touched partitions with
    the batch, stages the result beside the table (a complete Spark job),
    then swaps exactly those partitions in with a dynamic partition
    overwrite.  If the swap is interrupted, re-running the same upsert
    reproduces the same partitions (the merge rules are idempotent).
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], part_col: str, part_expr,
                 schema=None):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)
        self.part_col, self.part_expr, self.schema = part_col, part_expr, schema

    def exists(self) -> bool:
        """Whether the table holds data; an optional marker file says nothing."""
        return has_data(self.spark, self.root)

    def _current(self) -> DataFrame:
        """Stored rows with the partition column in its declared type, so
        that a table of the NULL partition alone reads like any other."""
        reader = self.spark.read
        if self.schema is not None:
            reader = reader.schema(self._with_part(self.spark.createDataFrame([], self.schema)).schema)
        return reader.parquet(self.root)

    def read(self) -> DataFrame:
        if not has_data(self.spark, self.root):
            if self.schema is None:
                raise FileNotFoundError(self.root)
            return self.spark.createDataFrame([], self.schema)
        return self._current().drop(self.part_col)

    def read_partitions(self, values: Sequence) -> DataFrame:
        """The rows of some partitions; the folders of others are not opened."""
        if not self.exists():
            return self.read()
        return self._current().filter(F.col(self.part_col).isin(list(values))).drop(self.part_col)

    def _with_part(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.part_col, self.part_expr())

    def write(self, df: DataFrame) -> None:
        """Replace the whole table (first load)."""
        (self._with_part(df).write.mode("overwrite").partitionBy(self.part_col).parquet(self.root))

    def upsert(self, source: DataFrame, rules=None, now: Column | None = None,
               updated_col: str | None = "last_updated", stored: bool = False) -> list:
        """Merge ``source`` into the partitions it touches, the NULL partition
        included; returns their values (one per folder rewritten).  ``stored``:
        as for :func:`merge_upsert`."""
        if not self.exists():
            if self.schema is None:
                stamp = now if now is not None else F.current_timestamp().cast("timestamp_ntz")
                self.write(source.withColumn(updated_col, stamp) if updated_col else source)
            else:
                self.write(as_inserts(self.read(), source, now, updated_col))
            return []
        touched = self._with_part(source.select(*self.keys)).select(self.part_col).distinct()
        current = self._current()
        # Touched partitions by a join on the partition column (pruned at run
        # time); equality never matches NULL, so that partition is added by itself.
        target = current.join(touched.filter(F.col(self.part_col).isNotNull()), self.part_col, "left_semi")
        if not touched.filter(F.col(self.part_col).isNull()).isEmpty():
            target = target.unionByName(current.filter(F.col(self.part_col).isNull()))
        merged = self._with_part(merge_upsert(target.drop(self.part_col), source, self.keys, rules, now, updated_col, stored=stored))
        stage = f"{self.root}.__staging/{uuid.uuid4().hex}"
        merged.write.parquet(stage)
        staged = self.spark.read.schema(merged.schema).parquet(stage)
        # One exchange by partition: few files each, and a partition's files are split by size.
        (staged.select(*current.columns).hint("rebalance", self.part_col).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(self.part_col).parquet(self.root))
        fs, jpath, _ = _fs(self.spark, stage)
        fs.delete(jpath, True)   # this upsert's own staging folder
        return [r[0] for r in touched.collect()]
