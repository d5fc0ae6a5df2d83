"""Tables that grow by numbered batches and are read through a list of commits.

A batch is written to a folder of its own attempt,
``root/query=<q>/batch=<n>/attempt=<a>/``, and counts from the moment its
commit stands in ``root/_commits/<q>/``: one small JSON line with the attempt,
the counts measured while writing and the marks (a watermark, the input
batches consumed) that hold after it.  Data, counts and marks become visible
together, by the rename of that file.

Writing a batch number again replaces the batch: the new attempt is complete
before its commit takes the place of the old one.  So a streaming query whose
micro-batch is replayed (a fault after the write, before Spark's own commit)
leaves every record once, and a write that stopped half-way is never read.
"""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.catalog import _fs, path_exists

COMPACT_EVERY = 64   # commits that are then kept in one file
OPEN_WRITERS = 8     # folders that a task of a batch fills at a time


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, jpath, _ = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(jpath)] if fs.exists(jpath) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, jpath, _ = _fs(spark, path)
    fs.delete(jpath, True)


def _read_text(spark: SparkSession, path: str) -> str:
    """A small file, read by the driver itself: no Spark job for a line."""
    fs, jpath, jvm = _fs(spark, path)
    stream = fs.open(jpath)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under another name, then rename it into place over what stands there."""
    fs, target, jvm = _fs(spark, path)
    temp = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    out = fs.create(temp, True)
    out.write(text.encode())
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(temp, target, options)


@contextmanager
def open_writers(spark: SparkSession, most: int = OPEN_WRITERS):
    """Folders of a partitioned write are filled side by side, up to ``most`` in a task, instead of
    sorting each task's rows by folder first.  For columns with few values, such as ``kind``."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, max(int(before), most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class CommitLog:
    """Commits of one query by batch number.  Every ``COMPACT_EVERY`` batches the log becomes one file,
    so a reader opens a bounded number of small files whatever the table's age."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def entries(self) -> dict[int, dict]:
        names = [n for n in _names(self.spark, self.path) if n.endswith(".json") and not n.startswith((".", "_"))]
        compact = max((n for n in names if n.endswith(".compact.json")), default=None)
        singles = sorted(n for n in names if not n.endswith(".compact.json"))
        out: dict[int, dict] = {}
        for name in ([compact] if compact else []) + singles:    # a single commit is newer than the compact file
            for line in _read_text(self.spark, f"{self.path}/{name}").splitlines():
                one = json.loads(line)
                out[one["batch"]] = one
        return out

    def commit(self, entry: dict) -> None:
        batch = entry["batch"]
        known = self.entries() if (batch + 1) % COMPACT_EVERY == 0 else None
        _write_text(self.spark, f"{self.path}/{batch:012d}.json", json.dumps(entry) + "\n")
        if known is not None:
            known[batch] = entry
            _write_text(self.spark, f"{self.path}/{batch:012d}.compact.json",
                        "".join(json.dumps(known[b]) + "\n" for b in sorted(known)))
            for name in _names(self.spark, self.path):
                if name.endswith(".json") and name[:12].isdigit() and name[:12] <= f"{batch:012d}" and name != f"{batch:012d}.compact.json":
                    _delete(self.spark, f"{self.path}/{name}")


class BatchTable:
    """Parquet rows of committed batches.

    ``schema`` declares the rows; ``partition_by`` names columns that become
    folders (such as ``kind``), so that reading one value opens its files alone.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, partition_by: tuple[str, ...] = ()):
        self.spark, self.root, self.schema, self.partition_by = spark, root.rstrip("/"), schema, tuple(partition_by)

    def log(self, query: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/_commits/{query}")

    def queries(self) -> list[str]:
        return sorted(_names(self.spark, f"{self.root}/_commits"))

    def commits(self, query: str | None = None) -> list[dict]:
        """Committed batches in order, of one query or of all."""
        names = [query] if query is not None else self.queries()
        return [{"query": q, **e} for q in names for _, e in sorted(self.log(q).entries().items())]

    def last(self, query: str, before: int | None = None) -> dict | None:
        """The newest commit of a query, of those before a batch if one is given."""
        got = [c for c in self.commits(query) if before is None or c["batch"] < before]
        return got[-1] if got else None

    def folder(self, commit: dict) -> str:
        return f"{self.root}/query={commit['query']}/batch={commit['batch']:012d}/attempt={commit['attempt']}"

    def read(self, commits: list[dict] | None = None) -> DataFrame:
        """Rows of the given commits, or of all; folders that no commit names are not opened."""
        commits = self.commits() if commits is None else commits
        folders = [self.folder(c) for c in commits if c["rows"]]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        frame = None
        for at in range(0, len(folders), 1000):
            some = self.spark.read.schema(self.schema).option("basePath", self.root).parquet(*folders[at:at + 1000]).select(self.schema.names)
            frame = some if frame is None else frame.unionByName(some)
        return frame

    def write(self, rows: DataFrame, query: str, batch: int, counts: dict[str, Column] | None = None,
              keep: Column | None = None, marks=None) -> dict:
        """Write ``rows`` as batch ``batch`` of ``query`` and commit it; a batch of that number is replaced.

        ``counts`` are aggregates taken of all ``rows`` by the writing job
        itself; ``keep`` then says which of them are stored.  ``marks`` (a dict,
        or a function of the counts that gives one) is committed with the data.
        """
        seen = Observation()
        stored = F.lit(True) if keep is None else keep
        observed = rows.observe(seen, F.count(F.when(stored, 1)).alias("rows"), *[c.alias(n) for n, c in (counts or {}).items()])
        entry = {"query": query, "batch": batch, "attempt": uuid.uuid4().hex[:12]}
        writer = observed.filter(stored).select(self.schema.names).write
        if self.partition_by:
            with open_writers(rows.sparkSession):
                writer.partitionBy(*self.partition_by).parquet(self.folder(entry))
        else:
            writer.parquet(self.folder(entry))
        got = dict(seen.get)
        entry |= {"rows": got.pop("rows"), "counts": got}
        entry["marks"] = marks(got) if callable(marks) else dict(marks or {})
        self._commit(entry)
        return entry

    def _commit(self, entry: dict) -> None:
        log = self.log(entry["query"])
        log.commit({k: v for k, v in entry.items() if k != "query"})
        parent = f"{self.root}/query={entry['query']}/batch={entry['batch']:012d}"
        for name in _names(self.spark, parent):      # attempts that this one replaces, or that never ended
            if name != f"attempt={entry['attempt']}":
                _delete(self.spark, f"{parent}/{name}")

    def append(self, rows: DataFrame, query: str = "load", **how) -> dict:
        """Write ``rows`` as the next batch of ``query``."""
        last = self.last(query)
        return self.write(rows, query, last["batch"] + 1 if last else 0, **how)

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.root}/_commits")


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the streaming query of a checkpoint folder: a new checkpoint is a new query."""
    return json.loads(_read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]
