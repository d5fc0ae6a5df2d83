"""Bronze tables: committed batches of classified landing lines.

Batch jobs and streams fill the same tables.  Each batch holds its rows, bad
records and bad pages (a folder for each kind) from one parse, with the counts
of all of them in its commit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.dedupe import insert_ignore
from strata.schemas import ARRIVAL, BRONZE, KEYS
from strata.sources import pages
from strata.sources.batches import BatchTable

KINDS = (pages.ROW, pages.BAD_RECORD, pages.BAD_PAGE, pages.EMPTY_PAGE)


def count_of(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


class BronzeTable(BatchTable):
    """Insert-once on the key (first arrival wins); plain append for tables without one."""

    def __init__(self, spark: SparkSession, root: str, name: str, keys: Sequence[str] | None = None, arrival: Sequence | None = None):
        self.name, self.columns = name, BRONZE[name].fieldNames()
        self.keys = list(KEYS[name]) if keys is None else list(keys)
        self.arrival = [F.col(c).asc() for c in ARRIVAL.get(name, [])] if arrival is None else list(arrival)
        fields = [T.StructField(f.name, f.dataType, True) for f in BRONZE[name].fields]
        super().__init__(spark, root, T.StructType(fields + [T.StructField("raw", T.StringType()), T.StructField("kind", T.StringType())]),
                         partition_by=("kind",))

    def lines(self, kind: str, commits: list[dict] | None = None) -> DataFrame:
        return super().read(commits).filter(F.col("kind") == kind).drop("kind")

    def read(self, commits: list[dict] | None = None) -> DataFrame:
        """The bronze rows."""
        return self.lines(pages.ROW, commits).select(self.columns)

    def measures(self) -> dict[str, Column]:
        """What the writing job counts: pages, lines of each kind, and of the records' columns the nulls."""
        record = F.col("kind").isin(pages.ROW, pages.BAD_RECORD)
        return {"pages": count_of(F.col("first")), **{k: count_of(F.col("kind") == k) for k in KINDS},
                **{f"null_{c}": count_of(record & F.col(c).isNull()) for c in self.columns}}

    def load(self, lines: DataFrame, query: str, batch: int, check=None) -> dict:
        """Write classified ``lines`` as one batch.  ``check(counts)`` may raise before anything is committed.

        Without keys the lines are written as they are parsed.  With keys the
        parsed batch is kept on the executors' disks (recomputed if they are
        lost), as it is read for the keys, for the rows and for the counts.
        """
        def marks(counts: dict) -> dict:
            if check is not None:
                check(counts)
            return {}
        stored = F.col("kind") != pages.EMPTY_PAGE
        if not self.keys:
            return self.write(lines, query, batch, counts=self.measures(), keep=stored, marks=marks)
        lines = lines.persist(StorageLevel.DISK_ONLY)
        try:
            counts = lines.agg(*[c.alias(n) for n, c in self.measures().items()]).first().asDict()
            marks(counts)
            others = [c for c in self.commits() if (c["query"], c["batch"]) != (query, batch)]
            seen = self.read(others).select(self.keys) if any(c["rows"] for c in others) else None
            fresh = insert_ignore(seen, lines.filter(F.col("kind") == pages.ROW), self.keys, self.arrival,
                                  rows=counts[pages.ROW])
            return self.write(fresh.unionByName(lines.filter(F.col("kind") != pages.ROW)), query, batch, keep=stored,
                              counts={"new_rows": count_of(F.col("kind") == pages.ROW)}, marks={"incoming": counts})
        finally:
            lines.unpersist()


def incoming(commit: dict) -> dict:
    """Counts of everything that came with a batch, whatever of it was kept."""
    return commit["marks"].get("incoming", commit["counts"])
