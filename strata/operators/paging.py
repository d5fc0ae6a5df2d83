"""Positional pages of a large ordered table.

The table is range-partitioned by its order once, each range sorted and
numbered; the row counts of the ranges say which of them hold page ``n``, and
only their folders are read.  A page at the end costs what the first page costs.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.catalog import SnapshotTable

ROWS_PER_RANGE = 1_000_000
RANGE, PLACE = "page_range", "page_place"


class PagedTable:
    """An ordered copy of a frame, read by page number.  Give an order without ties."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.rows, self.sizes, self.shape = (SnapshotTable(spark, f"{self.root}/{part}") for part in ("rows", "sizes", "shape"))

    def write(self, df: DataFrame, order_by: Sequence[Column], ranges: int | None = None) -> None:
        """Store ``df`` in ``order_by`` order, in ``ranges`` ranges (by default one for each million rows)."""
        ranges = ranges or max(1, -(-df.count() // ROWS_PER_RANGE))
        placed = (df.repartitionByRange(ranges, *order_by).sortWithinPartitions(*order_by)
                  .withColumn(RANGE, F.spark_partition_id())
                  # A task numbers its rows from 0: the low 33 bits of the id.
                  .withColumn(PLACE, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
        version = self.rows.write(placed, [RANGE])
        self.shape.write(df.limit(0))      # the columns, for pages beyond the end
        self.rows.schema = placed.schema
        counted = self.rows.read(version).groupBy(RANGE).agg(F.count(F.lit(1)).alias("n"))
        self.sizes.write(counted.withColumn("version", F.lit(version)).coalesce(1))

    def ranges_of(self, page_no: int, page_size: int) -> tuple[int, list[tuple[int, int, int]]]:
        """The version, and ``(range, first place, end place)`` of each range that holds rows of the page."""
        if page_no < 1 or page_size < 1:
            raise ValueError("page_no and page_size must be positive")
        sizes = sorted((r[RANGE], r.n, r.version) for r in self.sizes.read().collect())      # one row a range
        ends = list(accumulate(n for _, n, _ in sizes))
        begin = (page_no - 1) * page_size
        out, at = [], bisect_right(ends, begin)
        while at < len(sizes) and ends[at] - sizes[at][1] < begin + page_size:
            base = ends[at] - sizes[at][1]
            out.append((sizes[at][0], max(begin - base, 0), min(begin + page_size - base, sizes[at][1])))
            at += 1
        return sizes[0][2] if sizes else 0, out

    def page(self, page_no: int, page_size: int) -> DataFrame:
        """Rows of one page in order; none beyond the end."""
        version, parts = self.ranges_of(page_no, page_size)
        if not parts:
            return self.shape.read()
        wanted = F.lit(False)
        for r, begin, end in parts:
            wanted = wanted | ((F.col(RANGE) == r) & (F.col(PLACE) >= begin) & (F.col(PLACE) < end))
        # The folders are pruned by range; the rows left are one page.
        some = self.rows.read(version).filter(F.col(RANGE).isin([r for r, _, _ in parts])).filter(wanted)
        return some.orderBy(RANGE, PLACE).drop(RANGE, PLACE)
