"""Sharding by minimax contiguous partition.

Groups of equal texts are atomic.  They are ordered by digest; the shard
capacity is the smallest one for which filling shards greedily, in that
order, needs no more than ``shards`` of them, found by binary search with
a greedy check.

The ordered sizes may be billions, so the driver never sees them all.  It
holds a bounded table of *knots*: known positions in the running total,
each with the number of groups since the last knot.  Greedy filling on
knots gives a lower and an upper end for every cut, hence capacities that
are surely feasible or surely not; the search runs between them.  Only the
stretches of the order in which a cut may still fall are asked for again,
at finer steps, until the capacity and all cuts are exact.  Each level is
one aggregation that returns at most ``knots`` rows.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.tables import materialize

KNOTS = 8192     # most rows a level returns to the driver
BUCKETS = 1024   # digest ranges in which running totals are built, and slot ranges of a shard


def group_totals(rows: DataFrame) -> DataFrame:
    """``(digest, bytes, upto)`` in digest order; ``upto`` is the running total of bytes through the group."""
    groups = (rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
              .withColumn("bucket", F.expr(f"cast(conv(substring(digest, 1, 8), 16, 10) as long) * {BUCKETS} div 4294967296")))
    groups = materialize(groups)
    totals = sorted((r.bucket, r.b) for r in groups.groupBy("bucket").agg(F.sum("bytes").alias("b")).collect())
    before, at = [], 0
    for bucket, b in totals:   # at most BUCKETS rows
        before.append((bucket, at))
        at += b
    spark = rows.sparkSession
    offsets = spark.createDataFrame(before, "bucket long, before long")
    running = Window.partitionBy("bucket").orderBy("digest")
    return materialize(groups.join(F.broadcast(offsets), "bucket")
                       .select("digest", "bytes", (F.col("before") + F.sum("bytes").over(running)).alias("upto")))


class Knots:
    """Known ends of groups in the running total, each with the number of groups since the knot before it."""

    def __init__(self, total: int, groups: int):
        self.total, self.ends, self.counts = total, [0, total], [0, groups]

    def refine(self, start: int, end: int, found: list[tuple[int, int]]) -> None:
        """Put the knots ``(end, groups)`` in place of those in ``start < knot <= end``."""
        i, j = bisect_right(self.ends, start), bisect_right(self.ends, end)
        self.ends[i:j], self.counts[i:j] = [e for e, _ in found], [n for _, n in found]

    def floor(self, x: int) -> int:
        return self.ends[bisect_right(self.ends, x) - 1]

    def ceiling(self, x: int) -> int:
        """The last position up to ``x`` at which a group may end."""
        i = bisect_right(self.ends, x)
        if i == len(self.ends):
            return self.ends[-1]
        return self.ends[i - 1] if self.counts[i] == 1 else min(x, self.ends[i] - 1)

    def cuts(self, capacity: int, shards: int) -> list[tuple[int, int]]:
        """Lower and upper end of each shard that is filled greedily to ``capacity``."""
        low, high, out = 0, 0, []
        for _ in range(shards):
            low, high = self.floor(low + capacity), self.ceiling(high + capacity)
            out.append((low, high))
        return out

    def smallest(self, shards: int, low: int, high: int, bound: int) -> int:
        """Smallest capacity in ``low..high`` whose lower (0) or upper (1) cuts reach the total."""
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards)[-1][bound] >= self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def unknown(self, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """For each range the stretch of knots, from the first to the last of several groups, that it
        touches; stretches that meet are joined."""
        out: list[tuple[int, int]] = []
        for low, high in sorted(ranges):
            i = bisect_right(self.ends, low)
            several = []
            while i < len(self.ends) and self.ends[i - 1] < high:
                if self.counts[i] > 1:
                    several.append(i)
                i += 1
            if several:
                s, e = self.ends[several[0] - 1], self.ends[several[-1]]
                if out and s <= out[-1][1]:
                    out[-1] = (out[-1][0], max(e, out[-1][1]))
                else:
                    out.append((s, e))
        return out


def finer(groups: DataFrame, stretches: list[tuple[int, int]], width: int) -> list[list[tuple[int, int]]]:
    """For each stretch its knots: the last end of a group in every ``width`` of the running total."""
    inside = F
    for k, (s, e) in enumerate(stretches):   # one for each cut at most
        inside = inside.when((F.col("upto") > s) & (F.col("upto") <= e), k)
    found = (groups.withColumn("stretch", inside).filter("stretch is not null")
             .groupBy("stretch", F.expr(f"(upto - 1) div {width}").alias("cell"))
             .agg(F.max("upto").alias("end"), F.count("*").alias("n")).collect())
    out: list[list[tuple[int, int]]] = [[] for _ in stretches]
    for r in found:
        out[r.stretch].append((r.end, r.n))
    return [sorted(x) for x in out]


def minimax_cuts(groups: DataFrame, shards: int, knots: int = KNOTS) -> tuple[int, list[int]]:
    """The smallest feasible capacity and the positions at which each shard ends.

    A level returns about ``knots`` rows, or a few times the square of
    ``shards`` when that is more.  Steps at least halve from level to level.
    """
    row = groups.agg(F.max("upto").alias("total"), F.max("bytes").alias("largest"), F.count("*").alias("n")).first()
    if not row.n:
        return 0, [0] * shards
    known = Knots(row.total, row.n)
    even = -(-row.total // shards)
    low, high, width = max(even, row.largest), even + row.largest, 2 * row.total
    while True:
        high = known.smallest(shards, low, high, 0)   # surely feasible
        low = known.smallest(shards, low, high, 1)    # every capacity below is surely not
        first, last = known.cuts(low, shards), known.cuts(high, shards)
        stretches = known.unknown([(a, b) for (a, _), (_, b) in zip(first, last)])
        if not stretches:
            return high, [a for a, _ in last]
        width = max(1, min(width // 2, 2 * sum(e - s for s, e in stretches) // knots))
        for (s, e), found in zip(stretches, finer(groups, stretches, width)):
            known.refine(s, e, found)


def assign_shards(docs: DataFrame, shards: int = 16, text: str = "text", doc_id: str = "doc_id",
                  knots: int = KNOTS) -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The law is ``bytes``: sizes (UTF-8 bytes of the text plus 1) are as even
    as contiguous runs of whole groups allow.  Null text has no bytes and
    goes with the empty texts.  ``slot`` numbers the rows of a shard from 0
    without gaps, in hash order of the ids (ties in any order).  Extra
    columns are ignored; an empty table gives an empty result; shards may
    stay empty when there are fewer groups than shards.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = materialize(docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body).alias("text_crc32"), F.sha2(body, 256).alias("digest")))
    groups = group_totals(rows)
    _, ends = minimax_cuts(groups, shards, knots)
    last = {r.upto: r.digest for r in groups.filter(F.col("upto").isin(ends)).select("upto", "digest").collect()}
    # The digest at each cut says where a row goes: no join and no shuffle for it, however many copies a text has.
    bounds = [last[e] for e in ends[:-1] if e in last]
    shard = sum(((F.col("digest") > b).cast("int") for b in bounds), F.lit(0))
    placed = rows.select("doc_id", "size", "text_crc32", shard.alias("shard"),
                         F.pmod(F.xxhash64("doc_id", "digest"), F.lit(BUCKETS)).alias("sub"))
    placed = materialize(placed)
    counts = sorted((r.shard, r.sub, r.n) for r in placed.groupBy("shard", "sub").agg(F.count("*").alias("n")).collect())
    offsets, at = [], {}
    for s, sub, n in counts:   # at most shards * BUCKETS rows
        offsets.append((s, sub, at.get(s, 0)))
        at[s] = at.get(s, 0) + n
    offsets = docs.sparkSession.createDataFrame(offsets, "shard int, sub long, before long")
    within = Window.partitionBy("shard", "sub").orderBy(F.xxhash64("doc_id"), "doc_id")
    return (placed.join(F.broadcast(offsets), ["shard", "sub"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("before") + F.row_number().over(within) - 1).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
