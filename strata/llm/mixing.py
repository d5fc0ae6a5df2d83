"""Mixing sources to target weights as a time-varying curriculum.

Each source has a token target and a weight schedule, a piecewise linear
function of training time 0..1.  The integral of the schedule, scaled to the
target, is the source's cumulative token demand.  Its documents, in hash
order and repeated while the target asks for it, supply those tokens; the
time at which demand reaches a document's place in the supply is its
training position (the demand is inverted segment by segment).  Documents
are then range-sorted by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.tables import materialize, numbered, shuffled, stored, word_count

# Source weights in code point order, repeating; the share of all words to take; most repeats.
WEIGHTS = [5, 2, 1]
SHARE = 1.5
MOST_REPEATS = 2
# Relative weight at training times 0, 1/2 and 1, for each of the weights above: heavy sources lead, light ones close.
SCHEDULES = [[1.4, 1.0, 0.6], [1.0, 1.0, 1.0], [0.4, 1.0, 1.6]]
BUCKETS = 256  # ranges of a source's supply in which running totals are built


def ranked_sources(totals: DataFrame) -> DataFrame:
    """``rank`` of each source by code point, null last, from 0.  Ranges are
    numbered on their own and offset by the ranges before them."""
    key = [F.col("source").isNull(), F.col("source")]
    ranged = materialize(totals.repartitionByRange(*key).withColumn("range", F.spark_partition_id()))
    counts = sorted((r.range, r.n) for r in ranged.groupBy("range").agg(F.count("*").alias("n")).collect())
    offsets, at = [], 0
    for r, n in counts:   # one row per shuffle partition
        offsets.append((r, at))
        at += n
    offsets = totals.sparkSession.createDataFrame(offsets, "range int, before long")
    return (ranged.join(F.broadcast(offsets), "range")
            .withColumn("rank", F.col("before") + F.row_number().over(Window.partitionBy("range").orderBy(*key)) - 1)
            .drop("range", "before"))


def source_targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_REPEATS) -> DataFrame:
    """``totals`` (source, source_size) with ``kind`` (index of its weight) and ``target``.

    Targets are proportional to the weights and stop at ``most`` times the
    source's size; what is cut off is shared again by weight among the rest.
    Each round is one aggregation over the sources.
    """
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    table = materialize(ranked_sources(totals).withColumn("kind", (F.col("rank") % len(weights)).cast("int"))
                        .withColumn("weight", F.element_at(kinds, F.col("kind") + 1)))
    want = (table.agg(F.sum("source_size")).first()[0] or 0) * share
    limit = F.col("source_size") * F.lit(most)
    level = 0.0
    while True:
        above = limit <= F.col("weight") * F.lit(level)
        row = table.agg(F.coalesce(F.sum(F.when(above, limit)), F.lit(0)).alias("full"),
                        F.sum(F.when(~above, F.col("weight"))).alias("open")).first()
        raised = (want - row.full) / row.open if row.open else level
        if raised <= level:
            break
        level = raised
    return table.withColumn("target", F.least(limit.cast("double"), F.col("weight") * F.lit(level)))


def demand_time(done, kind, schedules=SCHEDULES):
    """The training time at which a share ``done`` (0..1) of a source's target has been asked for."""
    out = F.lit(None).cast("double")
    for k, schedule in enumerate(schedules):
        step = 1.0 / (len(schedule) - 1)
        areas = [(a + b) / 2 * step for a, b in zip(schedule, schedule[1:])]
        asked = done * F.lit(sum(areas))
        time, before = F.lit(0.0), 0.0
        for i in range(len(areas)):
            a, slope = schedule[i], (schedule[i + 1] - schedule[i]) / step
            rest = F.greatest(asked - F.lit(before), F.lit(0.0))
            # a*x + slope*x*x/2 = rest, in the form that has no division by a zero slope
            x = 2 * rest / (F.lit(a) + F.sqrt(F.greatest(F.lit(a * a) + 2 * F.lit(slope) * rest, F.lit(0.0))))
            time = F.when(asked >= before, F.least(F.lit(i * step) + x, F.lit((i + 1) * step))).otherwise(time)
            before += areas[i]
        out = F.when(kind == k, time).otherwise(out)
    return out


def mix_sources(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source",
                weights=WEIGHTS, share: float = SHARE, most: int = MOST_REPEATS, schedules=SCHEDULES,
                key: str | None = None) -> DataFrame:
    """One row per input row: ``doc_id, source, size, source_size, target, taken, copies, position``.

    ``size`` counts words (null text: 0).  A source's words are laid out in
    hash order of the ids and repeated up to ``most`` times; the mix takes
    the first ``round(target)`` of them, so ``taken`` sums to the target
    and at most one copy of one document per source is cut.  ``copies``
    lists, per copy of which at least half is taken, its position in
    training time; ``position`` is that of the first copy taken at all.  A
    null source is a source of its own, last in order.  Rows that repeat an
    id are separate documents.  Documents without words take nothing and
    are placed where they stand.  An empty table gives an empty result.
    ``key`` names a column that tells all rows apart; it is returned as well, as ``key``.
    """
    keys = [F.col(key).alias("key")] if key else []
    rows = docs.select(*keys, F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    keys = ["key"] if key else []
    rows = materialize(rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(BUCKETS)).cast("int")))
    parts = materialize(rows.groupBy("source", "bucket").agg(F.sum("size").alias("part_size")))
    totals = parts.groupBy("source").agg(F.sum("part_size").alias("source_size"))
    targets = source_targets(totals, weights, share, most)
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # At most BUCKETS rows per source; the documents of a hot source stay spread over its buckets.
    parts = (parts.withColumn("part_before", F.coalesce(F.sum("part_size").over(upto), F.lit(0))).alias("p")
             .join(targets.alias("t"), F.expr("p.source <=> t.source"))
             .select("p.source", "bucket", "part_before", "source_size", "target", "kind"))
    order = Window.partitionBy("source", "bucket").orderBy(F.xxhash64("doc_id"), "doc_id", "size", *keys)
    placed = (rows.withColumn("within", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
              .alias("r").join(parts.alias("s"), F.expr("r.source <=> s.source and r.bucket = s.bucket"))
              .select(*keys, "doc_id", "r.source", "size", "source_size", "target", "kind",
                      (F.col("part_before") + F.col("within")).alias("at")))
    limit = F.round("target").cast("long")
    starts = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda k: F.col("at") + k * F.col("source_size"))
    taken = F.aggregate(starts, F.lit(0).cast("long"),
                        lambda s, x: s + F.greatest(F.lit(0), F.least(F.col("size"), F.col("limit") - x)))
    half = F.filter(starts, lambda x: 2 * x + F.col("size") <= 2 * F.col("limit"))
    share_done = lambda x: F.when(F.col("target") > 0, F.least(x / F.col("target"), F.lit(1.0))).otherwise(F.lit(0.0))
    return (placed.withColumn("limit", limit)
            .select(*keys, "doc_id", "source", "size", "source_size", "target", taken.alias("taken"),
                    F.transform(half, lambda x: demand_time(share_done(x), F.col("kind"), schedules)).alias("copies"),
                    demand_time(share_done(F.col("at")), F.col("kind"), schedules).alias("position")))


def training_order(mixed: DataFrame, *carried: str) -> DataFrame:
    """``(doc_id, copy, position)`` and the columns ``carried`` for every copy taken, range-sorted by training position."""
    return (mixed.select("doc_id", *carried, F.posexplode("copies").alias("copy", "position"))
            .orderBy("position", "doc_id", "copy"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it whole, in training order.

    Rows are told apart by a key written with them, not by ``doc_id``: null
    and repeated ids are documents like any other.
    """
    keyed = numbered(docs, "mixing-rows")
    mixed = mix_sources(keyed.select("key", "row.doc_id", "row.text", "row.source"), key="key")
    taken = keyed.join(shuffled(mixed.filter(F.size("copies") > 0).select("key", "doc_id", "copies")), "key")
    return training_order(taken, "row").select("row.*")
