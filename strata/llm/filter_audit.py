"""Filter interaction audit on a sparse document-term matrix.

1. Every task splits its texts into words and encodes them with a dictionary
   of its shard (at most ``SHARD_BYTES`` of text, or one longer text): rows
   of (row, word number, count) in CSR form, in blocks of a few megabytes.
2. The shard dictionaries are joined into one: each distinct word of the
   corpus gets one dense number.  Only the distinct words of a shard travel,
   never the words of a document, so a word of every document is one row a shard.
3. The blocks' columns are translated to the global numbers: CSR shards.
4. Row sums (words) and nonzero counts (distinct words) decide filters A and
   B; C and D were decided on the bytes in step 1, E by equal text digests.
5. Documents are counted by (part, set of failed filters, labels): at most 128
   rows a part, from which all 120 orders of the five filters follow.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.llm import kernels
from strata.llm.tables import BLOCKS_PER_FILE, stored

SHARD_BYTES = 32 << 20   # text under one dictionary
BLOCK_BYTES = 2 << 20    # text of a block of rows

# The filters in their bit order, and their thresholds.
FILTERS = "ABCDE"
LEAST_WORDS = 200        # A: fewer words
DISTINCT_PERCENT = 50    # B: distinct words below this share of the words
CAPITAL_PERCENT = 3      # C: capitals above this share of the code points
SYMBOLS = b"#$%&*|"      # D: any of these
ORDERS = ["".join(p) for p in permutations(FILTERS)]

BIT = {f: 1 << i for i, f in enumerate(FILTERS)}
IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
IS_CAPITAL = (np.arange(256) >= 65) & (np.arange(256) <= 90)
IS_FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80   # of a code point

BLOCK_SCHEMA = T.StructType(
    [T.StructField("shard", T.LongType()), T.StructField("doc", T.ArrayType(T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("part", T.StringType()),
        T.StructField("digest", T.BinaryType()), T.StructField("failed", T.IntegerType())]))),
     T.StructField("row_end", T.ArrayType(T.IntegerType())), T.StructField("column", T.ArrayType(T.IntegerType())),
     T.StructField("n", T.ArrayType(T.IntegerType())), T.StructField("words", T.ArrayType(T.StringType()))])
CSR_SCHEMA = T.StructType(BLOCK_SCHEMA.fields[:3] + [T.StructField("word_id", T.ArrayType(T.LongType())), BLOCK_SCHEMA["n"]])
ENTRY_SCHEMA = "shard long, local int, word_part int, word_no long"
FLAG_SCHEMA = "doc_id long, part string, digest binary, n_words long, n_distinct long, failed int"


def byte_flags(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of C and D for each row of a buffer."""
    ends = offsets[1:]
    capitals = kernels.per_row_sum(IS_CAPITAL[data], ends)
    points = kernels.per_row_sum(IS_FIRST_BYTE[data], ends)
    symbols = kernels.per_row_sum(IS_SYMBOL[data], ends)
    return ((100 * capitals > CAPITAL_PERCENT * points) * BIT["C"] + (symbols > 0) * BIT["D"]).astype(np.int32)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and the row of each."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    some = pc.greater(pc.binary_length(flat), 0)   # white space at the ends leaves empty pieces
    if not pc.all(some).as_py():
        flat, row = flat.filter(some), row[some.to_numpy(zero_copy_only=False)]
    return flat, row


def list_of(values: np.ndarray, kind) -> pa.Array:
    """One list with all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


class Shard:
    """Blocks of rows under one dictionary.  A block is encoded by itself when it comes, so that no text is kept;
    the blocks' dictionaries are made one when the shard ends."""

    def __init__(self, number: int):
        self.number, self.size, self.blocks = number, 0, []

    def add(self, batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> None:
        flat, row = split_words(batch.column("text"))
        names = ["doc_id", "part", "digest"]
        docs = pa.StructArray.from_arrays([*(batch.column(c) for c in names), pa.array(byte_flags(data, offsets))],
                                          names=[*names, "failed"])
        encoded = flat.dictionary_encode()
        words, column = encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False)
        cell = np.sort(row * max(len(words), 1) + column)
        first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, np.int64)
        count = np.diff(np.append(first, len(cell)))
        row, column = np.divmod(cell[first], max(len(words), 1))
        self.blocks.append((docs, words, np.searchsorted(row, np.arange(len(docs)), side="right").astype(np.int32),
                            column.astype(np.int32), count.astype(np.int32)))
        self.size += len(data)

    def batches(self):
        encoded = pa.concat_arrays([b[1] for b in self.blocks]).dictionary_encode()
        words, column_of, at = encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False), 0
        for i, (docs, own, row_end, column, count) in enumerate(self.blocks):
            yield pa.RecordBatch.from_arrays(
                [pa.array([self.number]), pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
                 list_of(row_end, pa.int32()), list_of(column_of[at:at + len(own)][column], pa.int32()), list_of(count, pa.int32()),
                 # The dictionary stands in the shard's first block.
                 pa.ListArray.from_arrays(pa.array([0, len(words) if not i else 0], pa.int32()), words if not i else words[:0])],
                names=BLOCK_SCHEMA.names)
            at += len(own)


def shard_batches(batches):
    from pyspark import TaskContext
    task, made = TaskContext.get().partitionId() << 32, 0
    shard = Shard(task)
    for batch in batches:
        for at, data, offsets in kernels.slices(batch.column("text"), BLOCK_BYTES):
            if shard.blocks and shard.size + len(data) > SHARD_BYTES:
                yield from shard.batches()
                made += 1
                shard = Shard(task + made)
            shard.add(batch.slice(at, len(offsets) - 1), data, offsets)
    if shard.blocks:
        yield from shard.batches()


def numbered_words(batches):
    """Entries sorted by word: the words of a task get 0, 1, ... in order; equal words get the same number."""
    from pyspark import TaskContext
    part, last, no = TaskContext.get().partitionId(), None, -1
    for batch in batches:
        words = batch.column("word")
        if not len(words):
            continue
        new = np.ones(len(words), dtype=bool)
        new[1:] = pc.not_equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False)
        new[0] = words[0].as_py() != last
        number = no + np.cumsum(new)
        last, no = words[-1].as_py(), int(number[-1])
        yield pa.RecordBatch.from_arrays(
            [batch.column("shard"), batch.column("local"), pa.array(np.full(len(words), part, dtype=np.int32)),
             pa.array(number)], names=["shard", "local", "word_part", "word_no"])


def translated(blocks: pa.Table, entries: pa.Table) -> pa.Table:
    """The blocks of one shard with global word numbers."""
    ids = np.zeros(len(entries), dtype=np.int64)
    ids[entries["local"].to_numpy()] = entries["word_id"].to_numpy()
    out = []
    for i in range(len(blocks)):
        one = blocks.slice(i, 1)
        column = one["column"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        out.append(pa.Table.from_arrays(
            [one["shard"], one["doc"], one["row_end"], list_of(ids[column], pa.int64()), one["n"]], names=CSR_SCHEMA.names))
    return pa.concat_tables(out)


def term_matrix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "lang") -> DataFrame:
    """CSR shards of the document-term matrix, some megabytes of text a row.

    ``doc`` lists the rows (id, part, text digest, failed byte filters);
    row ``i`` owns the entries from ``row_end[i-1]`` to ``row_end[i]`` of
    ``word_id`` (dense numbers of all words of the corpus, from 0) and ``n``.
    """
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    blocks = stored(named.withColumn("digest", F.unhex(F.sha2("text", 256))).mapInArrow(shard_batches, BLOCK_SCHEMA), "term-blocks", BLOCKS_PER_FILE)
    words = blocks.select("shard", F.posexplode("words").alias("local", "word"))
    # One exchange: the rows of a word (one a shard) meet, and sorting numbers them.
    entries = stored(words.repartition("word").sortWithinPartitions("word").mapInArrow(numbered_words, ENTRY_SCHEMA), "term-entries")
    sizes = entries.groupBy("word_part").agg((F.max("word_no") + 1).alias("size"))   # a row for each shuffle partition
    before = Window.orderBy("word_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("word_part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    ids = entries.join(F.broadcast(starts), "word_part").select("shard", "local", (F.col("start") + F.col("word_no")).alias("word_id"))
    return (blocks.drop("words").groupBy("shard").cogroup(ids.groupBy("shard")).applyInArrow(translated, CSR_SCHEMA))


def row_flags(batches):
    """Row sums and nonzero counts of CSR shards, with the filters they decide."""
    for batch in batches:
        for i in range(len(batch)):
            docs = batch.column("doc")[i].values
            ends = batch.column("row_end")[i].values.to_numpy(zero_copy_only=False).astype(np.int64)
            n_words = kernels.per_row_sum(batch.column("n")[i].values.to_numpy(zero_copy_only=False), ends)
            n_distinct = np.diff(ends, prepend=0)
            failed = docs.field("failed").to_numpy(zero_copy_only=False)
            failed = (failed + (n_words < LEAST_WORDS) * BIT["A"]
                      + (100 * n_distinct < DISTINCT_PERCENT * n_words) * BIT["B"]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [docs.field("doc_id"), docs.field("part"), docs.field("digest"), pa.array(n_words), pa.array(n_distinct),
                 pa.array(failed)], names=["doc_id", "part", "digest", "n_words", "n_distinct", "failed"])


def failed_filters(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "lang") -> DataFrame:
    """``doc_id, part, digest, n_words, n_distinct, failed`` of every row; ``failed`` is the bit set of the filters it fails."""
    rows = stored(term_matrix(docs, text, doc_id, part).mapInArrow(row_flags, FLAG_SCHEMA), "filter-flags")
    # Only texts that several rows hold come back to the rows; the join can split a hot text.
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).filter("first_id < last_id")
    copy = F.coalesce(F.col("first_id") < F.col("doc_id"), F.lit(False))
    return (rows.join(first.drop("last_id"), "digest", "left")
            .select("doc_id", "part", "digest", "n_words", "n_distinct", (F.col("failed") + copy.cast("int") * BIT["E"]).alias("failed")))


def bit_of(letter: Column) -> Column:
    return F.get(F.array(*[F.lit(b) for b in BIT.values()]), F.instr(F.lit(FILTERS), letter) - 1)


def audit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "lang") -> DataFrame:
    """Effect of the five filters in all 120 orders, by ``part``.

    One row per part, ``filter_order`` and ``step``: documents ``kept`` after
    the step, ``removed`` by it, ``redundant`` (failing it, removed before),
    ``unique_fails`` (failing it alone), ``good_lost`` and ``toxic_lost``
    (removed here with that label) and ``shapley`` (its removed over all orders).

    Null text is empty (fails A and, if another empty text has a smaller
    id, E).  Null ``lang`` is the empty part.  A row without an id is no copy
    and makes none; rows that repeat an id are all counted, and equal texts
    under one id are no copies of each other.  A label given several times
    counts if it is 1 once.  An empty table has no parts and no rows.
    """
    marks = (labels.filter(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).cast("long").alias("doc_id"))
             .agg(F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
                  F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic")))
    flags = failed_filters(docs, text, doc_id, part).select("doc_id", "part", "failed")
    counts = (flags.join(marks, "doc_id", "left")
              .groupBy("part", "failed", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
              .agg(F.count("*").alias("docs")))
    wide = counts.select("*", F.explode(F.array(*[F.lit(o) for o in ORDERS])).alias("filter_order"))
    wide = wide.select("*", F.posexplode(F.split("filter_order", "(?<=.)(?=.)")).alias("earlier", "filter"))
    own = bit_of(F.col("filter"))
    wide = wide.select("*", (F.col("earlier") + 1).alias("step"), own.alias("own"),
                       F.aggregate(F.slice(F.split("filter_order", "(?<=.)(?=.)"), F.lit(1), F.col("earlier")), F.lit(0),
                                   lambda got, f: got + bit_of(f)).alias("before"))
    fails, gone = F.col("failed").bitwiseAND(F.col("own")) != 0, F.col("failed").bitwiseAND(F.col("before")) != 0
    removed = fails & ~gone
    total = lambda what: F.sum(F.when(what, F.col("docs")).otherwise(0)).cast("long")
    # Of the orders, 1 / (number of failed filters) meet this filter before the document's others.
    share = F.lit(len(ORDERS)) / F.greatest(F.bit_count("failed"), F.lit(1))
    return wide.groupBy("part", "filter_order", F.col("step").cast("int").alias("step")).agg(
        total(~gone & ~fails).alias("kept"), total(removed).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("failed") == F.col("own")).alias("unique_fails"),
        total(removed & (F.col("good") == 1)).alias("good_lost"), total(removed & (F.col("toxic") == 1)).alias("toxic_lost"),
        F.sum(F.when(fails, F.col("docs") * share.cast("long")).otherwise(0)).cast("long").alias("shapley"))
