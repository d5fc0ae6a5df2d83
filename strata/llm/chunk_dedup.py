"""Substring dedup by content-defined chunking.

A gear rolling hash over the last 16 bytes marks boundaries, so the same
passage is cut at the same places wherever it stands and an insertion moves
no boundary beyond its neighbourhood.  Boundaries depend on nearby bytes
alone (a mark counts if no other mark stands within ``LEAST`` bytes before
it; stretches without one are cut every ``MOST`` bytes).  Chunks are compared
by digest over all documents; neighbouring repeated chunks form passages,
and passages of ``PASSAGE`` bytes or more are reported.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strata.llm import kernels
from strata.llm.tables import stored

WINDOW = 16       # bytes that the gear hash remembers: its bits
MARK_BITS = 4     # a mark every 2**4 bytes on average
LEAST, MOST = 16, 256
PASSAGE = 96      # least bytes of a reported passage: whole chunks inside a repeat of some 50 words

_GEAR = np.random.default_rng(977).integers(0, 2**WINDOW, 256, dtype=np.uint16)
CHUNK_SCHEMA = "doc_id long, row long, begin long, end long, digest long, other long, first boolean"


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash ending at each byte: sum of table entries, shifted left once per byte of age."""
    h = _GEAR[data]
    step = 1
    while step < WINDOW:
        h[step:] = h[step:] + (h[:-step] << np.uint16(step))
        step *= 2
    return h


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ends of all chunks of the rows in a buffer, in order; rows end a chunk."""
    mark = (gear(data) >> np.uint16(WINDOW - MARK_BITS)) == 0
    at = np.flatnonzero(mark) + 1
    row = np.searchsorted(offsets, at - 1, side="right") - 1
    at = at[at - offsets[row] >= WINDOW]                          # the hash saw this row alone
    at = at[np.concatenate([[True], np.diff(at) > LEAST])] if len(at) else at
    ends = np.union1d(at, offsets[1:][np.diff(offsets) > 0])
    begins = np.concatenate([[0], ends[:-1]])
    extra = (ends - begins - 1) // MOST
    if extra.any():
        long = np.flatnonzero(extra)
        more = np.concatenate([begins[i] + MOST * np.arange(1, extra[i] + 1) for i in long])
        ends = np.union1d(ends, more)
    return ends


def first_in_row(row: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """Marks the first chunk of each digest in each row."""
    order = np.lexsort((digest, row))      # stable: the first comes first
    first = np.ones(len(row), dtype=bool)
    first[order[1:]] = (np.diff(row[order]) != 0) | (np.diff(digest[order]) != 0)
    return first


def chunk_batches(batches):
    for batch in batches:
        ids, rows = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "row"))
        for at, data, offsets in kernels.slices(batch.column("text")):
            if not len(data):
                continue
            ends = chunk_ends(data, offsets)
            begins = np.concatenate([[0], ends[:-1]])
            row = np.searchsorted(offsets, begins, side="right") - 1
            digest = kernels.span_hashes(data, begins, ends)
            other = kernels.span_hashes(data, begins, ends, kernels.SECOND_CODE)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[at + row]), pa.array(rows[at + row]), pa.array(begins - offsets[row]), pa.array(ends - offsets[row]),
                 pa.array(digest.view(np.int64)), pa.array(other.view(np.int64)), pa.array(first_in_row(row, digest))],
                names=["doc_id", "row", "begin", "end", "digest", "other", "first"])


def row_hash(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(doc_id).cast("long"), F.col(text))


def chunks(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, row, begin, end, digest, other, first`` of every chunk, in bytes of the UTF-8 text.

    ``row`` tells texts that share an id apart, ``digest`` and ``other`` are 128 bits
    of the chunk, ``first`` marks its first occurrence in the text.
    """
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_hash(doc_id, text).alias("row"), F.col(text).alias("text"))
    return named.filter("doc_id is not null and text != ''").mapInArrow(chunk_batches, CHUNK_SCHEMA)


def repeated_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", passage: int = PASSAGE) -> DataFrame:
    """Passages that several documents share: ``doc_id, row, begin, end, n_bytes, first_doc_id, n_docs, kept``.

    ``begin`` and ``end`` are byte offsets.  The chunks of a passage stay in
    the document of smallest id (``kept``) and are repeats in all others.
    ``n_docs`` counts the texts that hold the chunk, each once.  Rows equal in
    id and text are one document; different texts under an id are told apart, but
    do not repeat each other.  Repeats within a document do not count.  Rows without an id, null and empty texts have no passages.
    """
    cut = stored(chunks(docs, text, doc_id), "chunks")
    # Counted per digest with map-side combining, then joined back: a chunk found in a
    # third of all documents is one row here, and the join splits it if need be.
    shared = (cut.groupBy("digest", "other").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last"),
                                                 F.count(F.when(F.col("first"), 1)).alias("n_docs"))
              .filter("first_doc_id < last").drop("last"))
    repeats = (cut.select("doc_id", "row", "begin", "end", "digest", "other").join(shared, ["digest", "other"])
               .withColumn("kept", F.col("doc_id") == F.col("first_doc_id")))
    by_doc = Window.partitionBy("doc_id", "row").orderBy("begin")
    before = by_doc.rowsBetween(Window.unboundedPreceding, -1)
    breaks = (F.col("begin") > F.coalesce(F.max("end").over(before), F.lit(-1))) | (F.col("kept") != F.lag("kept").over(by_doc))
    return (repeats.withColumn("run", F.sum(F.coalesce(breaks, F.lit(True)).cast("int")).over(by_doc))
            .groupBy("doc_id", "row", "run", "kept").agg(
                F.min("begin").alias("begin"), F.max("end").alias("end"),
                F.min("first_doc_id").alias("first_doc_id"), F.max("n_docs").alias("n_docs"))
            .withColumn("n_bytes", F.col("end") - F.col("begin")).filter(F.col("n_bytes") >= passage)
            .select("doc_id", "row", "begin", "end", "n_bytes", "first_doc_id", "n_docs", "kept"))


def cut_spans(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for t, s in zip(texts.to_pylist(), spans.to_pylist()):
        if t is None or not s:
            out.append(t)
            continue
        body, at, parts = t.encode(), 0, []
        for x in sorted(s, key=lambda x: x["begin"]):
            parts.append(body[at:max(at, x["begin"])])
            at = max(at, x["end"])
        parts.append(body[at:])
        out.append(b"".join(parts).decode("utf-8", "ignore"))   # a span may cut a character in two
    return pa.array(out, pa.string())


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", passage: int = PASSAGE) -> DataFrame:
    """``docs`` without the repeated passages, each of which stays in one document."""
    spans = (repeated_passages(docs, text, doc_id, passage).filter("not kept")
             .groupBy(F.col("doc_id").alias("__id"), F.col("row").alias("__row")).agg(F.collect_list(F.struct("begin", "end")).alias("__spans")))   # bounded by the text
    cleaned = F.arrow_udf(cut_spans, T.StringType())
    here = (F.col(doc_id).cast("long") == F.col("__id")) & (row_hash(doc_id, text) == F.col("__row"))
    return docs.join(spans, here, "left").withColumn(text, cleaned(F.col(text), F.col("__spans"))).select(docs.columns)
