"""Hashed n-gram features of texts and the bounded labelled sample that linear classifiers are fitted on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import kernels
from strata.llm.tables import crc_remainder

BITS = 18
SIZE = 1 << BITS
WORD, SYMBOL = 1, 2
# Class of a byte: 0 white space, 1 letters, digits and all non-ASCII bytes, 2 other printable ASCII and controls.
BYTE_CLASS = np.full(256, WORD, dtype=np.uint8)
for _b in range(128):
    BYTE_CLASS[_b] = 0 if kernels.IS_SPACE[_b] else WORD if chr(_b).isalnum() else SYMBOL


def distinct(bucket: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each (row, bucket) pair once, in order."""
    key = (row.astype(np.uint64) << np.uint64(BITS)) | bucket.astype(np.uint64)
    if len(row) and int(row.max()) < 1 << (32 - BITS):
        key = key.astype(np.uint32)
    key.sort()
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    return (key & key.dtype.type(SIZE - 1)).astype(np.int64), (key >> key.dtype.type(BITS)).astype(np.int64)


def char_ngrams(data: np.ndarray, offsets: np.ndarray, sizes=(3, 4, 5), active: np.ndarray | None = None):
    """Distinct ``(bucket, row)`` of the character n-grams of each row.

    Characters are code points, A-Z lower-cased, white space as one kind of
    space; a space stands before and after each text.  ``active`` (by
    bucket) leaves out the n-grams of other buckets before duplicates go.
    """
    folded = kernels.LOWER[data]
    folded[kernels.IS_SPACE[data]] = 32
    codes = np.frombuffer(folded.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    ends = lead[offsets]                      # rows in code points
    rows = len(offsets) - 1
    n = np.diff(ends) + 2
    joined = np.full(int(n.sum()), 32, dtype=np.uint32)
    row = np.repeat(np.arange(rows), n)
    start = np.cumsum(n) - n
    body = np.ones(len(joined), dtype=bool)
    body[start] = body[start + n - 1] = False
    joined[body] = codes
    buckets, owners = [], []
    h = joined.copy()
    for size in range(1, max(sizes) + 1):
        if size > 1:
            h = h[:-1] * np.uint32(0x01000193) + joined[size - 1:] * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(15)
        if size in sizes and len(h):
            b = ((h + np.uint32(size)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
            keep = row[:len(h)] == row[size - 1:]
            if active is not None:
                keep &= active[b]
            buckets.append(b[keep])
            owners.append(row[:len(h)][keep])
        if len(h) < 2:
            break
    if not buckets:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return distinct(np.concatenate(buckets), np.concatenate(owners))


def word_ngrams(data: np.ndarray, offsets: np.ndarray, sizes=(1, 2)):
    """Distinct ``(bucket, row)`` of the word n-grams of each row.

    Tokens are runs of letters and digits, or of other visible characters,
    A-Z lower-cased.  A word that repeats the word before it becomes the
    token "again", so repetition is an n-gram whatever the word.
    """
    none = np.zeros(0, dtype=np.int64)
    if not len(data):
        return none, none
    kind = BYTE_CLASS[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    change = np.empty(len(data), dtype=bool)
    change[0], change[1:] = True, kind[1:] != kind[:-1]
    starts = np.flatnonzero((kind != 0) & (change | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1], after[:-1] = True, change[1:]
    ends = np.flatnonzero((kind != 0) & (after | edge[1:])) + 1
    row = np.searchsorted(offsets, starts, side="right") - 1
    h = kernels.span_hashes(kernels.LOWER[data], starts, ends)
    if not len(h):
        return none, none
    again = np.zeros(len(h), dtype=bool)
    again[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1]) & (kind[starts[1:]] == WORD)
    h[again] = np.uint64(0x5BD1E995)
    buckets, owners = [], []
    gram = h
    for size in range(1, max(sizes) + 1):
        if size > 1:
            gram = kernels.mix(gram[:-1]) + h[size - 1:] * np.uint64(2 * size + 1)
        if size in sizes:
            inside = row[:len(gram)] == row[size - 1:]
            buckets.append(kernels.mix(gram[inside] + np.uint64(size)) >> np.uint64(64 - BITS))
            owners.append(row[:len(gram)][inside])
        if len(gram) < 2:
            break
    return distinct(np.concatenate(buckets), np.concatenate(owners))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, rows: int) -> DataFrame:
    """``(text, y, pick)``: at most ``rows`` labelled documents outside the held-out remainder.

    Rows without a label are left out; an id that is labelled several times
    takes the majority (a tie is 1).  The sample is the ids of smallest
    hash, so every size of input is sampled alike, and it is bounded, so it
    may be broadcast.
    """
    marked = (labels.select(F.col("doc_id"), F.col(label).cast("double").alias("y")).filter("doc_id is not null and y is not null")
              .filter(crc_remainder("doc_id", modulus) != held)
              .groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("double").alias("y"))
              .withColumn("pick", F.xxhash64("doc_id")).orderBy("pick", "doc_id").limit(rows))
    return (docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(marked), "doc_id")
            .select("text", "y", "pick"))
