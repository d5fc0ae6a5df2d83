"""Vectorised byte and word kernels used inside Arrow tasks.

A batch of texts is one UTF-8 byte buffer plus row offsets.  Words, shingles
and n-grams are found and hashed for the whole buffer at once; buffers are
cut between rows so that a task holds a few megabytes of intermediate
arrays, whatever the batch size (one very long text is its own slice).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

# White space between words, space and the ASCII controls tab to carriage return.
SPACE_BYTES = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[SPACE_BYTES] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240229)
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SECOND_CODE = np.random.default_rng(71).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, step in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(size, step, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES):
    """``(first row, bytes, offsets)`` of runs of rows of at most ``limit`` bytes, one row at least."""
    if not len(texts):
        return
    data, offsets = utf8(texts)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = IS_SPACE):
    """First byte, end byte and row of every word."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    gap = space[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[0], before[1:] = True, gap[:-1]
    starts = np.flatnonzero(~gap & (before | edge[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1], after[:-1] = True, gap[1:]
    ends = np.flatnonzero(~gap & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def prefix_sums(data: np.ndarray, code: np.ndarray = _BYTE_CODE) -> np.ndarray:
    """Sums of the bytes' codes, weighted by their place; a span's hash is the difference of two."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(code[data] * up[:len(data)], out=sums[1:])
    return sums


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, code: np.ndarray = _BYTE_CODE,
                sums: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, wherever it stands in the buffer; another ``code`` gives another hash.
    ``sums`` are the buffer's ``prefix_sums`` where they are known."""
    _, down = powers(len(data) + 1)
    sums = prefix_sums(data, code) if sums is None else sums
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(word_hash: np.ndarray, row: np.ndarray, rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words and, for each row, where its
    shingles end.  A row of fewer words, but not none, has one shingle: all of its words."""
    n = np.bincount(row, minlength=rows)
    last = np.cumsum(n)
    out, out_row = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    if len(word_hash) >= size:
        h = word_hash[:len(word_hash) - size + 1].copy()
        for k in range(1, size):
            h = mix(h) + word_hash[k:len(word_hash) - size + 1 + k] * np.uint64(2 * k + 1)
        whole = row[:len(h)] == row[size - 1:]
        out, out_row = mix(h[whole]), row[:len(h)][whole]
    short = np.flatnonzero((n > 0) & (n < size))
    if len(short):
        one = np.array([int(mix(np.array([hash_list(word_hash[last[r] - n[r]:last[r]])], dtype=np.uint64))[0])
                        for r in short], dtype=np.uint64)
        order = np.argsort(np.concatenate([out_row, short]), kind="stable")
        out, out_row = np.concatenate([out, one])[order], np.concatenate([out_row, short])[order]
    return out, np.searchsorted(out_row, np.arange(rows), side="right")


def hash_list(hashes: np.ndarray) -> int:
    x = len(hashes) * 0x632BE59BD9B4E019 % 2**64
    for h in hashes:
        x = (x * 0xD6E8FEB86659FD93 + int(h)) % 2**64
        x ^= x >> 29
    return x


def per_row_sum(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive values; row ``i`` ends at ``ends[i]``."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends] - total[np.concatenate([[0], ends[:-1]])] if len(ends) else total[:0]
