"""Repeated substrings: a Burrows-Wheeler order built column by column over a collection of segments.

Every string of ``MATCH`` bytes (a window) has an anchor: the ``GRAM`` bytes
inside it of least hash.  Windows in a row that share their anchor are one
segment; equal windows have equal anchors at equal places, so all that can be
equal meets under one anchor.

1. Segments of all texts are dealt out by anchor (three hashes and a place, no
   bytes).  Of segments with the same bytes the first in the corpus stays, and
   the others repeat it whole.  Each task does so for its own texts first.
2. What is left under an anchor are different segments; only anchors with two
   or more go on.  Their bytes are cut from the texts and stand in a table, one
   row a segment, its columns aligned at the anchor.
3. From the last column to the first, each round inserts one symbol of every
   segment: a stable distribution of the current order by that symbol is the
   order of the suffixes one symbol longer, and the common prefix of neighbours
   is one more than the least common prefix between their old places.  Order
   and prefixes are read and written in sequence, one file (array) each.
   Neighbours with a common prefix of ``MATCH`` start equal windows; all but
   the first in the corpus are marked.

As equal windows can only start in the same column, suffixes of different
columns need no common order, and a round passes over one suffix of each
segment instead of all suffixes so far.  An anchor with more than ``TABLE``
different segments is decided window by window in Spark (128-bit hashes, minimum, join).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import kernels
from strata.llm.tables import stored

MATCH = 100                 # bytes of a repeated string
GRAM = 32                   # bytes of an anchor
REACH = MATCH - GRAM        # most bytes of a window before its anchor
COLUMNS = REACH + MATCH     # of the table: bytes from REACH before the anchor on
PAD = 0xFF                  # no byte of UTF-8
TABLE = 1 << 15             # segments in a table
PIECE = 1 << 20             # bytes of a text looked at together
BROADCAST_KEYS = 1_000_000  # keys of 16 bytes
NO_ID = 2**63 - 1           # place of rows without an id: after all others

_OTHER_CODE = np.random.default_rng(71).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACE_BITS = 21

SEGMENT_SCHEMA = "span boolean, anchor long, digest long, extra long, ord long, tie long, at long"
FOUND_SCHEMA = "span boolean, anchor long, ord long, tie long, at long, r_most int, r_least int, end long"
CUT_SCHEMA = "anchor long, ord long, tie long, at long, r_most int, r_least int, bytes binary"
COMPARED_SCHEMA = "h1 long, h2 long, ord long, tie long, begin long, end long"


# --- segments ---------------------------------------------------------------------

def prefix_sums(data: np.ndarray, codes: np.ndarray) -> np.ndarray:
    up, _ = kernels.powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(codes[data] * up[:len(data)], out=sums[1:])
    return sums


def spans_hash(sums: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = kernels.powers(len(sums))
    return kernels.mix((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(np.uint64))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` values in a row."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[:len(values) - (width - have)], values[width - have:]) if have < width else values


def segments(data: np.ndarray, offsets: np.ndarray):
    """``first, last, at, anchor, digest, other`` of the segments of a buffer of rows:
    their first and last window, the place of the anchor, and hashes of anchor and bytes."""
    room = np.diff(offsets) - MATCH + 1
    if len(data) < MATCH or not (room > 0).any():
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, *[none.astype(np.uint64)] * 3
    sums, other = prefix_sums(data, kernels._BYTE_CODE), prefix_sums(data, _OTHER_CODE)
    places = np.arange(len(data) - GRAM + 1)
    grams = spans_hash(sums, places, places + GRAM)
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = sliding_least((grams & ~low) | places.astype(np.uint64), REACH + 1)   # of equal grams the first
    rows = np.flatnonzero(room > 0)
    ends = np.cumsum(room[rows])
    start = np.repeat(offsets[rows] - (ends - room[rows]), room[rows]) + np.arange(ends[-1])
    at = (least[start] & low).astype(np.int64)
    new = np.concatenate([[True], (np.diff(start) != 1) | (np.diff(at) != 0)])
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(start)) - 1
    first, last, at = start[begin], start[last], at[begin]
    return first, last, at, grams[at], spans_hash(sums, first, last + MATCH), spans_hash(other, first, last + MATCH)


def pieces(texts: pa.Array):
    """``(first row, bytes, offsets, place in the text)``; a long text comes in pieces that overlap by a window less one byte."""
    for row, data, offsets in kernels.slices(texts, PIECE):
        if len(offsets) > 2 or len(data) <= PIECE + MATCH:
            yield row, data, offsets, 0
            continue
        for begin in range(0, len(data) - MATCH + 1, PIECE):
            part = data[begin:begin + PIECE + MATCH - 1]
            yield row, part, np.array([0, len(part)]), begin


def merged_spans(key: np.ndarray, begin: np.ndarray, end: np.ndarray):
    """Overlapping and touching spans of the same key made one."""
    order = np.lexsort((begin, key))
    key, begin, end = key[order], begin[order], end[order]
    if not len(key):
        return key, begin, end
    base = np.int64(end.max() + 2)
    reach = np.maximum.accumulate(end + (np.cumsum(np.diff(key, prepend=key[0]) != 0)) * base)
    shifted = begin + (np.cumsum(np.diff(key, prepend=key[0]) != 0)) * base
    new = np.concatenate([[True], shifted[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    return key[at], begin[at], np.maximum.reduceat(end, at)


def segment_batches(batches):
    """Segments of all texts; those that repeat one of the same piece come as spans."""
    for batch in batches:
        ids = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("ord", "tie")]
        for row0, data, offsets, shift in pieces(batch.column("text")):
            first, last, at, anchor, digest, other = segments(data, offsets)
            if not len(at):
                continue
            inside = np.searchsorted(offsets, first, side="right") - 1
            owner, base = row0 + inside, offsets[inside]
            place = at - base + shift
            extra = (other >> np.uint64(14) << np.uint64(14)) | ((at - first) << 7 | (at - last)).astype(np.uint64)
            rank = np.empty(len(offsets) - 1, dtype=np.int64)
            rank[np.lexsort([c[row0:row0 + len(rank)] for c in ids[::-1]])] = np.arange(len(rank))
            order = np.lexsort((place, rank[inside], extra, digest))
            same = (np.diff(digest[order]) == 0) & (np.diff(extra[order]) == 0)
            kept, again = order[np.concatenate([[True], ~same])], order[1:][same]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(kept), dtype=bool)), *(pa.array(x[kept].view(np.int64)) for x in (anchor, digest, extra)),
                 *(pa.array(c[owner[kept]]) for c in ids), pa.array(place[kept])], names=[c.split()[0] for c in SEGMENT_SCHEMA.split(", ")])
            if len(again):
                key, begin, end = merged_spans(owner[again], (first - base)[again] + shift, (last - base)[again] + shift + MATCH)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ones(len(key), dtype=bool)), pa.array(kernels.mix(key.astype(np.uint64) + begin.astype(np.uint64)).view(np.int64)),
                     pa.array(np.zeros(len(key), dtype=np.int64)), pa.array(end), *(pa.array(c[key]) for c in ids), pa.array(begin)],
                    names=[c.split()[0] for c in SEGMENT_SCHEMA.split(", ")])


def found_batch(span, anchor, ord_, tie, at, extra, end) -> pa.RecordBatch:
    reach = (extra & 0x3FFF).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (span, anchor, ord_, tie, at, reach >> 7, reach & 0x7F, end)],
                                      names=[c.split()[0] for c in FOUND_SCHEMA.split(", ")])


def meeting_batches(batches):
    """Sorted segments: spans that repeat an earlier segment, and the different segments of anchors that have two or more.

    A stream: between batches it remembers the last segment, how many
    different ones its anchor has had, and the first of them while it is alone.
    """
    names = ["anchor", "digest", "extra", "ord", "tie", "at"]
    last, had, alone = None, 0, None
    for batch in batches:
        span = batch.column("span").to_numpy(zero_copy_only=False)
        rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
        if span.any():
            _, _, end, *who, begin = (x[span] for x in rows)
            yield found_batch(np.ones(len(end), dtype=bool), np.zeros(len(end), dtype=np.int64), *who, begin, np.zeros(len(end), dtype=np.int64), end)
            rows = [x[~span] for x in rows]
        anchor, digest, extra, ord_, tie, at = rows
        if not len(anchor):
            continue
        new_anchor = np.concatenate([[last is None or anchor[0] != last[0]], np.diff(anchor) != 0])
        new = new_anchor | np.concatenate([[last is None or (digest[0], extra[0]) != last[1:]], (np.diff(digest) != 0) | (np.diff(extra) != 0)])
        last = (anchor[-1], digest[-1], extra[-1])
        again = ~new
        if again.any():
            reach = extra[again] & 0x3FFF
            begin = at[again] - (reach >> 7)
            yield found_batch(np.ones(len(begin), dtype=bool), np.zeros(len(begin), dtype=np.int64), ord_[again], tie[again], begin,
                              np.zeros(len(begin), dtype=np.int64), at[again] - (reach & 0x7F) + MATCH)
        firsts = np.flatnonzero(new)
        goes = np.zeros(0, dtype=np.int64)
        if len(firsts):
            run = np.cumsum(new_anchor)[firsts]      # 0: the anchor of the batch before
            sizes = np.bincount(run)
            total = sizes.copy()
            total[0] += had if run[0] == 0 else 0
            if run[0] == 0 and alone is not None:    # it is alone no longer
                yield alone
                alone = None
            goes = firsts[total[run] > 1]
        if new_anchor.any():
            alone = None
            had = int(sizes[run[-1]]) if run[-1] else had
            if had == 1:
                i = firsts[-1:]
                alone = found_batch(np.zeros(1, dtype=bool), anchor[i], ord_[i], tie[i], at[i], extra[i], np.zeros(1, dtype=np.int64))
        else:
            had += len(firsts)
        if len(goes):
            yield found_batch(np.zeros(len(goes), dtype=bool), anchor[goes], ord_[goes], tie[goes], at[goes], extra[goes],
                              np.zeros(len(goes), dtype=np.int64))


# --- the table --------------------------------------------------------------------

def cut_batches(batches):
    """The bytes of the listed segments of each text."""
    for batch in batches:
        for row, wanted in enumerate(batch.column("wanted")):
            body = batch.column("text")[row].as_buffer()
            items = wanted.values
            at = items.field("at").to_numpy(zero_copy_only=False)
            most, least = (items.field(c).to_numpy(zero_copy_only=False) for c in ("r_most", "r_least"))
            for i in range(0, len(items), TABLE):
                part = slice(i, i + TABLE)
                cut = [body.slice(int(a), int(b - a)).to_pybytes() for a, b in zip(at[part] - most[part], at[part] - least[part] + MATCH)]
                n = len(cut)
                yield pa.RecordBatch.from_arrays(
                    [items.field("anchor").slice(i, n), *(pa.array(np.full(n, batch.column(c)[row].as_py())) for c in ("ord", "tie")),
                     items.field("at").slice(i, n), items.field("r_most").slice(i, n), items.field("r_least").slice(i, n),
                     pa.array(cut, pa.binary())], names=[c.split()[0] for c in CUT_SCHEMA.split(", ")])


def aligned(table: pa.Table) -> np.ndarray:
    """Bytes of the segments, one row each; column ``REACH`` is the anchor's first."""
    data = table["bytes"].combine_chunks()
    if isinstance(data, pa.ChunkedArray):
        data = data.chunk(0)
    _, offsets, buffer = data.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int32)[data.offset:data.offset + len(data) + 1].astype(np.int64)
    row = np.repeat(np.arange(len(data)), np.diff(offsets))
    column = np.arange(offsets[0], offsets[-1]) - offsets[row] + REACH - table["r_most"].to_numpy()[row]
    out = np.full((COLUMNS, len(data)), PAD, dtype=np.uint8)   # column by column
    out[column, row] = np.frombuffer(buffer, dtype=np.uint8)[offsets[0]:offsets[-1]]
    return out


def least_between(prefix: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least of ``prefix[left..right]`` for many ranges (tables of powers of two)."""
    tables, width = [prefix], 1
    longest = int((right - left).max(initial=0)) + 1
    while 2 * width <= longest:
        tables.append(np.minimum(tables[-1][:-width], tables[-1][width:]))
        width *= 2
    level = np.frexp((right - left + 1).astype(np.float64))[1] - 1
    out = np.empty(len(left), dtype=prefix.dtype)
    for k in range(level.max(initial=-1) + 1):
        i = np.flatnonzero(level == k)
        out[i] = np.minimum(tables[k][left[i]], tables[k][right[i] - (1 << k) + 1])
    return out


def repeated_windows(columns: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """``marked[row, r]``: the window that starts ``r`` bytes before the anchor is equal to one of a row of lower rank."""
    rows = columns.shape[1]
    order, prefix = np.arange(rows), np.zeros(rows, dtype=np.uint8)
    marked = np.zeros((rows, REACH + 1), dtype=bool)
    for column in range(COLUMNS - 1, -1, -1):
        symbol = columns[column, order]
        moved = np.argsort(symbol, kind="stable")              # old places in the new order
        symbol, order = symbol[moved], order[moved]
        longer = np.flatnonzero((symbol[1:] == symbol[:-1]) & (symbol[1:] != PAD))
        common = np.zeros(rows, dtype=np.uint8)
        common[longer + 1] = np.minimum(least_between(prefix, moved[longer] + 1, moved[longer + 1]), MATCH - 1) + 1
        prefix = common
        if column <= REACH and (prefix >= MATCH).any():
            start = np.flatnonzero(prefix < MATCH)
            size = np.diff(np.append(start, rows))
            first = np.repeat(np.minimum.reduceat(rank[order], start), size)
            marked[order[rank[order] != first], REACH - column] = True
    return marked


def compared_batch(h1, h2, ord_, tie, begin, end) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([h1, h2, *(pa.array(x) for x in (ord_, tie, begin, end))],
                                      names=[c.split()[0] for c in COMPARED_SCHEMA.split(", ")])


def table_spans(table: pa.Table) -> pa.RecordBatch:
    ord_, tie, at = (table[c].to_numpy() for c in ("ord", "tie", "at"))
    rank = np.empty(len(at), dtype=np.int64)
    rank[np.lexsort((at, tie, ord_))] = np.arange(len(at))
    marked = np.pad(repeated_windows(aligned(table), rank), ((0, 0), (1, 1)))
    row, low = np.nonzero(marked[:, 1:-1] & ~marked[:, :-2])
    _, high = np.nonzero(marked[:, 1:-1] & ~marked[:, 2:])
    none = pa.nulls(len(row), pa.int64())
    return compared_batch(none, none, ord_[row], tie[row], at[row] - high, at[row] - low + MATCH)


def single_windows(table: pa.Table):
    """Every window of the segments by two hashes, some segments at a time."""
    for i in range(0, len(table), 1 << 12):
        part = table.slice(i, 1 << 12)
        data = aligned(part).T.reshape(-1)
        least, most = part["r_least"].to_numpy().astype(np.int64), part["r_most"].to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(part)), most - least + 1)
        r = np.arange(len(row)) - np.repeat(np.cumsum(most - least + 1) - (most - least + 1), most - least + 1) + least[row]
        begin = row * COLUMNS + REACH - r
        h1, h2 = (spans_hash(prefix_sums(data, codes), begin, begin + MATCH).view(np.int64) for codes in (kernels._BYTE_CODE, _OTHER_CODE))
        ord_, tie, at = (part[c].to_numpy()[row] for c in ("ord", "tie", "at"))
        yield compared_batch(pa.array(h1), pa.array(h2), ord_, tie, at - r, at - r + MATCH)


def comparing_batches(most: int):
    def run(batches):
        held, wide = None, None
        for batch in batches:
            more = pa.Table.from_batches([batch])
            if wide is not None:
                end = int(np.searchsorted(more["anchor"].to_numpy(), wide, side="right"))   # sorted by anchor
                yield from single_windows(more.slice(0, end))
                more, wide = more.slice(end), wide if end == len(more) else None
            held = more if held is None else pa.concat_tables([held, more])
            if len(held) < most:
                continue
            anchors = held["anchor"].to_numpy()
            start = int(np.searchsorted(anchors, anchors[-1], side="left"))
            for whole in whole_tables(anchors[:start], most):
                yield table_spans(held.slice(whole.start, whole.stop - whole.start))
            held = held.slice(start).combine_chunks()
            if len(held) > most:
                wide = anchors[-1]
                yield from single_windows(held)
                held = None
        if held is not None and len(held):
            for whole in whole_tables(held["anchor"].to_numpy(), most):
                yield table_spans(held.slice(whole.start, whole.stop - whole.start))
    return run


def whole_tables(anchors: np.ndarray, most: int):
    """Cuts of sorted rows between anchors, of at most ``most`` rows or one anchor."""
    ends = np.append(np.flatnonzero(np.diff(anchors)) + 1, len(anchors))
    at = 0
    while at < len(anchors):
        i = int(np.searchsorted(ends, at + most, side="right")) - 1
        end = int(ends[i]) if i >= 0 and ends[i] > at else int(ends[np.searchsorted(ends, at, side="right")])
        yield slice(at, end)
        at = end


# --- documents --------------------------------------------------------------------

def without_spans(match: int):
    def run(texts: pa.Array, spans: pa.Array) -> pa.Array:
        removed, count, sha = [], [], []
        for text, own in zip(texts, spans):
            body = text.as_buffer()
            items = own.values
            _, begin, end = merged_spans(np.zeros(len(items), dtype=np.int64), *(items.field(c).to_numpy(zero_copy_only=False) for c in ("begin", "end")))
            kept, at = hashlib.sha256(), 0
            for b, e in zip(begin.tolist(), end.tolist()):
                kept.update(body.slice(at, b - at))
                at = e
            kept.update(body.slice(at))
            removed.append(int((end - begin).sum()))
            count.append(len(begin))
            sha.append(kept.hexdigest())
        return pa.StructArray.from_arrays([pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(sha, pa.string())],
                                          names=["n_removed", "n_spans", "kept_sha256"])
    return run


REMOVED_TYPE = T.StructType([T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
                             T.StructField("kept_sha256", T.StringType())])


def keyed_texts(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """``doc_id, ord, tie, text, copies``, one row for each different (id, text).

    Where every row has an id of its own, ``tie`` is 0 and nothing is
    shuffled; else rows of an id are told apart, and ordered, by a hash of their text.
    """
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n, ids, distinct = named.agg(F.count("*"), F.count("doc_id"), F.count_distinct("doc_id")).first()
    if n == ids == distinct:
        return named.select("doc_id", F.col("doc_id").alias("ord"), F.lit(0).cast("long").alias("tie"), "text", F.lit(1).cast("long").alias("copies"))
    keyed = named.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("ord"), F.xxhash64("doc_id", "text").alias("tie"), "text")
    return stored(keyed.groupBy("doc_id", "ord", "tie").agg(F.first("text").alias("text"), F.count("*").alias("copies")), "keyed-texts")


def bounded(keys: DataFrame) -> DataFrame:
    """Keys to be looked up in the texts: broadcast up to ``BROADCAST_KEYS``, else joined by a shuffle."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def repeated_spans(texts: DataFrame, table: int | None = None) -> DataFrame:
    """``ord, tie, begin, end``: spans whose every window also starts earlier; they may overlap."""
    dealt = (texts.select("ord", "tie", "text").mapInArrow(segment_batches, SEGMENT_SCHEMA)
             .repartition("anchor").sortWithinPartitions("anchor", "digest", "extra", "ord", "tie", "at"))
    found = stored(dealt.mapInArrow(meeting_batches, FOUND_SCHEMA), "met-segments")
    wanted = (found.filter("not span").groupBy("ord", "tie")
              .agg(F.collect_list(F.struct("anchor", "at", "r_most", "r_least")).alias("wanted")))     # bounded by the text
    wanted = stored(wanted, "wanted-segments")
    here = texts.select("ord", "tie", "text").join(bounded(wanted.select("ord", "tie")), ["ord", "tie"], "left_semi")
    cut = here.join(wanted, ["ord", "tie"]).select("ord", "tie", "text", "wanted").mapInArrow(cut_batches, CUT_SCHEMA)
    compared = stored(cut.repartition("anchor").sortWithinPartitions("anchor", "ord", "tie", "at")
                      .mapInArrow(comparing_batches(table or TABLE), COMPARED_SCHEMA), "compared-segments")
    windows = compared.filter("h1 is not null")
    place = F.struct("ord", "tie", "begin")
    first = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = windows.join(first, ["h1", "h2"]).filter(place != F.col("first"))
    columns = ["ord", "tie", "begin", "end"]
    return (found.filter("span").select("ord", "tie", F.col("at").alias("begin"), "end")
            .unionByName(compared.filter("h1 is null").select(columns)).unionByName(later.select(columns)))


def repeated_substrings(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", table: int | None = None) -> DataFrame:
    """What is left of each text without the bytes of strings of ``MATCH`` bytes that also start earlier:
    ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, one row per input row.

    Earlier is a smaller ``doc_id``, or an earlier start in the same text.
    Null text is empty.  Rows without an id come after all others.  Rows that
    repeat an id are texts of their own, in the order of a hash; of rows equal in
    id and text one is first.  Extra columns are ignored; no rows, no result.
    """
    texts = keyed_texts(docs, text, doc_id)
    spans = stored(repeated_spans(texts, table).groupBy("ord", "tie").agg(F.collect_list(F.struct("begin", "end")).alias("spans")), "removed-spans")
    touched = bounded(spans.select("ord", "tie"))
    whole = (texts.join(touched, ["ord", "tie"], "left_anti")
             .select("doc_id", "copies", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("text_sha256"),
                     F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256")))
    cut = F.arrow_udf(without_spans(MATCH), REMOVED_TYPE)
    parts = (texts.join(touched, ["ord", "tie"], "left_semi").join(spans, ["ord", "tie"])
             .select("doc_id", "copies", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("text_sha256"),
                     cut("text", "spans").alias("r")).select("doc_id", "copies", "n_bytes", "text_sha256", "r.*"))
    # The second and later of equal rows are removed whole, if they hold a window.
    all_of = lambda yes, no: F.when((F.col("copy") > 1) & (F.col("n_bytes") >= MATCH), yes).otherwise(no)
    return (whole.unionByName(parts).select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
            .select("doc_id", "n_bytes", all_of(F.col("n_bytes"), F.when(F.col("copy") > 1, F.lit(0)).otherwise(F.col("n_removed"))).alias("n_removed"),
                    all_of(F.lit(1), F.when(F.col("copy") > 1, F.lit(0)).otherwise(F.col("n_spans"))).cast("long").alias("n_spans"),
                    all_of(F.sha2(F.lit(""), 256), F.when(F.col("copy") > 1, F.col("text_sha256")).otherwise(F.col("kept_sha256"))).alias("kept_sha256")))
