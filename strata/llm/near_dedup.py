"""MinHash near-duplicates with sequential Bayesian verification.

Equal shingle sets are one class, represented by its smallest id.  The
representatives' MinHash signatures are banded; documents that share a band
are compared signature batch by signature batch, and a pair is dropped as
soon as the posterior probability that its similarity reaches the threshold
falls below ``MISS``.  Survivors are verified exactly on their full sets.

Within a band bucket, pairs are not listed: a survivor is emitted only if
it joins two groups that are not joined yet, so a bucket emits fewer pairs
than it has members, and the texts of emitted pairs are joined and compared.
Where that refutes a pair, the buckets concerned are gone through once more:
their members that still have a survivor in another component bring their
texts along, each pair is verified in the task of its lowest shared band, and
only links that join two groups leave the task.  So pairs just below the
threshold, however many, are compared but never become rows.  Large buckets
are compared block against block.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import kernels
from strata.llm.components import components
from strata.llm.tables import materialize, numbered, shuffled, stored, without_keys

BANDS, ROWS = 25, 5     # a pair at similarity 0.8 shares no band with probability 5e-5, at 0.85 4e-7
MISS = 1e-6             # chosen probability of pruning a pair that reaches the threshold
BATCH = 25              # signature positions compared at a time
BLOCK = 1024            # members of a bucket that are compared in one task with as many others
BLOCK_SHINGLES = 2**20  # and the shingles that they have together
BROADCAST_IDS = 1_000_000

_rng = np.random.default_rng(31)
_ADD = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)[:, None]
_MULTIPLY = (_rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
SIGNATURE_SCHEMA = "doc_id long, n_shingles long, class binary, bands array<long>, sig binary"


def shingle_sets(texts: pa.Array, size: int):
    """The sorted, distinct shingle hashes of each text."""
    for _, data, offsets in kernels.slices(texts):
        starts, ends, row = kernels.words(data, offsets)
        h = kernels.span_hashes(kernels.LOWER[data], starts, ends)
        h, upto = kernels.shingle_hashes(h, row, len(offsets) - 1, size)
        begin = 0
        for end in upto:
            yield np.unique(h[begin:end])
            begin = end


def minhash(shingles: np.ndarray) -> np.ndarray:
    out = np.full(BANDS * ROWS, 2**32 - 1, dtype=np.uint64)
    for k in range(0, len(shingles), 4096):
        np.minimum(out, (((shingles[k:k + 4096] ^ _ADD) * _MULTIPLY) >> np.uint64(32)).min(axis=1), out=out)
    return out


def signature_batches(size: int):
    def run(batches):
        number = np.arange(BANDS, dtype=np.uint64)
        for batch in batches:
            n, classes, bands, sigs = [], [], [], []
            for s in shingle_sets(batch.column("text"), size):
                n.append(len(s))
                if not len(s):
                    classes.append(None), bands.append(None), sigs.append(None)
                    continue
                m = minhash(s)
                classes.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                key = number + np.uint64(1)
                for r in range(ROWS):
                    key = kernels.mix(key * np.uint64(3) + (m[r::ROWS] & np.uint64(255)))   # as in the signature
                bands.append(key.view(np.int64))
                sigs.append(m.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(classes, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary())],
                names=["doc_id", "n_shingles", "class", "bands", "sig"])
    return run


def least_matches(percent: int) -> list[int]:
    """After 1, 2, ... batches, the fewest equal positions at which the
    posterior (uniform prior) still gives the threshold a chance of ``MISS``.
    Positions are bytes, so unequal ones agree with probability 1/256."""
    t = percent / 100 + (1 - percent / 100) / 256
    out = []
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        below, m = 0.0, -1
        while below < MISS:   # P(similarity >= t | m of n equal) = P(Binomial(n + 1, t) <= m)
            m += 1
            below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


class Bucket:
    """The members of one bucket task."""

    def __init__(self, ids, n, sig, side, component, percent, band=None):
        order = np.argsort(ids, kind="stable")
        self.order, self.ids, self.n, self.sig, self.side = order, ids[order], n[order], sig[order], side[order]
        self.group = np.unique(component[order], return_inverse=True)[1]
        self.percent, self.need, self.band = percent, least_matches(percent), band

    def survivors(self, i: int) -> np.ndarray:
        """Later members of other groups whose signature may reach the threshold with
        member ``i``; with a ``band`` only those that share no lower one with it."""
        n, m = self.n[i + 1:], self.n[i]
        fit = (self.group[i + 1:] != self.group[i]) & (n * 100 >= m * self.percent) & (m * 100 >= n * self.percent)
        if self.side.any():
            fit &= self.side[i + 1:] != self.side[i]
        at = np.flatnonzero(fit) + i + 1
        equal = np.zeros(len(at), dtype=np.int64)
        for k, need in enumerate(self.need):
            if not len(at):
                break
            cut = slice(k * BATCH, (k + 1) * BATCH)
            equal += (self.sig[at, cut] == self.sig[i, cut]).sum(axis=1)
            at, equal = at[equal >= need], equal[equal >= need]
        if self.band is not None and len(at):
            shared = (self.sig[at] == self.sig[i]).reshape(-1, BANDS, ROWS).all(axis=2)
            at = at[shared.argmax(axis=1) == self.band]
        return at

    def join(self, i: int, at: np.ndarray) -> list[tuple[int, int]]:
        """One pair for each group of ``at``; these groups become that of ``i``."""
        groups, first = np.unique(self.group[at], return_index=True)
        pairs = [(self.ids[i], self.ids[j]) for j in at[first]]
        self.group[np.isin(self.group, groups)] = self.group[i]
        return pairs

    def pairs(self) -> list[tuple[int, int]]:
        """Pairs to verify; were all of them links, no survivor would be left between two groups."""
        out = []
        for i in range(len(self.ids) - 1):
            out += self.join(i, self.survivors(i))
        return out

    def needed(self) -> np.ndarray:
        """The members, as given, that have a survivor."""
        mark = np.zeros(len(self.ids), dtype=bool)
        for i in range(len(self.ids) - 1):
            at = self.survivors(i)
            mark[at] = True
            mark[i] |= len(at) > 0
        return np.sort(self.order[mark])

    def links(self, sets: list[np.ndarray]) -> list[tuple[int, int]]:
        """Verified links that join two groups; ``sets`` are the members' shingles, as given."""
        sets = [sets[k] for k in self.order]
        size = np.array([len(x) for x in sets], dtype=np.int64)
        token = np.unique(np.concatenate(sets), return_inverse=True)[1] if len(sets) else np.zeros(0, dtype=np.int64)
        end = size.cumsum()
        mark = np.zeros(token.max() + 1 if len(token) else 0, dtype=bool)
        out = []
        for i in range(len(sets) - 1):
            at = self.survivors(i)
            at = at[size[at] > 0]
            if not len(at) or not size[i]:
                continue
            mine = token[end[i] - size[i]:end[i]]
            mark[mine] = True
            both = np.array([np.count_nonzero(mark[token[end[j] - size[j]:end[j]]]) for j in at])
            mark[mine] = False
            out += self.join(i, at[100 * both >= self.percent * (size[i] + size[at] - both)])
        return out


def by_task(of):
    """``of`` for the rows of whole tasks, from batches that are sorted by task."""
    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            task = held["task"].to_numpy()
            whole = int(np.searchsorted(task, task[-1]))   # the last task may go on in the next batch
            if whole:
                yield of(held.slice(0, whole).combine_chunks())
                held = held.slice(whole).combine_chunks()
        if held is not None:
            yield of(held.combine_chunks())
    return run


def buckets_of(rows: pa.Table, percent: int, banded: bool):
    """Each task's rows (from, to) and its ``Bucket``."""
    task = rows["task"].to_numpy()
    cut = np.flatnonzero(np.concatenate([[True], task[1:] != task[:-1], [True]])) if len(task) else [0]
    a, n, side, comp, band = (rows[c].to_numpy() for c in ("a", "n", "side", "component", "band"))
    for s, e in zip(cut[:-1], cut[1:]):
        sig = np.frombuffer(b"".join(rows["sig"].slice(s, e - s).to_pylist()), dtype=np.uint8).reshape(-1, BANDS * ROWS)
        yield s, e, Bucket(a[s:e], n[s:e], sig, side[s:e], comp[s:e], percent, band[s] if banded else None)


def pair_batch(out: list[tuple[int, int, int]]) -> pa.RecordBatch:
    cols = list(zip(*out)) if out else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["task", "a", "b"])


def emit_batches(percent: int):
    def of(rows: pa.Table) -> pa.RecordBatch:
        task = rows["task"].to_numpy()
        return pair_batch([(task[s], a, b) for s, _, bucket in buckets_of(rows, percent, False) for a, b in bucket.pairs()])
    return by_task(of)


def needed_batches(percent: int):
    def of(rows: pa.Table) -> pa.RecordBatch:
        keep = [s + bucket.needed() for s, _, bucket in buckets_of(rows, percent, True)]
        return rows.take(pa.array(np.concatenate(keep) if keep else [], pa.int64())).combine_chunks().to_batches()[0] \
            if any(map(len, keep)) else pa.RecordBatch.from_pylist([], schema=rows.schema)
    return by_task(of)


def link_batches(size: int, percent: int):
    def of(rows: pa.Table) -> pa.RecordBatch:
        task, out = rows["task"].to_numpy(), []
        for s, e, bucket in buckets_of(rows, percent, True):
            texts = rows["text"].slice(s, e - s).combine_chunks()
            out += [(task[s], a, b) for a, b in bucket.links(list(shingle_sets(texts, size)))]
        return pair_batch(out)
    return by_task(of)


def verify_batches(size: int, percent: int):
    def run(batches):
        for batch in batches:
            ok = []
            for x, y in zip(shingle_sets(batch.column("text_a"), size), shingle_sets(batch.column("text_b"), size)):
                both = len(x) + len(y) - len(np.union1d(x, y))
                ok.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(ok, pa.bool_())], names=["a", "b", "ok"])
    return run


def texts_of(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one of ``ids``.  Up to ``BROADCAST_IDS`` ids go to the
    documents, so that only their texts are shuffled; more are joined by a shuffle."""
    ids = materialize(ids.distinct())
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else shuffled(ids), "doc_id", "left_semi")


def verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``a, b, ok`` of distinct pairs, by the exact similarity of their full sets."""
    texts = texts_of(pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))), docs)
    both = (pairs.join(shuffled(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))), "a")
            .join(shuffled(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))), "b"))
    checked = both.select("a", "b", "text_a", "text_b").mapInArrow(verify_batches(size, percent), "a long, b long, ok boolean")
    return materialize(checked.groupBy("a", "b").agg(F.bool_or("ok").alias("ok")))


MEMBERS = "task long, band int, a long, n long, sig binary, side int, component long"
PAIRS = "task long, a long, b long"


def bucket_tasks(reps: DataFrame) -> DataFrame:
    """``task, band, a, n, sig, side``: the members of each different bucket, large ones in
    pairs of blocks.  Of buckets with the same members, that of the lowest band stays."""
    banded = reps.select("rep", "n_shingles", F.posexplode("bands").alias("band", "key"))
    buckets = (banded.groupBy("key").agg(F.count("*").alias("members"), F.min("rep").alias("lo"), F.max("rep").alias("hi"),
                                         F.bit_xor(F.xxhash64("rep")).alias("x"), F.min("band").alias("band"),
                                         F.sum("n_shingles").alias("shingles"))
               .filter("lo < hi").groupBy("members", "lo", "hi", "x")
               .agg(F.min_by("key", F.struct("band", "key")).alias("key"), F.max("shingles").alias("shingles"))
               .select("key", F.ceil(F.greatest(F.col("members") / BLOCK, F.col("shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks")))
    members = (banded.select("rep", "band", "key").join(shuffled(buckets), "key")
               .join(shuffled(reps.select("rep", "n_shingles", "sig")), "rep"))
    block = F.pmod(F.xxhash64("rep", F.lit(11)), F.col("blocks")).cast("int")
    return (members.withColumn("block", block).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
            .select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("task"), "band",
                    F.col("rep").alias("a"), F.col("n_shingles").alias("n"), "sig",
                    (F.col("block") > F.col("other")).cast("int").alias("side")))


def dealt(members: DataFrame) -> DataFrame:
    """Each task's rows together, by a hash of the task."""
    return members.repartition(F.xxhash64("task")).sortWithinPartitions("task")


def linked(reps: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame | None:
    """``node, component`` of linked representatives that are not the least of theirs; None without links."""
    tasks = stored(bucket_tasks(reps), "buckets")
    emitted = materialize(dealt(tasks.withColumn("component", F.col("a"))).select("task", "band", "a", "n", "sig", "side", "component")
                          .mapInArrow(emit_batches(percent), PAIRS))
    new = materialize(emitted.select("a", "b").distinct())
    if new.isEmpty():
        return None
    checked = verified(new, docs, size, percent)
    links = checked.filter("ok").select("a", "b")
    labels = components(links)
    refuted = emitted.join(checked.filter("not ok"), ["a", "b"]).select("task").distinct()
    members = (tasks.join(shuffled(refuted), "task", "left_semi").join(shuffled(labels), F.col("a") == labels.node, "left")
               .withColumn("component", F.coalesce("component", "a")))
    needed = stored(dealt(members.select("task", "band", "a", "n", "sig", "side", "component"))
                    .mapInArrow(needed_batches(percent), MEMBERS), "undecided")
    texts = texts_of(needed.select(F.col("a").alias("doc_id")), docs).select(F.col("doc_id").alias("a"), "text")
    late = materialize(dealt(needed.join(shuffled(texts), "a")).mapInArrow(link_batches(size, percent), PAIRS).select("a", "b").distinct())
    return labels if late.isEmpty() else components(links.unionByName(late))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when 100 * shared shingles >= ``percent`` * all
    shingles of the two; ``component_id`` is the smallest id reachable over
    links, ``kept`` marks the row of that id.  Texts of fewer than ``size``
    words, but not none, are one shingle; null and empty texts and rows
    without an id are linked with nothing and kept.  Rows that repeat an id
    are one document of several texts.  Extra columns are ignored; an empty
    table gives an empty result.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = stored(docs.mapInArrow(signature_batches(size), SIGNATURE_SCHEMA), "signatures")
    reps = stored(signed.filter("class is not null and doc_id is not null")
                  .groupBy("class").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"),
                                        F.first("bands").alias("bands"), F.first("sig").alias("sig")), "classes")
    labels = linked(reps, docs, size, percent)
    ids = reps.select("class", "rep")
    if labels is not None:
        ids = ids.join(shuffled(labels), ids.rep == labels.node, "left").select("class", F.coalesce("component", "rep").alias("rep"))
    return (signed.select("doc_id", "n_shingles", "class").join(shuffled(ids), "class", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("component_id"))
            .withColumn("kept", F.expr("doc_id <=> component_id")))


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id; all columns kept, rows without an id stay.

    Every row is a document of its own, so texts that share an id are judged apart.
    """
    keyed = numbered(docs, "near-rows")
    ids = keyed.filter("row.doc_id is not null").select("key", F.col("row.doc_id").alias("id"), "row.text")
    found = (near_duplicates(ids.select(F.col("key").alias("doc_id"), "text"), size, percent)
             .select(F.col("doc_id").alias("key"), F.col("component_id").alias("component")).join(shuffled(ids.select("key", "id")), "key"))
    groups = materialize(found)
    stays = groups.groupBy("component").agg(F.min(F.struct("id", "key")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    return without_keys(keyed, groups.join(shuffled(stays), "component").filter("key != first.key"))
