"""Hidden Markov language model.

Latent states are trained by Baum-Welch: every task runs the scaled
forward-backward recursion over its token sequences and returns expected
counts; the counts are summed over all tasks and give the next model.  Every
round reads all training texts; rounds end when the likelihood gain is small.  The
score of a text is the exact log likelihood of its whole token sequence by
the scaled forward recursion.

Words are tied into classes: a word that makes up at least one in
``FREQUENT`` of all tokens is a class of its own, others share one by their
ending.  A state emits ``P(class | state) * P(word | class)``, with the smoothed
unigram distribution inside the class, so the emission of a word is its
unigram probability times a factor of the state and the class, and the
sequence likelihood is the unigram likelihood times that of the factors.
The factors are a bounded model (states x classes) that every task holds;
word counts cover the whole vocabulary and are never gathered: they are
summed by word and joined back to the blocks of text that hold the word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm import kernels
from strata.llm.tables import BLOCKS_PER_FILE, crc_remainder, stored

STATES = 8
FREQUENT = 8192           # a word with one in so many of the tokens is its own class: at most so many words
ENDINGS = 2048            # classes of the other words
BLOCK_BYTES = 2 << 20     # text per block
CHUNK = 640               # tokens of a long text that are worked on in one piece, side by side with its others
SIEVE = 1 << 18           # bits of word hashes that tell most rare words from the frequent ones
GATHER = 1 << 21          # training tokens that a task brings together
PART_TOKENS = 1 << 19     # tokens of chunks for which a task holds the states of a recursion at once
SUM_GROUPS = 256          # groups of tasks whose counts are summed first
STAY = 0.98               # chance of staying in a state, at the start
GAIN = 0.001              # training ends when a round adds less to the mean log10 likelihood of a token
SMOOTHING = 0.1           # of the unigram counts
PRIOR = 50.0              # pseudo-tokens of the unigram distribution in each state's classes
END = np.uint64(0x454E44)           # hash that stands for the end of a text
TOKEN_SCHEMA = ("block long, doc_id array<long>, train array<boolean>, n array<int>, ids binary, "
                "words binary, endings binary, counts binary")


def fold(text: pa.Array):
    """Rows, tokens of each row, word hashes, classes by ending and the tokens' places among the words, for each slice of texts.

    Every row closes with ``END``.  Only the first token of a word is looked at for its ending.
    """
    for at, data, offsets in kernels.slices(text, BLOCK_BYTES):
        low = kernels.LOWER[data]
        starts, ends, row = kernels.words(low, offsets)
        sums = kernels.prefix_sums(low)
        rows = len(offsets) - 1
        n = np.bincount(row, minlength=rows) + 1
        tokens = np.full(len(starts) + rows, END)
        is_word = np.ones(len(tokens), dtype=bool)
        is_word[np.cumsum(n) - 1] = False
        tokens[is_word] = kernels.span_hashes(low, starts, ends, sums=sums)
        coded = pa.array(tokens).dictionary_encode()
        words, places = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        first = np.empty(len(words), dtype=np.int64)
        first[places[::-1]] = np.arange(len(places) - 1, -1, -1)     # the last to be set stays
        spelt = np.flatnonzero(is_word[first])
        span = (np.cumsum(is_word) - 1)[first[spelt]]
        ending = np.zeros(len(words), dtype=np.uint16)
        tail = kernels.span_hashes(low, np.maximum(starts[span], ends[span] - 3), ends[span], sums=sums)
        ending[spelt] = (tail % np.uint64(ENDINGS)).astype(np.uint16)
        yield at, rows, n, words, ending, places


def token_batches(batches):
    """One row per block of texts: the token sequences as places in the block's own word list."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        ids, train = batch.column("doc_id"), batch.column("train").to_numpy(zero_copy_only=False)
        for at, rows, n, words, ending, places in fold(batch.column("text")):
            mine = train[at:at + rows]
            counts = np.bincount(places, weights=np.repeat(mine, n), minlength=len(words)).astype(np.int32)
            # Frequent words first, so that the high bytes of the places are mostly zero; the rest by hash, which packs better.
            rank = np.lexsort((words, -np.bincount(places, minlength=len(words))))
            place = np.empty(len(words), dtype=np.int64)
            place[rank] = np.arange(len(words))
            number += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([ids.slice(at, rows).to_pylist()], pa.list_(pa.int64())),
                 pa.array([mine.tolist()], pa.list_(pa.bool_())), pa.array([n.tolist()], pa.list_(pa.int32())),
                 pa.array([pack(place[places])], pa.binary()),
                 *[pa.array([x[rank].tobytes()], pa.binary()) for x in (words, ending, counts)]],
                names=["block", "doc_id", "train", "n", "ids", "words", "endings", "counts"])


def blocks_of(batches):
    """The blocks of Arrow batches, one at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def pack(places: np.ndarray) -> bytes:
    """Numbers below 2**16 as two bytes each; larger ones as their low two bytes, then their high two."""
    low = places.astype(np.uint16).tobytes()
    high = (places >> 16).astype(np.uint16)
    return low + (high.tobytes() if high.any() else b"")


def unpack(body: bytes, n: int) -> np.ndarray:
    low = np.frombuffer(body, dtype=np.uint16, count=n).astype(np.int64)
    return low if len(body) == 2 * n else low + (np.frombuffer(body, dtype=np.uint16, offset=2 * n).astype(np.int64) << 16)


def places_of(r: dict, n: np.ndarray) -> np.ndarray:
    return unpack(r["ids"], int(n.sum()))


def word_batches(batches):
    for r in blocks_of(batches):
        words = np.frombuffer(r["words"], dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(words), r["block"])), pa.array(np.arange(len(words), dtype=np.int32)), pa.array(words),
             pa.array(np.frombuffer(r["endings"], dtype=np.uint16).astype(np.int32)),
             pa.array(np.frombuffer(r["counts"], dtype=np.int32).astype(np.int64))], names=["block", "place", "word", "ending", "c"])


class Model:
    """Start, transition and class factors (emission over unigram mass) of the states."""

    def __init__(self, mass: np.ndarray, frequent: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mass, self.frequent = mass, frequent       # unigram mass of each class; sorted hashes of the first classes
        self.start = np.full(STATES, 1 / STATES)
        # States that last, with words of their own: fewer rounds are lost before they part.
        self.move = np.full((STATES, STATES), (1 - STAY) / (STATES - 1)) + np.eye(STATES) * (STAY - (1 - STAY) / (STATES - 1))
        theta = mass * np.exp(rng.standard_normal((STATES, len(mass))))
        theta *= ((1 - mass[-1]) / np.maximum(theta[:, :-1].sum(axis=1), 1e-300))[:, None]
        self.factor = np.divide(theta, mass, out=np.ones_like(theta), where=mass > 0)
        self.factor[:, -1] = 1.0                        # unknown words tell the states nothing

    def classes(self, words: np.ndarray, endings: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Class of each word: its own, that of its ending, or the last for words without a count."""
        out = len(self.frequent) + endings.astype(np.int64)
        if len(self.frequent):
            # A word's low bits pick out the few that may be frequent; only these are looked up.
            low = np.uint64(SIEVE - 1)
            sieve = np.zeros(SIEVE, dtype=bool)
            sieve[self.frequent & low] = True
            may = np.flatnonzero(sieve[words & low])
            at = np.minimum(np.searchsorted(self.frequent, words[may]), len(self.frequent) - 1)
            own = self.frequent[at] == words[may]
            out[may[own]] = at[own]
        return np.where(known, out, len(self.mass) - 1)

    def learn(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        """The next model from expected counts; class counts are smoothed towards the unigram mass."""
        self.start = (start + 1) / (start + 1).sum()
        self.move = (move + 1) / (move + 1).sum(axis=1, keepdims=True)
        emit = emit[:, :-1]
        rest = max(1 - self.mass[-1], 1e-300)
        theta = (emit + PRIOR * self.mass[:-1] / rest) / (emit.sum(axis=1, keepdims=True) + PRIOR) * rest
        self.factor[:, :-1] = np.divide(theta, self.mass[:-1], out=np.ones_like(theta), where=self.mass[:-1] > 0)


class Chunks:
    """Sequences cut into chunks of at most ``size`` tokens, so that long ones are worked on side by side.

    Nothing is lost at the cuts: what the states are there is computed first,
    from the product of each chunk's transition matrices.
    """

    def __init__(self, n: np.ndarray, size: int):
        self.count = -(-n // size)
        self.owner = np.repeat(np.arange(len(n)), self.count)
        self.nth = np.arange(len(self.owner)) - np.repeat(np.cumsum(self.count) - self.count, self.count)
        self.begin = (np.cumsum(n) - n)[self.owner] + self.nth * size
        self.length = np.minimum(size, n[self.owner] - self.nth * size)
        self.last = self.nth == self.count[self.owner] - 1

    def ranks(self, ahead: bool = True):
        """Chunks that follow another, by their number in the sequence."""
        later = np.flatnonzero(self.nth > 0)
        later = later[np.argsort(self.nth[later], kind="stable")]
        groups = np.split(later, np.flatnonzero(np.diff(self.nth[later])) + 1) if len(later) else []
        return groups if ahead else groups[::-1]


def grid(begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks longest first: their order, their first tokens, and how many are alive at each position."""
    order = np.argsort(-length, kind="stable")
    n = length[order]
    return order, begin[order], np.searchsorted(-n, -np.arange(1, (n[0] if len(n) else 0) + 1), side="right")


def state_sums(x: np.ndarray) -> np.ndarray:
    """Sum over the states of each row, pair by pair: for eight states the sum over axis 1 in its own order, but column by column."""
    x = x.T
    while len(x) > 1:
        x = np.concatenate([x[:-1:2] + x[1::2], x[-1:]]) if len(x) % 2 else x[::2] + x[1::2]
    return x[0]


def by_state(factor, classes) -> np.ndarray:
    """The classes' factors, one row for each state: the recursions run along long rows, not across short ones."""
    return np.ascontiguousarray(factor.take(classes, axis=0).T)


def last_states(factor, move, seq, begin, length, enter) -> tuple[np.ndarray, np.ndarray]:
    """State distribution after each chunk, entered with the distribution ``enter``, and log10 of its likelihood."""
    order, start, alive = grid(begin, length)
    x, logs, back = np.ascontiguousarray(enter[order].T), np.zeros(len(begin)), np.ascontiguousarray(move.T)
    for t, k in enumerate(alive):
        y = back @ x[:, :k] if t else x[:, :k].copy()
        y *= by_state(factor, seq[start[:k] + t])
        c = state_sums(y.T)
        np.divide(y, c, out=x[:, :k])       # what lies beyond has ended
        logs[:k] += np.log10(c)
    out, total = np.empty_like(enter), np.empty(len(begin))
    out[order], total[order] = x.T, logs
    return out, total


def transfers(factor, move, seq, begin, length) -> np.ndarray:
    """Product of the transition and emission matrices of each chunk, up to a scale."""
    order, start, alive = grid(begin, length)
    states = len(move)
    x, back = np.empty((states, states, len(begin)), dtype=factor.dtype), np.ascontiguousarray(move.T)
    x[:] = np.eye(states, dtype=factor.dtype)[:, :, None]       # from state, to state, chunk
    for t, k in enumerate(alive):
        y = back @ x[:, :, :k]
        y *= by_state(factor, seq[start[:k] + t])
        np.divide(y, state_sums(y.sum(axis=0).T), out=x[:, :, :k])
    out = np.empty((len(begin), states, states), dtype=factor.dtype)
    out[order] = x.transpose(2, 0, 1)
    return out


def entered(model: Model, factor, move, seq, chunks: Chunks, matrices: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each chunk the state distribution at the end of the one before, and the distribution it enters with."""
    begin_state = model.start.astype(factor.dtype)
    enter = np.tile(begin_state, (len(chunks.begin), 1))
    after = np.zeros_like(enter)
    heads = np.flatnonzero((chunks.nth == 0) & ~chunks.last)
    after[heads] = last_states(factor, move, seq, chunks.begin[heads], chunks.length[heads], enter[heads])[0]
    before = np.zeros_like(enter)
    inner = np.flatnonzero((chunks.nth > 0) & ~chunks.last)
    if matrices is None:
        matrices = np.zeros((len(enter), *move.shape), dtype=factor.dtype)
        matrices[inner] = transfers(factor, move, seq, chunks.begin[inner], chunks.length[inner])
    for group in chunks.ranks():
        before[group] = after[group - 1]
        enter[group] = before[group] @ move
        x = np.einsum("ns,nst->nt", before[group], matrices[group])
        goes_on = ~chunks.last[group]
        after[group[goes_on]] = x[goes_on] / x[goes_on].sum(axis=1, keepdims=True)
    return before, enter


def forward(model: Model, seq: np.ndarray, n: np.ndarray, size: int | None = None) -> np.ndarray:
    """log10 of the factors' likelihood of each sequence of classes, by the scaled forward recursion."""
    factor, chunks = np.ascontiguousarray(model.factor.T), Chunks(n, size or CHUNK)
    _, enter = entered(model, factor, model.move, seq, chunks)
    _, total = last_states(factor, model.move, seq, chunks.begin, chunks.length, enter)
    return np.bincount(chunks.owner, weights=total, minlength=len(n))


def expected(model: Model, seq: np.ndarray, n: np.ndarray):
    """Expected start, transition and class counts of whole sequences."""
    return expected_and_score(model, seq, n)[:3]


def expected_and_score(model: Model, seq: np.ndarray, n: np.ndarray, width: int | None = None, size: int | None = None, kind=np.float64):
    """Expected counts, and log10 of the factors' likelihood of all sequences, computed in numbers of ``kind``."""
    first, moves, emit, score = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, len(model.mass))), 0.0
    factor, move, chunks = np.ascontiguousarray(model.factor.T.astype(kind)), model.move.astype(kind), Chunks(n, size or CHUNK)
    later = np.flatnonzero(chunks.nth > 0)
    matrices = np.zeros((len(chunks.begin), STATES, STATES), dtype=kind)
    matrices[later] = transfers(factor, move, seq, chunks.begin[later], chunks.length[later])
    before, enter = entered(model, factor, move, seq, chunks, matrices)
    leave = np.ones_like(enter)                             # what follows the chunk, given the state at its end
    for group in chunks.ranks(ahead=False):
        x = np.einsum("nst,nt->ns", matrices[group], leave[group])
        leave[group - 1] = x / (x * before[group]).sum(axis=1, keepdims=True)
    order = np.argsort(-chunks.length, kind="stable")       # chunks of like length together
    part_of = (np.cumsum(chunks.length[order]) - chunks.length[order]) // (width or PART_TOKENS)
    back = np.ascontiguousarray(move.T)
    for mine in np.split(order, np.flatnonzero(np.diff(part_of)) + 1) if len(order) else []:
        start, alive = grid(chunks.begin[mine], chunks.length[mine])[1:]      # already longest first
        ends = np.cumsum(alive)
        steps = [slice(e - k, e) for e, k in zip(ends, alive)]                # the tokens at each position of the chunks
        where, scale = np.empty(ends[-1], dtype=np.int64), np.empty(ends[-1], dtype=kind)
        states, factors = np.empty((STATES, ends[-1]), dtype=kind), []
        for t, (now, k) in enumerate(zip(steps, alive)):
            where[now] = seq[start[:k] + t]
            e = by_state(factor, where[now])
            x = back @ states[:, steps[t - 1]][:, :k] if t else enter[mine].T.copy()
            x *= e
            scale[now] = state_sums(x.T)
            np.divide(x, scale[now], out=states[:, now])
            factors.append(e)
        score += float(np.log10(scale).sum(dtype=np.float64))
        after = np.ascontiguousarray(leave[mine].T)         # of chunks that end earlier it still is what follows them
        for t in range(len(alive) - 1, -1, -1):
            now, k = steps[t], alive[t]
            ahead = factors.pop()
            ahead *= after[:, :k]
            ahead /= scale[now]
            states[:, now] *= after[:, :k]                  # from here on the chances of the states given the whole text
            if t:
                moves += move * (states[:, steps[t - 1]][:, :k] @ ahead.T)
                np.matmul(move, ahead, out=after[:, :k])
        inner = chunks.nth[mine] > 0
        moves += move * (before[mine[inner]].T @ ahead[:, inner].T)
        first += np.ascontiguousarray(states[:, steps[0]][:, ~inner].T).sum(axis=0)
        for z in range(STATES):
            emit[z] += np.bincount(where, weights=states[z], minlength=len(model.mass))
    return first, moves, emit, score


def training_classes(model: Model, r: dict) -> tuple[np.ndarray, np.ndarray]:
    """Class sequences of a block's training texts and their lengths."""
    words, counts = np.frombuffer(r["words"], dtype=np.uint64), np.frombuffer(r["counts"], dtype=np.int32)
    classes = model.classes(words, np.frombuffer(r["endings"], dtype=np.uint16), counts > 0)
    n, train = np.array(r["n"]), np.array(r["train"], dtype=bool)
    return classes[places_of(r, n)[np.repeat(train, n)]], n[train]


def count_batches(model: Model):
    """Expected counts of a task, one row per state; each has the log likelihood of the task's texts."""
    def run(batches):
        sums = [np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, len(model.mass))), 0.0]
        held, size = [], 0

        def counted():
            seq, n = (np.concatenate(x) for x in zip(*held))
            return [x + y for x, y in zip(sums, expected_and_score(model, seq, n, kind=np.float32))]
        for r in blocks_of(batches):
            seq, n = training_classes(model, r)
            held.append((seq.astype(np.int32), n))
            size += len(seq)
            if size >= GATHER:      # texts of many blocks, so that many of like length stand side by side
                sums, held, size = counted(), [], 0
        if size:
            sums = counted()
        first, move, emit, score = sums
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(STATES), pa.int32()), pa.array(np.full(STATES, TaskContext.get().partitionId() % SUM_GROUPS), pa.int32()),
             pa.array(first), pa.array(list(move), pa.list_(pa.float64())),
             pa.array(list(emit), pa.list_(pa.float64())), pa.array(np.full(STATES, score))],
            names=["state", "part", "first", "move", "emit", "score"])
    return run


def add_counts(table: pa.Table) -> pa.Table:
    """The sum of some tasks' counts of one state, one row after the other."""
    def add(column):
        total = None
        for x in table[column]:
            x = x.values.to_numpy() if isinstance(x, pa.ListScalar) else x.as_py()
            total = x + 0.0 if total is None else total + x
        return total
    return pa.table({"state": table["state"][:1], "part": table["part"][:1], "first": [float(add("first"))],
                     "move": pa.array([add("move")], pa.list_(pa.float64())), "emit": pa.array([add("emit")], pa.list_(pa.float64())),
                     "score": [float(add("score"))]})


def summed(counts: DataFrame) -> DataFrame:
    """One row per state: tasks are summed in ``SUM_GROUPS`` groups, then the groups, so that no
    worker holds more than a group's rows or ``SUM_GROUPS`` sums."""
    return (counts.groupBy("state", "part").applyInArrow(add_counts, COUNT_SCHEMA)
            .groupBy("state").applyInArrow(add_counts, COUNT_SCHEMA))


COUNT_SCHEMA = "state int, part int, first double, move array<double>, emit array<double>, score double"


class Trained:
    """Blocks of tokens, the counts of their words, the unigram totals and the state model."""

    def __init__(self, blocks: DataFrame, counts: DataFrame, tokens: int, distinct: int, model: Model):
        self.blocks, self.counts, self.tokens, self.distinct, self.model = blocks, counts, tokens, distinct, model


def word_counts(blocks: DataFrame) -> DataFrame:
    """One row per block and different word: its count in all blocks, and whether the block is its first.

    A word in every block is still one row per block.  Rows are sorted by word alone, once.
    """
    words = blocks.select("block", "words", "endings", "counts").mapInArrow(
        word_batches, "block long, place int, word long, ending int, c long")
    by_word = Window.partitionBy("word")
    return words.select("block", "place", "word", "ending", F.sum("c").over(by_word).alias("total"),
                        (F.min("block").over(by_word) == F.col("block")).alias("first"))


def train(docs: DataFrame) -> Trained:
    """``docs`` has ``doc_id, text, train``; only rows marked ``train`` are learned from."""
    blocks = stored(docs.mapInArrow(token_batches, TOKEN_SCHEMA), "tokens", BLOCKS_PER_FILE)
    counts = stored(word_counts(blocks), "counts")
    vocabulary = counts.filter("first and total > 0")
    row = vocabulary.agg(F.sum("total").alias("n"), F.count("*").alias("v")).first()
    tokens, distinct = row.n or 0, row.v
    below = tokens + SMOOTHING * (distinct + 1)
    own = vocabulary.filter(F.col("total") * FREQUENT >= tokens).select("word", "total").collect()   # at most FREQUENT rows
    shared = vocabulary.filter(F.col("total") * FREQUENT < tokens).groupBy("ending").agg(
        F.sum("total").alias("n"), F.count("*").alias("v")).collect()                                # at most ENDINGS rows
    own = sorted((r.word % 2**64, r.total) for r in own)
    mass = np.zeros(len(own) + ENDINGS + 1)
    mass[:len(own)] = [(c + SMOOTHING) / below for _, c in own]
    for r in shared:
        mass[len(own) + r.ending] = (r.n + SMOOTHING * r.v) / below
    mass[-1] = SMOOTHING / below
    model = Model(mass, np.array([w for w, _ in own], dtype=np.uint64))
    last = -np.inf
    while True:
        found = summed(blocks.mapInArrow(count_batches(model), COUNT_SCHEMA)).orderBy("state").collect()   # one row per state
        if not found or not tokens:
            break
        model.learn(np.array([r["first"] for r in found]), np.array([r.move for r in found]), np.array([r.emit for r in found]))
        score = found[0].score / tokens     # of the model that this round has replaced
        if score - last < GAIN:
            break
        last = score
    return Trained(blocks, counts, tokens, distinct, model)


def score_groups(trained_tokens: int, distinct: int, model: Model):
    below = trained_tokens + SMOOTHING * (distinct + 1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("place")
        place, total = right["place"].to_numpy(), right["total"].to_numpy()
        out = {k: [] for k in ("doc_id", "n_tokens", "n_known", "base_score", "score")}
        for r in left.to_pylist():
            words = np.frombuffer(r["words"], dtype=np.uint64)
            c = np.zeros(len(words), dtype=np.int64)
            c[place] = total
            n = np.array(r["n"])
            ids = places_of(r, n)
            ends = np.cumsum(n)
            base = kernels.per_row_sum(np.log10((c + SMOOTHING) / below)[ids] if below else np.zeros(len(ids)), ends)
            classes = model.classes(words, np.frombuffer(r["endings"], dtype=np.uint16), c > 0)
            out["doc_id"] += r["doc_id"]
            out["n_tokens"] += n.tolist()
            out["n_known"] += kernels.per_row_sum((c > 0)[ids].astype(np.int64), ends).tolist()
            out["base_score"] += base.tolist()
            out["score"] += (base + forward(model, classes[ids], n)).tolist()
        types = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), types)})
    return run


def score_texts(trained: Trained) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every text."""
    run = score_groups(trained.tokens, trained.distinct, trained.model)
    return (trained.blocks.select("block", "doc_id", "n", "ids", "words", "endings").groupBy("block")
            .cogroup(trained.counts.select("block", "place", "total").groupBy("block"))
            .applyInArrow(run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
            .withColumn("train_tokens", F.lit(trained.tokens).cast("long")))


def language_model_scores(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", modulus: int = 10, held: int = 0) -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score`` (log10; the end of a text is a token).

    Rows whose crc32(id) leaves the held-out remainder, and rows without an
    id, are scored but not learned from.  Null text is an empty text: its
    only token is the end.  Rows that repeat an id are scored one by one.
    Extra columns are ignored; an empty table gives an empty result.
    """
    rest = crc_remainder(F.col(doc_id), modulus)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       F.coalesce(rest != held, F.lit(False)).alias("train"))
    scored = score_texts(train(rows))
    return scored.withColumn("held_out", F.coalesce(crc_remainder("doc_id", modulus) == held, F.lit(False)))
