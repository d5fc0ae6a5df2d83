import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import hmm, kernels, queries
from strata.llm.tables import read

SF = "/root/testdata/sf0.001"


def tokens(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]


def brute(rows):
    train = [i is not None and zlib.crc32(str(i).encode()) % 10 != 0 for i, _ in rows]
    c = Counter(w for (i, t), k in zip(rows, train) if k for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return sorted(((i, not k and i is not None, len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n,
                    round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)) if n else 0.0, 6))
                   for (i, t), k in zip(rows, train)), key=str)


def got(df):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect()), key=str)


def test_base_scores_and_gain_on_held_out_texts(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SF, "documents").collect()]
    out = queries.op2_language_model(spark, SF)
    assert got(out) == brute(rows)
    held = [r for r in out.collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_odd_rows(docs_of):
    rows = [(k, "The cat sat. " * (k % 4) + "das haus " * (k % 3)) for k in range(40)]
    rows += [(None, "the cat"), (100, None), (101, ""), (102, "unseen word"), (103, "la casa " * 15000), (5, "again the")]
    docs = docs_of(rows, {"block": F.lit("b"), "train": F.lit(3), "words": F.lit(None).cast("string")})
    out = hmm.language_model_scores(docs)
    assert got(out) == brute(rows) and all(math.isfinite(r.score) for r in out.collect())
    assert hmm.language_model_scores(docs_of([])).count() == 0


def small(seed=1):
    rng = np.random.default_rng(seed)
    mass = rng.dirichlet(np.ones(6))
    return hmm.Model(mass, np.array([], dtype=np.uint64), seed), rng


def test_forward_is_the_sum_over_all_state_paths(monkeypatch):
    monkeypatch.setattr(hmm, "STATES", 3)
    model, rng = small()
    n = np.array([4, 1, 3])
    seq = rng.integers(0, 6, n.sum())
    at = 0
    for k, got_ in zip(n, hmm.forward(model, seq, n)):
        s = seq[at:at + k]
        at += k
        paths = np.array(np.meshgrid(*[range(3)] * k)).reshape(k, -1).T
        total = sum(model.start[p[0]] * np.prod([model.move[a, b] for a, b in zip(p, p[1:])]) *
                    np.prod([model.factor[z, x] for z, x in zip(p, s)]) for p in paths)
        assert got_ == pytest.approx(math.log10(total))


def test_rounds_raise_the_likelihood_and_stay_distributions(monkeypatch):
    monkeypatch.setattr(hmm, "STATES", 3)
    monkeypatch.setattr(hmm, "PRIOR", 1e-9)
    model, rng = small(2)
    n = rng.integers(1, 40, 200)
    seq = np.concatenate([rng.choice(5, k, p=[.5, .5, 0, 0, 0] if rng.random() < .5 else [0, 0, .4, .3, .3]) for k in n])
    last = hmm.forward(model, seq, n).sum()
    for _ in range(5):
        first, move, emit = hmm.expected(model, seq, n)
        assert first.sum() == pytest.approx(len(n)) and emit.sum() == pytest.approx(n.sum()) and move.sum() == pytest.approx((n - 1).sum())
        model.learn(first, move, emit)
        assert np.allclose((model.factor * model.mass).sum(axis=1), 1) and np.allclose(model.move.sum(axis=1), 1)
        now = hmm.forward(model, seq, n).sum()
        assert now > last - 0.5   # one pseudo-count of start and move
        last = now


def test_places_round_trip():
    for top in (1, 1 << 16, 1 << 20):
        places = np.random.default_rng(top).integers(0, top, 1000)
        assert (hmm.unpack(hmm.pack(places), 1000) == places).all()


def test_every_training_text_shapes_the_model(docs_of):
    """The same model from any split of the rows: no sample by place."""
    rng = np.random.default_rng(4)
    topics = [[f"{t}{k}" for k in range(40)] for t in ("a", "b", "c")]
    docs = docs_of([(k, " ".join(rng.choice(topics[k % 3], 12))) for k in range(3000)])
    one, many = ({r.doc_id: r.score for r in hmm.language_model_scores(docs.repartition(k)).collect()} for k in (1, 5))
    assert one.keys() == many.keys() and all(one[i] == pytest.approx(many[i], abs=1e-3) for i in one)


def test_training_texts_are_not_cut():
    model, rng = small()
    n = np.array([700, 1, 300])
    block = {"words": np.arange(6, dtype=np.uint64).tobytes(), "endings": np.arange(6, dtype=np.uint16).tobytes(),
             "counts": np.ones(6, dtype=np.int32).tobytes(), "n": n.tolist(), "train": [True, False, True],
             "ids": hmm.pack(rng.integers(0, 6, n.sum()))}
    model.frequent, model.mass = np.arange(5, dtype=np.uint64), np.ones(6 + hmm.ENDINGS) / (6 + hmm.ENDINGS)
    model.factor = np.ones((hmm.STATES, len(model.mass)))
    seq, lengths = hmm.training_classes(model, block)
    first, move, _ = hmm.expected(model, seq, lengths)
    assert lengths.tolist() == [700, 300]
    assert first.sum() == pytest.approx(2) and move.sum() == pytest.approx(998)


@pytest.mark.parametrize("size", [1, 3, 8, 64])
def test_chunks_change_nothing(size):
    model, rng = small(7)
    n = rng.integers(1, 50, 60)
    seq = rng.integers(0, 6, n.sum())
    model.learn(*hmm.expected(model, seq, n))
    whole, cut = (hmm.expected_and_score(model, seq, n, width=w, size=k) for w, k in ((1 << 20, 1000), (100, size)))
    for a, b in zip(whole, cut):
        assert np.allclose(a, b)
    assert np.allclose(hmm.forward(model, seq, n, 1000), hmm.forward(model, seq, n, size))
    rough = hmm.expected_and_score(model, seq, n, size=size, kind=np.float32)
    assert all(np.allclose(a, b, rtol=1e-3, atol=1e-3) for a, b in zip(whole, rough))


def test_summed_counts_equal_those_of_one_task(spark, docs_of):
    rng = np.random.default_rng(8)
    docs = docs_of([(k, " ".join(rng.choice(["a", "b", "c", "d"], rng.integers(0, 60)))) for k in range(400)])
    rows = docs.selectExpr("doc_id", "text", "true as train")
    trained = hmm.train(rows.coalesce(1))
    want = {r.state: r for r in hmm.summed(trained.blocks.coalesce(1).mapInArrow(hmm.count_batches(trained.model), hmm.COUNT_SCHEMA)).collect()}
    blocks = rows.repartition(7).mapInArrow(hmm.token_batches, hmm.TOKEN_SCHEMA)
    got_ = {r.state: r for r in hmm.summed(blocks.mapInArrow(hmm.count_batches(trained.model), hmm.COUNT_SCHEMA)).collect()}
    assert want.keys() == got_.keys()
    for z in want:
        assert got_[z].first == pytest.approx(want[z].first, abs=1e-2) and got_[z].score == pytest.approx(want[z].score, abs=1e-1)
        assert np.allclose(got_[z].emit, want[z].emit, atol=1e-2) and np.allclose(got_[z].move, want[z].move, atol=1e-2)


def test_sums_and_classes_are_those_of_the_plain_forms():
    rng = np.random.default_rng(4)
    for kind in (np.float32, np.float64):
        x = rng.random((500, hmm.STATES)).astype(kind)
        assert np.array_equal(hmm.state_sums(x), x.sum(axis=1))
    frequent = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
    model = hmm.Model(np.full(len(frequent) + hmm.ENDINGS + 1, 1e-4), frequent)
    near = frequent + np.uint64(hmm.SIEVE)      # rare words with the low bits of frequent ones
    words = rng.permutation(np.concatenate([frequent, near, rng.integers(0, 2**63, 5000).astype(np.uint64)]))
    endings, known = rng.integers(0, hmm.ENDINGS, len(words)).astype(np.uint16), rng.random(len(words)) < 0.8
    place = {int(w): i for i, w in enumerate(frequent)}
    want = [place.get(int(w), len(frequent) + int(e)) if k else len(model.mass) - 1 for w, e, k in zip(words, endings, known)]
    assert model.classes(words, endings, known).tolist() == want


def test_a_buffer_is_summed_once_and_words_keep_their_hashes_and_endings(monkeypatch):
    texts = pa.array(["The cat the END sat", "", None, "cat a of cat", "  Über\tsat  "])
    sums, calls = kernels.prefix_sums, []
    monkeypatch.setattr(kernels, "prefix_sums", lambda *a: calls.append(1) or sums(*a))
    (at, rows, n, words, ending, places), = hmm.fold(texts)
    assert len(calls) == 1
    monkeypatch.undo()

    def hashed(word):
        data = np.frombuffer(word.encode(), dtype=np.uint8)
        return int(kernels.span_hashes(data, np.array([0]), np.array([len(data)]))[0])
    spelt = [[re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in (t.as_py() or "").split()] + [None] for t in texts]
    assert (at, rows, n.tolist()) == (0, 5, [len(x) for x in spelt])
    want = [(int(hmm.END), 0) if w is None else (hashed(w), hashed(w.encode()[-3:].decode()) % hmm.ENDINGS) for x in spelt for w in x]
    assert [(int(words[p]), int(ending[p])) for p in places] == want and len(set(words.tolist())) == len(words) == 8


def test_word_counts_take_one_window_and_sort_by_word_alone(spark, docs_of):
    rows = [(k, f"common word{k % 5} only{k}") for k in range(40)]
    blocks = docs_of(rows).selectExpr("doc_id", "text", "doc_id % 4 != 0 as train").repartition(6).mapInArrow(
        hmm.token_batches, hmm.TOKEN_SCHEMA).localCheckpoint()
    counts = hmm.word_counts(blocks)
    plan = counts._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Window [") == 1 and "row_number" not in plan
    found = counts.collect()
    assert len(found) == len({(r.block, r.word) for r in found})
    first = [r for r in found if r.first]
    assert len(first) == len({r.word for r in found}) == 47
    want = Counter(w for k, t in rows if k % 4 for w in tokens(t))
    assert sorted(r.total for r in first if r.total) == sorted(want.values())
    assert all(len({r.total for r in found if r.word == w.word}) == 1 for w in first)


def test_recursions_run_along_states_and_equal_the_plain_ones():
    model, rng = small(3)
    factor, move, n = np.ascontiguousarray(model.factor.T), model.move, rng.integers(1, 30, 50)
    seq, begin, enter = rng.integers(0, 6, n.sum()), np.cumsum(n) - n, rng.dirichlet(np.ones(hmm.STATES), 50)
    out, total = hmm.last_states(factor, move, seq, begin, n, enter)
    products = hmm.transfers(factor, move, seq, begin, n)
    assert hmm.by_state(factor, seq).flags.c_contiguous and (hmm.by_state(factor, seq).T == factor[seq]).all()
    for i, k in enumerate(n):
        x, m, log = enter[i], np.eye(hmm.STATES), 0.0
        for t, c in enumerate(seq[begin[i]:begin[i] + k]):
            x, m = (x @ move if t else x) * factor[c], m @ move * factor[c]
            log, x, m = log + math.log10(x.sum()), x / x.sum(), m / m.sum()
        assert np.allclose(out[i], x) and total[i] == pytest.approx(log) and np.allclose(products[i], m)
