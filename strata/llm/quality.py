"""Quality classifier: hashed word n-gram logistic regression, trained with
follow-the-regularised-leader updates and scored as sparse dot products.

The model is fitted in one task on a bounded sample of labelled rows
(``SAMPLE_ROWS``); its weights (a quarter million floats at most) go to
every scoring task.  Scoring reads each whole text once, without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import kernels, ngrams
from strata.llm.tables import crc_remainder

SAMPLE_ROWS = 12_000   # most labelled rows the model is fitted on
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.3, 1.0
THRESHOLD = 0.3
NO_TEXT = 0.5          # score when there is nothing to learn from


class FollowTheLeader:
    """FTRL-proximal logistic regression on binary features; the last weight is the intercept."""

    def __init__(self, size: int = ngrams.SIZE):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def update(self, at: np.ndarray, y: float) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
        g = p - y
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def rows_of(texts: pa.Array):
    """Buckets of the word n-grams of each text, in order."""
    for _, data, offsets in kernels.slices(texts):
        bucket, row = ngrams.word_ngrams(data, offsets)
        cut = np.searchsorted(row, np.arange(len(offsets)))
        for i in range(len(offsets) - 1):
            yield bucket[cut[i]:cut[i + 1]]


def fit_rows(table: pa.Table) -> pa.Table:
    table = table.sort_by([("pick", "ascending"), ("text", "ascending")])
    features, y = list(rows_of(table["text"])), table["y"].to_numpy()
    model, bias = FollowTheLeader(), np.array([ngrams.SIZE])
    for epoch in range(EPOCHS):
        order = np.random.default_rng(epoch).permutation(len(y))
        for i in order:
            model.update(np.concatenate([features[i], bias]), y[i])
    w = model.weights()
    used = np.flatnonzero(w)
    return pa.table({"bucket": pa.array(used, pa.int32()), "weight": pa.array(w[used], pa.float64())})


def fit(sample: DataFrame) -> np.ndarray:
    """Weights by bucket, the intercept last; zeros for an empty sample."""
    fitted = sample.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(fit_rows, "bucket int, weight double").collect()
    w = np.zeros(ngrams.SIZE + 1)
    for r in fitted:   # at most one row per bucket
        w[r.bucket] = r.weight
    return w


def quality_score(text: Column, weights: np.ndarray) -> Column:
    """Probability that a text is of label 1; a text without words scores by the intercept alone."""
    w = weights.astype(np.float64)

    @F.arrow_udf(T.DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        out = np.full(len(texts), w[-1])
        for at, data, offsets in kernels.slices(texts):
            bucket, row = ngrams.word_ngrams(data, offsets)
            out[at:at + len(offsets) - 1] += np.bincount(row, weights=w[bucket], minlength=len(offsets) - 1)
        return pa.array(1 / (1 + np.exp(-np.clip(out, -35, 35))))
    return scored(text)


def train(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0, rows: int = SAMPLE_ROWS) -> np.ndarray:
    return fit(ngrams.labelled_sample(docs, labels, "quality", modulus, held, rows))


def score_quality(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id, score, predicted`` for every row; null text is an empty text."""
    return (docs.select("doc_id", quality_score(F.col("text"), weights).alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def keep_good(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns."""
    return docs.filter(quality_score(F.col("text"), weights) >= THRESHOLD)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of a model trained without the held-out remainder, for all rows."""
    scored = score_quality(docs, train(docs, labels))
    return scored.withColumn("held_out", F.coalesce(crc_remainder("doc_id", 5) == 0, F.lit(False)))
