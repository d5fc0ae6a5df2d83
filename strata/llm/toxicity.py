"""Toxicity: a linear classifier on character n-grams whose features are
scaled by naive Bayes log-count ratios.

On a bounded sample of labelled rows (``SAMPLE_ROWS``), tasks count in how
many toxic and other texts each hashed n-gram occurs.  The log ratio of the
smoothed counts scales the n-gram; those whose counts differ clearly between
the classes (``MOST_FEATURES`` at most) enter a logistic regression on the
scaled, binary features.  Scoring reads each whole text once, without a
shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import kernels, ngrams
from strata.llm.tables import crc_remainder, materialize

SAMPLE_ROWS = 16_000    # most labelled rows the model is fitted on
SAMPLE_TASKS = 16       # tasks that read the sample
MOST_FEATURES = 1 << 13
SMOOTHING = 1.0
LEAST_Z = 4.0           # by how many standard errors the counts of a feature must differ
ROUNDS, RATE, RIDGE = 80, 0.5, 1e-3
THRESHOLD = 0.3
BLOCK = 4096            # features per row when counts are gathered


def count_features(batches):
    """Per task, the number of texts of either label with each feature, in blocks."""
    counts, rows = np.zeros((2, ngrams.SIZE), dtype=np.int64), np.zeros(2, dtype=np.int64)
    for batch in batches:
        y = batch.column("y").to_numpy(zero_copy_only=False).astype(np.int64)
        rows += np.bincount(y, minlength=2)
        for at, data, offsets in kernels.slices(batch.column("text")):
            bucket, row = ngrams.char_ngrams(data, offsets)
            label = y[at:at + len(offsets) - 1][row]
            for k in (0, 1):
                counts[k] += np.bincount(bucket[label == k], minlength=ngrams.SIZE)
    if rows.sum():
        parts = range(0, ngrams.SIZE, BLOCK)
        yield pa.RecordBatch.from_pydict({
            "block": pa.array([p // BLOCK for p in parts], pa.int32()),
            "other": pa.array([counts[0, p:p + BLOCK] for p in parts], pa.list_(pa.int64())),
            "toxic": pa.array([counts[1, p:p + BLOCK] for p in parts], pa.list_(pa.int64())),
            "rows": pa.array([rows] * len(parts), pa.list_(pa.int64()))})


def ratios(table: pa.Table) -> pa.Table:
    """Log-count ratio and significance of the features of one block, summed over the tasks."""
    total = {k: np.sum([np.asarray(x) for x in table[k].to_pylist()], axis=0) for k in ("other", "toxic", "rows")}
    q, p = (total["other"] + SMOOTHING) / (total["rows"][0] + 2 * SMOOTHING), (total["toxic"] + SMOOTHING) / (total["rows"][1] + 2 * SMOOTHING)
    both = (total["other"] + total["toxic"] + SMOOTHING) / (total["rows"].sum() + 2 * SMOOTHING)
    z = np.abs(p - q) / np.sqrt(both * (1 - both) * (1 / max(1, total["rows"][0]) + 1 / max(1, total["rows"][1])) + 1e-12)
    at = np.flatnonzero(z >= LEAST_Z)
    return pa.table({"bucket": pa.array(at + table["block"][0].as_py() * BLOCK, pa.int32()),
                     "ratio": np.log(p / q)[at], "z": z[at]})


def selected_rows(active: np.ndarray):
    def rows(batches):
        for batch in batches:
            out = []
            for _, data, offsets in kernels.slices(batch.column("text")):
                bucket, row = ngrams.char_ngrams(data, offsets, active=active)
                cut = np.searchsorted(row, np.arange(len(offsets)))
                out += [bucket[a:b] for a, b in zip(cut, cut[1:])]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("y"), batch.column("pick"), pa.array(out, pa.list_(pa.int32()))], names=["y", "pick", "at"])
    return rows


def regression(scale: np.ndarray):
    """Logistic regression by full gradients with momentum on binary features times ``scale``."""
    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("pick", "ascending"), ("y", "ascending")])
        y = table["y"].to_numpy()
        lists = table["at"].combine_chunks()
        row = np.repeat(np.arange(len(y)), lists.value_lengths().to_numpy(zero_copy_only=False))
        ids, col = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        x = scale[ids][col]
        w, speed, bias, lift = np.zeros(len(ids)), np.zeros(len(ids)), np.log((y.sum() + 1) / (len(y) - y.sum() + 1)), 0.0
        step = RATE / (1 + np.bincount(row, weights=x * x, minlength=len(y)).mean())
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-np.clip(np.bincount(row, weights=w[col] * x, minlength=len(y)) + bias, -35, 35)))
            g = (p - y) / len(y)
            speed = 0.9 * speed - step * 10 * (np.bincount(col, weights=g[row] * x, minlength=len(ids)) + RIDGE * w)
            lift = 0.9 * lift - step * 10 * g.sum()
            w, bias = w + speed, bias + lift
        return pa.table({"bucket": pa.array(np.concatenate([ids, [ngrams.SIZE]]), pa.int32()),
                         "weight": np.concatenate([w * scale[ids], [bias]])})
    return fit


def train(docs: DataFrame, labels: DataFrame, modulus: int = 4, held: int = 2, rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Weights by bucket, the intercept last; zeros when nothing is labelled."""
    sample = materialize(ngrams.labelled_sample(docs, labels, "toxic", modulus, held, rows)
                         .repartition(SAMPLE_TASKS, "pick"))
    named = (sample.mapInArrow(count_features, "block int, other array<long>, toxic array<long>, rows array<long>")
             .groupBy("block").applyInArrow(ratios, "bucket int, ratio double, z double"))
    scale = np.zeros(ngrams.SIZE + 1)
    for r in named.orderBy(F.desc("z"), "bucket").limit(MOST_FEATURES).collect():
        scale[r.bucket] = r.ratio
    fitted = (sample.mapInArrow(selected_rows(scale[:-1] != 0), "y double, pick long, at array<int>")
              .withColumn("all", F.lit(0)).groupBy("all").applyInArrow(regression(scale), "bucket int, weight double").collect())
    w = np.zeros(ngrams.SIZE + 1)
    for r in fitted:   # at most MOST_FEATURES rows
        w[r.bucket] = r.weight
    return w


def toxicity_score(text: Column, weights: np.ndarray) -> Column:
    """Probability that a text is toxic; an empty text scores by the intercept and its two edge spaces."""
    w, active = weights.astype(np.float64), weights[:-1] != 0

    @F.arrow_udf(T.DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        out = np.full(len(texts), w[-1])
        for at, data, offsets in kernels.slices(texts):
            bucket, row = ngrams.char_ngrams(data, offsets, active=active)
            out[at:at + len(offsets) - 1] += np.bincount(row, weights=w[bucket], minlength=len(offsets) - 1)
        return pa.array(1 / (1 + np.exp(-np.clip(out, -35, 35))))
    return scored(text)


def score_toxicity(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id, score, predicted`` for every row; null text is an empty text."""
    return (docs.select("doc_id", toxicity_score(F.col("text"), weights).alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of a model trained without the held-out remainder, for all rows."""
    scored = score_toxicity(docs, train(docs, labels))
    return scored.withColumn("held_out", F.coalesce(crc_remainder("doc_id", 4) == 2, F.lit(False)))
