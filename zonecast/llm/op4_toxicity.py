"""Operator 4: toxicity scores by FTRL-proximal logistic regression.

Features of a text are the distinct hashed words, word pairs and skip-grams (two words with one or two between them). The
model is trained online in passes over labelled texts: each coordinate has its own learning rate, and the L1 term keeps
every weight whose gradients never add up at exactly zero, so the model is a short list of (bucket, weight) that is
broadcast. A text's score is the logistic of its weights' sum, with the bias and threshold that part the classes best on
the training rows.

Training uses labelled rows only, at most about ``train_rows`` of each class chosen by hash; scoring covers every document
and whole texts in one Arrow pass without a shuffle. Labels, language, source and ids are never features.

Defined results: a null or empty text, or one without words, has the score of the bias alone; labelled rows with a null
label or without a document are not used; every row of ``docs`` gives one row, repeated rows and null doc_ids included; with
no training rows of both classes every score is 0. Only doc_id, text and the labels' doc_id, toxic are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm import words as W

FEATURE_BITS = 20
TRAIN_ROWS = 6_000
ALPHA, BETA, L2 = 1.0, 1.0, 1e-3
#: The L1 term per square root of toxic training rows: a feature that means nothing collects gradients at that pace.
L1_PACE = 0.5
EPOCHS = 4
FOLDS = 3  # for the bias
SKIPS = (1, 2, 3)  # distance of the second word: neighbour, one between, two between


class TextFeatures:
    """Hashed feature buckets of a run of texts, all occurrences, per stream of one n-gram kind."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words = w = W.Words(data, offsets, W.ALNUM)
        text = np.repeat(np.arange(len(w.counts)), w.counts)
        shift = np.uint64(64 - FEATURE_BITS)
        found = [((w.hashes >> shift).astype(np.int32), text)]
        for d in SKIPS:
            pair = W.mix64(w.hashes[:-d] * W.RADIX + w.hashes[d:] + np.uint64(min(d, 2) * 0x5851F42D4C957F2D))
            inside = text[:-d] == text[d:]
            found.append(((pair[inside] >> shift).astype(np.int32), text[:-d][inside]))
        self.found = found
        self.n = len(w.counts)

    def sets(self) -> Iterator[np.ndarray]:
        """Distinct buckets of each text."""
        bounds = [np.searchsorted(t, np.arange(self.n + 1)) for _, t in self.found]
        for i in range(self.n):
            yield np.unique(np.concatenate([b[e[i]:e[i + 1]] for (b, _), e in zip(self.found, bounds, strict=True)]))

    def margins(self, weights: np.ndarray) -> np.ndarray:
        """Sum of the weights of each text's distinct buckets. Most weights are zero, so only hits are made distinct."""
        total = np.zeros(self.n)
        keys = []
        for buckets, text in self.found:
            hit = np.flatnonzero(weights[buckets])
            keys.append((text[hit].astype(np.int64) << FEATURE_BITS) | buckets[hit])
        keys = np.unique(np.concatenate(keys))
        np.add.at(total, keys >> FEATURE_BITS, weights[keys & ((1 << FEATURE_BITS) - 1)])
        return total


def _blocks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, TextFeatures]]:
    data, offsets = W.flat(batch.column(column))
    for a, b in W.slices(offsets, W.SEGMENT):
        base = offsets[a]
        yield a, b, TextFeatures(data[base:offsets[b]], offsets[a:b + 1] - base)


#: bias of a model without training rows of both labels: score 0
NO_MODEL = -30.0


class Ftrl:
    """FTRL-proximal with per-coordinate learning rates; coordinate 0..2**bits-1 and a bias without L1."""

    def __init__(self, size: int, l1: float):
        self.l1 = l1
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.z_bias = self.n_bias = 0.0

    def weights(self, ids: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[ids], self.n[ids]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def bias(self) -> float:
        return -self.z_bias / ((BETA + np.sqrt(self.n_bias)) / ALPHA + L2)

    def learn(self, ids: np.ndarray, y: float, weight: float) -> None:
        w, bias = self.weights(ids), self.bias()
        p = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -30, 30)))
        g = (p - y) * weight
        step = (np.sqrt(self.n[ids] + g * g) - np.sqrt(self.n[ids])) / ALPHA
        self.z[ids] += g - step * w
        self.n[ids] += g * g
        self.z_bias += g - (np.sqrt(self.n_bias + g * g) - np.sqrt(self.n_bias)) / ALPHA * bias
        self.n_bias += g * g


def trained(rows: list[tuple[float, float, np.ndarray]], epochs: int) -> np.ndarray:
    """Weights after a few passes over (draw, label, buckets)."""
    positive = sum(y for _, y, _ in rows)
    model = Ftrl(1 << FEATURE_BITS, L1_PACE * positive ** 0.5)
    weight = {1.0: max(1.0, (len(rows) / max(positive, 1) - 1) ** 0.5), 0.0: 1.0}
    for _ in range(epochs):
        for _, y, ids in rows:
            model.learn(ids, y, weight[y])
    return model.weights(slice(None))


def _train(epochs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            draw, label = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a, b, block in _blocks(batch, 2):
                rows += zip(draw[a:b], label[a:b].astype(float), block.sets(), strict=True)
        rows.sort(key=lambda r: (r[0], r[1], len(r[2])))
        positive = sum(y for _, y, _ in rows)
        w, bias = np.zeros(1 << FEATURE_BITS), NO_MODEL
        if 0 < positive < len(rows):
            w = trained(rows, epochs)
            # margins of rows that a model has not seen decide where score 0.5 lies
            unseen = np.zeros(len(rows))
            for k in range(FOLDS):
                part = trained([r for i, r in enumerate(rows) if i % FOLDS != k], epochs)
                for i in range(k, len(rows), FOLDS):
                    unseen[i] = part[rows[i][2]].sum()
            bias = best_bias(unseen, np.array([y for _, y, _ in rows]))
        used = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays(
            [pa.array([used.astype(np.int32)], pa.list_(pa.int32())), pa.array([w[used].astype(np.float32)], pa.list_(pa.float32())),
             pa.array([bias])], ["ids", "weights", "bias"])
    return run


def best_bias(margin: np.ndarray, y: np.ndarray) -> float:
    """Bias that puts score 0.5 at the cut of most correct training rows, in the middle of the gap there."""
    order = np.argsort(margin, kind="stable")
    m, y = margin[order], y[order]
    right = np.concatenate([[0], np.cumsum(1 - y)]) + (y.sum() - np.concatenate([[0], np.cumsum(y)]))
    between = np.concatenate([[True], m[1:] > m[:-1], [True]])
    at = int(np.argmax(np.where(between, right, -1)))
    low, high = m[max(at - 1, 0)], m[min(at, len(m) - 1)]
    return -float((low + high) / 2 if 0 < at < len(m) else low - 1 if at == 0 else high + 1)


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray, float]:
    """(buckets, weights, bias) from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    marked = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        "toxic in (0, 1) and doc_id is not null")
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1 << 30)) / float(1 << 30)
    sizes = marked.groupBy("toxic").agg(F.count("*").alias("n"))
    rates = {r["toxic"]: min(1.0, train_rows / r["n"]) for r in sizes.collect()}  # two rows
    chosen = (marked.withColumn("draw", draw)
              .where(F.col("draw") < F.when(F.col("toxic") == 1, rates.get(1, 0.0)).otherwise(rates.get(0, 0.0))).distinct())
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # labelled rows are bounded by 2 x train_rows in expectation: small enough to send to the documents
    sample = texts.join(F.broadcast(chosen), "doc_id")
    # one row per label, whatever the number of rows of its doc_id
    sample = sample.groupBy("doc_id", "draw", "toxic").agg(F.min("text").alias("text")).select("draw", "toxic", "text")
    # documents are read in parallel; only the bounded sample meets in one task
    model = sample.repartition(1).mapInArrow(_train(epochs), "ids array<int>, weights array<float>, bias double").first()
    if model is None:  # nothing was sampled: Spark runs no task then
        return np.zeros(0, np.int32), np.zeros(0, np.float32), NO_MODEL
    return np.array(model["ids"], np.int32), np.array(model["weights"], np.float32), float(model["bias"])


def score_texts(docs: DataFrame, ids: np.ndarray, weights: np.ndarray, bias: float) -> DataFrame:
    """One row per row of ``docs``: doc_id, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast((ids, weights, bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, weights, bias = shared.value
        dense = np.zeros(1 << FEATURE_BITS, np.float32)
        dense[ids] = weights
        for batch in batches:
            for a, b, block in _blocks(batch, 1):
                score = 1 / (1 + np.exp(-np.clip(block.margins(dense) + bias, -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                    ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id bigint, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``; labels of one fold of doc_ids are never learnt from."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("bigint").cast("string")), F.lit(folds))
    model = fit(docs, labels.where(fold != 0))
    return score_texts(docs, *model).select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", "predicted")
