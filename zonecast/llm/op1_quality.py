"""Operator 1: quality classifier from weak labels.

Eight heuristic labellers vote good, bad or abstain on each text (symbols, capitals, stuttering words, one dominant word,
bare symbols as words, doubled symbols at word ends, repeated word runs, sentence form). Expectation maximisation over the
counts of all vote patterns of the corpus (at most 3**8 rows, whatever the corpus) estimates each labeller's
accuracy per class and the share of good texts, without any given label. Posterior labels then train a hashed linear scorer
(logistic regression on hashed words, word shapes and repetition marks) that scores every text.

Counts and scores cover all documents and whole texts; the scorer alone is fitted on a sample of at most about
``train_rows`` texts per class, chosen by hash. The broadcast model is one vector of 2**16 weights.

Defined results: a text without words (null, empty, blank) has score 0 and is rejected; every row of ``docs`` gives one row,
repeated rows and null doc_ids included; only doc_id and text are read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm import words as W

GOOD, BAD, ABSTAIN = 1, 0, 2
FEATURE_BITS = 16
TRAIN_ROWS = 8_000
THRESHOLD = 0.5

# Labeller name, bad from this value on, good up to this value.
LABELLERS = (
    ("symbols", 0.08, 0.02),
    ("capitals", 0.40, 0.15),
    ("stutter", 0.15, 0.02),
    ("dominant_word", 0.20, 0.12),
    ("bare_symbols", 0.10, 0.01),
    ("doubled_ends", 0.10, 0.01),
    ("repeated_runs", 0.40, 0.15),
    ("sentence_form", 0.95, 0.50),
)
MIN_WORDS = 5  # fewer words carry no evidence for the labellers of repetition and form

_CLASS = np.full(256, ord("a"), np.uint8)  # letters, and bytes of non-ASCII characters
_CLASS[48:58] = ord("0")
_CLASS[65:91] = ord("A")
for _b in (*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)):
    _CLASS[_b] = _b
_ORDINARY = b".,;:'\"()-?!"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[b for b in (*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)) if b not in _ORDINARY]] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbouring entries of ``first``."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


class TextBlock:
    """Measures, votes and hashed features of a run of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words = w = W.Words(data, offsets, W.BLANKS)
        self.n = w.counts
        h, first = w.hashes, w.first
        inner = np.ones(len(h), bool)
        inner[first[:-1][self.n > 0]] = False  # words with a word before them in the same text
        self.again = np.zeros(len(h), bool)
        self.again[1:] = (h[1:] == h[:-1]) & inner[1:]
        last, before = data[w.ends - 1], data[np.maximum(w.ends - 2, 0)]
        long = w.ends - w.starts > 1
        self.doubled = long & (last == before) & _MARK[last] & (last != ord("."))
        letters = np.concatenate([[0], np.cumsum(~_MARK[data], dtype=np.int64)])
        bare = letters[w.ends] == letters[w.starts]

        top, repeated = np.zeros(len(self.n)), np.zeros(len(self.n))
        runs = W.ngram_hashes(h, 5)
        for i in np.flatnonzero(self.n >= MIN_WORDS):
            a, b = first[i], first[i + 1]
            top[i] = np.unique(h[a:b], return_counts=True)[1].max() / max(b - a, 20)
            repeated[i] = 1 - len(np.unique(runs[a:b - 4])) / (b - a - 4)
        ascii_letters = (data >= 65) & (data <= 90) | (data >= 97) & (data <= 122)
        visible = data > 32
        stops = np.isin(last, np.frombuffer(b".?!", np.uint8)) & ~self.doubled
        size = np.diff(offsets)
        measures = {
            "symbols": _share(_per_text(_SYMBOL[data], offsets), _per_text(visible, offsets)),
            "capitals": _share(_per_text((data >= 65) & (data <= 90), offsets), _per_text(ascii_letters, offsets)),
            "stutter": _share(_per_text(self.again, first), self.n),
            "dominant_word": top,
            "bare_symbols": _share(_per_text(bare, first), self.n),
            "doubled_ends": _share(_per_text(self.doubled, first), self.n),
            "repeated_runs": repeated,
            # bad near 1: hardly a sentence end among many words
            "sentence_form": 1 - np.minimum(_share(_per_text(stops, first), self.n) * 30, 1),
        }
        self.votes = np.stack([self._vote(name, measures[name], bad, good) for name, bad, good in LABELLERS], axis=1)
        self.votes[size == 0] = ABSTAIN

    def _vote(self, name: str, x: np.ndarray, bad: float, good: float) -> np.ndarray:
        vote = np.where(x >= bad, BAD, np.where(x <= good, GOOD, ABSTAIN)).astype(np.int8)
        few = self.n < (4 * MIN_WORDS if name == "sentence_form" else MIN_WORDS if name in (
            "dominant_word", "repeated_runs", "stutter") else 1)
        vote[few] = ABSTAIN
        return vote

    def patterns(self) -> np.ndarray:
        """Votes as one number in base 3."""
        return self.votes.astype(np.int64) @ (3 ** np.arange(len(LABELLERS)))

    def features(self, keep: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(buckets, values) of each text (to keep): unit vector over hashed words, word shapes and repetition marks."""
        w = self.words
        shape = self._shapes()
        salt = np.array([0x51, 0x52, 0x53, 0x54], np.uint64) * W.MIX_A
        marks = self.again.astype(np.uint64) + np.uint64(2) * self.doubled.astype(np.uint64)
        streams = np.stack([w.hashes ^ salt[0], shape ^ salt[1], W.mix64(shape + marks * W.RADIX) ^ salt[2]])
        buckets = (W.mix64(streams) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
        for i in range(len(self.n)) if keep is None else np.flatnonzero(keep):
            ids, n = np.unique(buckets[:, w.first[i]:w.first[i + 1]], return_counts=True)
            value = np.sqrt(n)
            yield ids, value / max(np.sqrt(n.sum()), 1)

    def _shapes(self) -> np.ndarray:
        """Hash of each word's character classes, equal neighbours folded."""
        w = self.words
        kind = _CLASS[w.data]
        fold = np.ones(len(kind), bool)
        fold[1:] = kind[1:] != kind[:-1]
        fold[w.starts] = True
        place = np.concatenate([[0], np.cumsum(fold)])
        return W.hash_spans(kind[fold], place[w.starts], place[w.ends])


def _blocks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, TextBlock]]:
    data, offsets = W.flat(batch.column(column))
    for a, b in W.slices(offsets, W.SEGMENT):
        base = offsets[a]
        yield a, b, TextBlock(data[base:offsets[b]], offsets[a:b + 1] - base)


@dataclass
class VoteModel:
    """Share of good texts and, per labeller and class, the chances of its votes. An abstention tells nothing (chance 1):
    whether a labeller can judge a text hangs on the text's length, not on its quality."""

    share_good: float
    chances: np.ndarray  # (labellers, 2 classes, 3 votes)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability that a text is good, per row of votes."""
        log = np.log(self.chances)
        at = np.arange(len(LABELLERS))
        good = np.log(self.share_good) + log[at[None, :], GOOD, votes].sum(axis=1)
        bad = np.log1p(-self.share_good) + log[at[None, :], BAD, votes].sum(axis=1)
        return 1 / (1 + np.exp(np.clip(bad - good, -700, 700)))


def expectation_maximisation(votes: np.ndarray, weight: np.ndarray, rounds: int = 100) -> VoteModel:
    """Fit to vote patterns with their counts; starts from the majority, so the classes keep their meaning."""
    ayes, noes = (votes == GOOD).sum(axis=1), (votes == BAD).sum(axis=1)
    q = np.clip((ayes - 2 * noes + 1) / (ayes + 2 * noes + 1) / 2 + 0.5, 0.02, 0.98)
    model = VoteModel(0.5, np.full((len(LABELLERS), 2, 3), 1 / 3))
    for _ in range(rounds):
        chances = np.zeros_like(model.chances)
        for vote in (BAD, GOOD):
            cast = votes == vote
            chances[:, GOOD, vote] = (cast * (weight * q)[:, None]).sum(axis=0)
            chances[:, BAD, vote] = (cast * (weight * (1 - q))[:, None]).sum(axis=0)
        chances += 1.0  # one vote of each kind, so that no chance is zero
        chances /= chances[:, :, :ABSTAIN].sum(axis=2, keepdims=True)
        chances[:, :, ABSTAIN] = 1.0
        share = float(np.clip((weight * q).sum() / max(weight.sum(), 1), 1e-4, 1 - 1e-4))
        model = VoteModel(share, chances)
        before, q = q, model.posterior(votes)
        if np.abs(before - q).max(initial=0) < 1e-9:
            break
    return model


def unpack(patterns: np.ndarray) -> np.ndarray:
    return (patterns[:, None] // 3 ** np.arange(len(LABELLERS))) % 3


def _count_patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(3 ** len(LABELLERS), np.int64)
    for batch in batches:
        for _, _, block in _blocks(batch, 0):
            total += np.bincount(block.patterns()[block.n > 0], minlength=len(total))
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["pattern", "n"])


def fit_votes(docs: DataFrame) -> tuple[VoteModel, float, float]:
    """Vote model of all texts, and how many are confidently good and bad."""
    counts = (docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_count_patterns, "pattern bigint, n bigint")
              .groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").toPandas())  # at most 6,561 rows
    votes, weight = unpack(counts["pattern"].to_numpy(np.int64)), counts["n"].to_numpy(float)
    model = expectation_maximisation(votes, weight)
    q = model.posterior(votes) if len(votes) else np.zeros(0)
    return model, float(weight[q >= 0.9].sum()), float(weight[q <= 0.1].sum())


def _training_rows(model: VoteModel, good_rate: float, bad_rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            draw = batch.column(0).to_numpy()
            for a, b, block in _blocks(batch, 1):
                q = model.posterior(block.votes)
                rate = np.where(q >= 0.9, good_rate, np.where(q <= 0.1, bad_rate, 0.0))
                keep = (draw[a:b] < rate) & (block.n > 0)
                rows = [(d, float(p), i.astype(np.int32), v.astype(np.float32))
                        for d, p, (i, v) in zip(draw[a:b][keep], q[keep], block.features(keep), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.float64()),
                     pa.array([r[2] for r in rows], pa.list_(pa.int32())), pa.array([r[3] for r in rows], pa.list_(pa.float32()))],
                    ["draw", "good", "ids", "vals"])
    return run


def _train(epochs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for draw, good, ids, vals in zip(*batch.columns, strict=True):
                rows.append((draw.as_py(), good.as_py(), ids.values.to_numpy(), vals.values.to_numpy()))
        rows.sort(key=lambda r: (r[0], r[1], len(r[2])))
        w, bias = np.zeros(1 << FEATURE_BITS), 0.0
        grad2, bias2 = np.full(1 << FEATURE_BITS, 1e-2), 1e-2
        classes = [max(sum(1 - r[1] for r in rows), 1.0), max(sum(r[1] for r in rows), 1.0)]
        for _ in range(epochs):
            for _, good, ids, vals in rows:
                p = 1 / (1 + np.exp(-np.clip(w[ids] @ vals + bias, -30, 30)))
                # both classes weigh the same
                g = (p - good) * len(rows) / 2 / (classes[1] * good + classes[0] * (1 - good))
                step = g * vals + 1e-6 * w[ids]
                grad2[ids] += step * step
                w[ids] -= 0.3 * step / np.sqrt(grad2[ids])
                bias2 += g * g
                bias -= 0.3 * g / np.sqrt(bias2)
        # score 0.5 goes to the middle of the gap that the margins of the two classes leave
        margins = [[w[r[2]] @ r[3] + bias for r in rows if (r[1] > 0.5) == good] for good in (False, True)]
        if all(margins):
            bias -= (np.quantile(margins[0], 0.995) + np.quantile(margins[1], 0.005)) / 2
        yield pa.RecordBatch.from_arrays([pa.array([w.astype(np.float32).tobytes()], pa.binary()), pa.array([float(bias)])], ["w", "bias"])
    return run


def _score(model: VoteModel, w: np.ndarray, bias: float, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, block in _blocks(batch, 1):
                margin = np.array([w[i] @ v for i, v in block.features()]) + bias
                score = np.where(block.n > 0, 1 / (1 + np.exp(-np.clip(margin, -30, 30))), 0.0)
                posterior = np.where(block.n > 0, model.posterior(block.votes), 0.0)
                rows = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), *[rows.column(i) for i in range(2, rows.num_columns)], pa.array(posterior),
                     pa.array(score), pa.array(score >= threshold)],
                    [rows.schema.names[0], *rows.schema.names[2:], "posterior", "score", "kept"])
    return run


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS, epochs: int = 8) -> tuple[VoteModel, np.ndarray, float]:
    """Vote model, weights and bias."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    model, n_good, n_bad = fit_votes(texts)
    rates = [min(1.0, train_rows / n) if n else 0.0 for n in (n_good, n_bad)]
    # one uniform draw per text by its hash, so that copies are drawn together
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    # features are made where the texts are read; the bounded sample alone meets in one task
    rows = (texts.select(draw.alias("draw"), "text").where(F.col("draw") < max(rates))
            .mapInArrow(_training_rows(model, *rates), "draw double, good double, ids array<int>, vals array<float>")
            .dropDuplicates(["draw"]))
    trained = rows.repartition(1).mapInArrow(_train(epochs), "w binary, bias double").first()
    return model, np.frombuffer(bytes(trained["w"]), np.float32).astype(np.float64), float(trained["bias"])


def classify(docs: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, posterior (of the vote model), score (of the scorer), kept."""
    scored = _fitted(docs, train_rows, threshold)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scored, "doc_id bigint, posterior double, score double, kept boolean")


def _fitted(docs: DataFrame, train_rows: int, threshold: float):
    model, w, bias = fit(docs, train_rows)
    shared = docs.sparkSession.sparkContext.broadcast(w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _score(model, shared.value, bias, threshold)(batches)

    return run


def keep_good(docs: DataFrame, train_rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the classifier keeps."""
    scored = _fitted(docs, train_rows, threshold)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("text").cast("string").alias("text"))
    kind = rows.select("row").schema.toDDL()
    return rows.mapInArrow(scored, f"{kind}, posterior double, score double, kept boolean").where("kept").select("row.*")
