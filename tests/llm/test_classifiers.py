"""Quality and toxicity: parts against plain computations, held-out accuracy on the labelled tables."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.llm import op1_quality as Q
from zonecast.llm import op4_toxicity as X
from zonecast.llm import words as W
from zonecast.llm.frames import read

SF = "/root/testdata/sf0.01"
LABEL = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("toxic", T.IntegerType())])


def block(texts, kind):
    return kind(*W.flat(pa.array(texts, pa.string())))


# ---- operator 1 -------------------------------------------------------------------------------------------

def test_labellers_vote_on_their_kind_of_junk(words):
    names = [n for n, _, _ in Q.LABELLERS]
    clean = ". ".join(words.text(8).capitalize() for _ in range(10)) + "."
    junk = {"symbols": "%%% &&& ### " * 20, "capitals": clean.upper(), "stutter": " ".join(w + " " + w for w in clean.split()),
            "dominant_word": "same word same thing same " * 10, "bare_symbols": clean.replace(" ", " | "),
            "doubled_ends": clean.replace(" ", "!! "), "repeated_runs": (clean + " ") * 4, "sentence_form": words.text(60)}
    votes = block([clean, *junk.values(), "", "one"], Q.TextBlock).votes
    assert (votes[0] == Q.GOOD).all()
    for i, name in enumerate(junk, 1):
        assert votes[i][names.index(name)] == Q.BAD, name
    assert (votes[-2] == Q.ABSTAIN).all()


def test_expectation_maximisation_recovers_accuracies():
    rng = np.random.default_rng(1)
    n = 40_000
    truth = rng.random(n) < 0.8
    right = np.array([0.95, 0.9, 0.85, 0.8, 0.9, 0.7, 0.6, 0.9])
    votes = np.where(rng.random((n, 8)) < right, truth[:, None], ~truth[:, None]).astype(int)
    votes[rng.random((n, 8)) < 0.3] = Q.ABSTAIN
    patterns, counts = np.unique(votes @ 3 ** np.arange(8), return_counts=True)
    model = Q.expectation_maximisation(Q.unpack(patterns), counts.astype(float))
    assert abs(model.share_good - 0.8) < 0.02
    assert np.abs(model.chances[:, Q.GOOD, Q.GOOD] - right).max() < 0.03
    assert np.abs(model.chances[:, Q.BAD, Q.BAD] - right).max() < 0.05
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.95


def test_posterior_is_bayes_rule():
    model = Q.VoteModel(0.7, np.tile([[[0.9, 0.1, 1.0], [0.2, 0.8, 1.0]]], (8, 1, 1)))
    votes = np.array([[Q.GOOD, Q.BAD] + [Q.ABSTAIN] * 6])
    good, bad = 0.7 * 0.8 * 0.2, 0.3 * 0.1 * 0.9
    assert np.isclose(model.posterior(votes)[0], good / (good + bad))


def test_quality_agrees_with_labels_it_never_saw(spark):
    out = Q.classify(read(spark, SF, "documents")).join(read(spark, SF, "labels"), "doc_id").toPandas()
    assert (out["kept"] == (out["quality"] == 1)).mean() > 0.98
    assert out.loc[out["quality"] == 1, "kept"].mean() > 0.99


def test_quality_edge_cases(spark, docs, words):
    clean = [". ".join(words.text(9).capitalize() for _ in range(6)) + "." for _ in range(60)]
    junk = [words.text(40).replace(" ", "%%% ") for _ in range(20)]
    rows = list(enumerate(clean + junk)) + [(200, None), (201, ""), (202, " \n"), (None, clean[0]), (0, clean[0]), (203, words.text(20_000))]
    df = docs(rows).withColumn("score", F.lit("x")).withColumn("row", F.lit(1))
    out = Q.classify(df).collect()
    assert len(out) == len(rows)
    kept = {r.doc_id: r.kept for r in out}
    assert all(kept[i] for i in range(60)) and not any(kept[i] for i in range(60, 80)) and not any(kept[i] for i in (200, 201, 202))
    left = Q.keep_good(df)
    assert left.columns == df.columns
    assert left.count() == sum(r.kept for r in out)
    assert Q.classify(docs([])).count() == 0


# ---- operator 4 -------------------------------------------------------------------------------------------

def test_features_are_words_pairs_and_skip_grams():
    sets = list(block(["a b c d", "b c", "", "a b c d a b c d"], X.TextFeatures).sets())
    assert [len(s) for s in sets] == [4 + 3 + 2 + 1, 3, 0, 4 + 4 + 4 + 4]
    assert set(sets[1]) < set(sets[0])


def test_margins_are_sums_over_distinct_features(words):
    texts = [words.text(30) for _ in range(20)] + ["", "ka ka ka"]
    b = block(texts, X.TextFeatures)
    w = np.zeros(1 << X.FEATURE_BITS, np.float32)
    rng = np.random.default_rng(0)
    some = np.unique(np.concatenate(list(b.sets())))[::2]
    w[some] = rng.standard_normal(len(some))
    assert np.allclose(b.margins(w), [w[s].sum() for s in b.sets()], atol=1e-4)


def test_ftrl_one_step_by_hand():
    m = X.Ftrl(4, l1=0.1)
    m.learn(np.array([1, 2]), 1.0, 1.0)
    g, n = -0.5, 0.25
    want = -(g + 0.1) / ((X.BETA + n ** 0.5) / X.ALPHA + X.L2)
    assert np.allclose(m.weights(slice(None)), [0, want, want, 0])
    assert (X.Ftrl(4, 1.0).weights(slice(None)) == 0).all()


def test_l1_keeps_only_what_tells(words):
    rows = []
    rng = np.random.default_rng(2)
    for i in range(600):
        y = float(i % 4 == 0)
        ids = np.unique(np.concatenate([rng.integers(10, 3000, 40), [rng.integers(0, 3)] if y else []]).astype(int))
        rows.append((float(i), y, ids))
    w = X.trained(rows, 4)
    assert (w[:3] > 0.5).all() and np.count_nonzero(w) < 300


def test_best_bias_parts_the_classes():
    margin, y = np.array([0.0, 1.0, 2.0, 3.0]), np.array([0.0, 0.0, 1.0, 1.0])
    assert X.best_bias(margin, y) == pytest.approx(-1.5)


def test_held_out_toxicity(spark):
    """Ranking of rows whose labels were never read."""
    sf = "/root/testdata/sf0.1"
    out = (X.toxicity(read(spark, sf, "documents"), read(spark, sf, "labels")).where("held_out")
           .join(read(spark, sf, "labels").select("doc_id", "toxic"), "doc_id").toPandas())
    good, bad = out.loc[out["toxic"] == 0, "score"].to_numpy(), out.loc[out["toxic"] == 1, "score"].to_numpy()
    assert (bad[:, None] > good[None, :]).mean() > 0.95
    assert (out["predicted"] == out["toxic"]).mean() > 0.95


def test_toxicity_learns_words_and_keeps_the_fold_out(spark, docs, words):
    rows, labels = [], []
    for i in range(900):
        y = i % 6 == 0
        text = words.text(25).split()
        if y:
            text[words.pick(25)] = ("vilest", "rotten", "odious")[words.pick(3)]
        rows.append((i, " ".join(text)))
        held = zlib.crc32(str(i).encode()) % 5 == 0
        labels.append((i, int(y) if not held else int(not y)))  # wrong labels where none may be read
    rows += [(5000, None), (5001, ""), (None, "vilest"), (1, rows[1][1]), (5002, words.text(10_000))]
    labels += [(None, 1), (7777, 1), (2, None)]
    df = docs(rows).withColumn("score", F.lit("x")).withColumn("toxic", F.lit(1))
    out = X.toxicity(df, spark.createDataFrame(labels, LABEL)).collect()
    assert len(out) == len(rows)
    judged = [r for r in out if r.doc_id is not None and r.doc_id < 900]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in judged)
    right = np.mean([r.predicted == (r.doc_id % 6 == 0) for r in judged if r.held_out])
    assert right > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert next(r for r in out if r.doc_id == 5001).predicted == 0
    assert {r.predicted for r in out if r.doc_id is None} == {1}


def test_no_labels_and_no_documents(spark, docs):
    none = spark.createDataFrame([], LABEL)
    assert [r.predicted for r in X.toxicity(docs([(1, "a")]), none).collect()] == [0]
    assert X.toxicity(docs([]), none).count() == 0
