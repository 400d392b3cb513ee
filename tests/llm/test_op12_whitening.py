"""Whitening against numpy on the whole matrix."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonecast.llm.op12_whitening import SCHEMA, whiten

KIND = "vec_id bigint, embedding array<float>"


def brute_force(rows, components=8):
    """{row number: (deviation, whitened)}, shares of variance."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in rows], dtype=object)
    n, total = len(x), x.sum(0)
    deviation = ((n * x - total) ** 2).sum(1)
    z = ((n * x - total) / n).astype(float)
    cov = z.T @ z / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return deviation, z @ vectors / np.sqrt(values), values / np.trace(cov)


def table(frame, k):
    got = {}
    for r in frame.collect():
        got.setdefault(r.vec_id, {})[r.component] = r
    assert all(sorted(v) == list(range(1, k + 1)) for v in got.values())
    return got


@pytest.mark.parametrize(("n", "d", "block"), [(300, 12, 16), (40, 5, 1024), (9, 3, 2)])
def test_equals_the_whole_matrix(spark, n, d, block):
    rng = np.random.default_rng(n)
    data = rng.normal(size=(n, d)) @ rng.normal(size=(d, d))
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(data)]
    got = table(whiten(spark.createDataFrame(rows, KIND).repartition(3), rows_per_block=block), min(8, d))
    deviation, whitened, explained = brute_force(rows)
    k = min(8, d)
    mine = np.array([[got[i][c].whitened for c in range(1, k + 1)] for i in range(n)])
    sign = np.sign((mine * whitened).sum(0))
    assert np.abs(mine * sign - whitened).max() < 1e-9
    assert [got[i][1].deviation for i in range(n)] == deviation.tolist()
    assert np.allclose([got[0][c].explained for c in range(1, k + 1)], explained, rtol=1e-9)
    assert got[0][1].identity_error < 1e-9
    assert got[0][1].n == n


def test_rows_without_a_vector_ties_and_other_lengths(spark):
    rng = np.random.default_rng(5)
    good = [(i, [float(np.float32(c)) for c in rng.normal(size=4)]) for i in range(30)]
    odd = [(100, None), (101, []), (102, [1.0, None, 0.0, 1.0]), (103, [math.nan] * 4), (104, [math.inf, 0.0, 0.0, 0.0]), (105, [1.0, 2.0])]
    more = [good[0], (None, good[1][1])]
    frame = spark.createDataFrame(good + odd + more, KIND).withColumn("index", F.lit("x")).withColumn("component", F.lit(None)).withColumn("part", F.lit(1))
    got = whiten(frame).collect()
    assert len(got) == 4 * 32
    assert {r.vec_id for r in got} == {None, *range(30)}
    deviation, whitened, _ = brute_force(good + more)
    same = [r for r in got if r.vec_id == 0 and r.component == 1]
    assert len(same) == 2
    assert same[0].whitened == same[1].whitened
    assert abs(abs(same[0].whitened) - abs(whitened[0, 0])) < 1e-9
    assert {r.deviation for r in same} == {deviation[0]}


def test_without_variance(spark):
    for rows in ([(1, [1.0, 2.0, 3.0])], [(i, [1.0, 2.0, 3.0]) for i in range(4)]):
        got = whiten(spark.createDataFrame(rows, KIND)).collect()
        assert len(got) == 3 * len(rows)
        assert {(r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(0, 0.0, 0.0, 1.0)}
    flat = whiten(spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(6)], KIND)).collect()
    assert {r.whitened for r in flat if r.component == 2} == {0.0}
    assert abs(next(r.explained for r in flat if r.component == 1) - 1) < 1e-9


def test_no_rows_and_huge_entries(spark):
    empty = whiten(spark.createDataFrame([], KIND))
    assert empty.count() == 0
    assert empty.schema.simpleString() == spark.createDataFrame([], SCHEMA).schema.simpleString()
    got = whiten(spark.createDataFrame([(1, [3.0e15, 0.0]), (2, [0.0, 1.0])], "vec_id bigint, embedding array<double>")).collect()
    assert [r.deviation for r in got] == [None] * 4
