"""Boosted trees over cells: Spark's own trees, whatever the partitions, in few jobs."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from zonecast.functions import constants as K
from zonecast.operators import boosting as B
from zonecast.operators import model as MO
from zonecast.session import materialize


def rides(spark, n, seed=3):
    rng = np.random.default_rng(seed)
    zones = rng.choice([*MO.MODEL_VOCAB["city_zone"][:6], "elsewhere"], n)
    rows = [(str(z), str(v), str(w), "completed", float(d), float(f), int(h), round(float(1 + d / 20 + (z < "m") * 0.5 + np.sin(f) / 3 + h / 50 + e), 2))
            for z, v, w, d, f, h, e in zip(zones, rng.choice(K.VEHICLE_TYPES, n), rng.choice(K.WEATHER_STATES, n), rng.integers(0, 20, n),
                                           rng.integers(0, 30, n), rng.integers(0, 24, n), rng.random(n) * 0.3, strict=True)]
    return spark.createDataFrame(rows, ", ".join([*[f"{c} string" for c in K.CATEGORICAL_FEATURES], "distance_km double, fare_base_inr double",
                                                  "event_hour int", f"{K.TARGET} double"]))


def few(monkeypatch, **params):
    """The pipeline with other parameters of its trees."""
    whole = MO.build_pipeline

    def small():
        pipeline = whole()
        pipeline.getStages()[-1].setParams(**params)
        return pipeline

    monkeypatch.setattr(MO, "build_pipeline", small)


def text(model):
    return [t.toDebugString.split("\n", 1)[1] for t in model.stages[-1].trees]


def test_all_rows_and_features_give_the_predictions_of_sparks_own_trees(spark, monkeypatch):
    params = dict(maxIter=6, maxDepth=4, subsamplingRate=1.0, featureSubsetStrategy="all")
    few(monkeypatch, **params)
    rows = materialize(rides(spark, 1500))
    model = MO.fit(rows)
    *prepare, _ = model.stages
    vectors = PipelineModel(prepare).transform(rows)
    own = GBTRegressor(labelCol=K.TARGET, predictionCol="own", stepSize=0.1, **params).fit(vectors)
    both = model.transform(rows).select("features", "raw_prediction")
    assert own.transform(both).where(F.abs(F.col("own") - F.col("raw_prediction")) > 1e-9).count() == 0
    trees = model.stages[-1]
    assert np.allclose(trees.featureImportances.toArray(), own.featureImportances.toArray())
    assert trees.treeWeights == own.treeWeights and trees.totalNumNodes == own.totalNumNodes


def test_a_model_does_not_depend_on_the_partitions(spark, monkeypatch):
    few(monkeypatch, maxIter=4)
    rows = materialize(rides(spark, 2000))
    model = MO.fit(rows.coalesce(1))
    assert text(model) == text(MO.fit(rows.repartition(5, "distance_km")))
    # the row sample leaves out about a fifth
    root = model.stages[-1].trees[0]._java_obj.rootNode()
    assert 0.75 < root.impurityStats().count() / 2000 < 0.85


def test_a_fit_of_many_trees_takes_few_jobs(spark, monkeypatch):
    few(monkeypatch, maxIter=30)
    rows = materialize(rides(spark, 1000))
    spark.sparkContext.setJobGroup("t-fit", "")
    try:
        MO.fit(rows)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("t-fit")) < 40
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_cells_in_their_blocks_give_the_same_trees(spark, monkeypatch):
    few(monkeypatch, maxIter=5, checkpointInterval=2)
    monkeypatch.setattr(B, "BLOCK_ROWS", 400)
    rows = materialize(rides(spark, 2000))
    here = MO.fit(rows)
    monkeypatch.setattr(B, "SUMS_BYTES", 1)  # a job for each tree's samples
    single = MO.fit(rows)
    monkeypatch.setattr(B, "CELLS_HERE", 0)
    spread = MO.fit(rows)
    assert text(here) == text(single)
    a, b = ([r[0] for r in m.transform(rows).select("raw_prediction").collect()] for m in (here, spread))
    assert np.allclose(a, b)


def test_rows_of_one_cell_and_label_are_sampled_one_by_one():
    arrays = (np.array([5, 9]), np.array([0, 2]), np.array([1.0, 2.0, 4.0]), np.array([100_000, 1, 50_000]))
    counts = B.Counts([np.asarray(x).tobytes() for x in arrays])
    n, s, q = counts.sample([1, 2, 3], 0.8)
    assert abs(n[0] / 100_001 - 0.8) < 0.01 and abs(n[1] / 50_000 - 0.8) < 0.02 and s[1] == 4 * n[1] and q[1] == 16 * n[1]
    assert [x.tolist() for x in counts.sample([1, 2, 3], 1.0)] == [[100_001, 50_000], [100_002, 200_000], [100_004, 800_000]]


def test_thresholds_lie_between_values_with_equal_weight():
    assert B.thresholds(np.array([1.0, 2.0, 4.0]), np.array([5, 1, 1]), 31).tolist() == [1.5, 3.0]
    assert B.thresholds(np.zeros(0), np.zeros(0), 31).tolist() == [] == B.thresholds(np.ones(1), np.ones(1), 31).tolist()
    cuts = B.thresholds(np.arange(320.0), np.ones(320), 31)
    assert len(cuts) == 31 and np.diff(cuts).tolist() == [10.0] * 30
    # a value and NaN: below its threshold, and above all
    assert B.cell_numbers(np.array([[1.5, 2], [1.6, 0], [np.nan, 3]]), [np.array([1.5, 3.0]), 4], 5).tolist() == [2 << 5, 1, 2 + (3 << 5)]


@pytest.mark.parametrize("column, said", [(K.TARGET, "a label is null"), ("distance_km", "a feature is NaN")])
def test_a_null_label_or_feature_is_refused(spark, column, said):
    """As Spark's own fit does."""
    rows = rides(spark, 50).withColumn(column, F.when(F.col("event_hour") > 3, F.col(column)))
    with pytest.raises(Exception, match=said):
        MO.fit(materialize(rows))
