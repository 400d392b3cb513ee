"""The command-line jobs over real table paths (silver written from the fixtures)."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonecast import jobs as J
from zonecast.operators import gold as G
from zonecast.operators import metric_store as MS
from zonecast.operators import metrics as M
from zonecast.operators import published as P
from zonecast.session import work_dir
from zonecast.sources import fixtures as X

SF = "/root/testdata/sf0.001"


def _silver(spark):
    root = work_dir(spark, "t-jobs")
    X.rides(spark, SF).write.partitionBy("event_date").parquet(f"{root}/silver")
    return root


def test_gold_refresh_is_idempotent_and_quality_passes(spark):
    root = _silver(spark)
    assert J.gold_refresh(spark, f"{root}/silver", f"{root}/gold") == 0
    first = sorted(P.read_published(spark, f"{root}/gold").collect())
    assert J.gold_refresh(spark, f"{root}/silver", f"{root}/gold") == 0
    second = sorted(P.read_published(spark, f"{root}/gold").collect())
    assert first == second
    want = G.hourly_kpis(spark.read.parquet(f"{root}/silver"))
    assert len(second) == want.count()
    assert J.quality(spark, f"{root}/silver", f"{root}/gold", "2024-02-01 00:00:00") == 0


def test_quality_fails_on_empty_gold_and_bad_rows(spark):
    root = work_dir(spark, "t-jobs-bad")
    from zonecast.operators import silver as S

    S.silver_rides(X.rides_dirty(spark, SF)).write.parquet(f"{root}/silver")
    assert J.quality(spark, f"{root}/silver", f"{root}/no_gold", "2024-02-01 00:00:00") == 1


def test_dashboard_appends_and_newest_wins(spark):
    root = _silver(spark)
    assert J.dashboard(spark, f"{root}/silver", f"{root}/metrics") == 0
    assert J.dashboard(spark, f"{root}/silver", f"{root}/metrics") == 0
    table = M.parse_payload(MS.read_metrics(spark, f"{root}/metrics", "1970-01-01 00:00:00"))
    keys = [r["metric_key"] for r in table.collect()]
    assert len(keys) == len(set(keys)) and "dashboard:total_revenue" in keys


def test_train_promote_score(spark):
    from zonecast.operators import model as MO

    root = _silver(spark)
    at = {k: f"{root}/{k}" for k in ("runs", "models", "promoted", "predictions", "history", "trips")}
    X.trips(spark, SF).limit(800).write.parquet(at["trips"])
    assert J.load_history(spark, at["trips"], at["history"]) == 0
    rows = spark.read.parquet(at["history"]).count()
    assert J.load_history(spark, at["trips"], at["history"]) == 0 and spark.read.parquet(at["history"]).count() == rows
    assert J.retrain(spark, f"{root}/silver", at["runs"], at["models"]) == 0
    assert J.retrain_history(spark, at["history"], at["runs"], at["models"]) == 0
    runs = {r["model"]: r for r in spark.read.parquet(at["runs"]).collect()}
    assert set(runs) == {MO.LIVE_MODEL, MO.HIST_MODEL}
    decision = J.promote(spark, at["runs"], at["promoted"]).collect()[0]
    assert decision["promoted"] is True and decision["mae"] == min(r["mae"] for r in runs.values())
    promoted = spark.read.parquet(at["promoted"]).collect()
    assert [p["model_path"] for p in promoted] == [runs[decision["model"]]["model_path"]]
    assert J.score(spark, f"{root}/silver", at["promoted"], at["predictions"]) == 0
    preds = spark.read.parquet(at["predictions"])
    assert preds.count() == spark.read.parquet(f"{root}/silver").count()
    assert preds.filter(~F.col("predicted_surge_multiplier").between(1.0, 3.5)).count() == 0
    # names are those of the vector the model reads
    from zonecast.operators import features as FE

    model = MO.load_promoted(spark, at["promoted"])
    frame = FE.score_input(spark.read.parquet(f"{root}/silver"))
    assert MO.feature_names(model, frame) == ["distance_km", "fare_base_inr", "event_hour", "city_zone", "vehicle_type", "weather", "status"]
    assert len(model.stages[-1].featureImportances) == 7


def test_retention_job(spark):
    from zonecast.operators import tables as T

    path = work_dir(spark, "t-jobs-ret") + "/versions"
    v = X.versions(spark, SF)
    for n in range(5):
        T.append_version(spark, v.where(F.col("commit_version") == n).drop("commit_version", "committed_at"), path, "APPEND",
                         f"2024-01-0{n + 1} 00:00:00")
    before = spark.read.parquet(path)
    want = sorted(tuple(r) for r in T.retention_filter(before, "2024-01-06 00:00:00", 72, ["o_custkey"],
                                                       ["commit_version", "o_orderkey"]).select("o_orderkey", "commit_version").collect())
    T.apply_retention(spark, path, "2024-01-06 00:00:00", 72, ["o_custkey"], ["commit_version", "o_orderkey"])
    after = spark.read.parquet(path)
    assert sorted(tuple(r) for r in after.select("o_orderkey", "commit_version").collect()) == want
    assert 0 < len(want) < v.count()
    # the layout stays: one folder per commit, and no staging folder is left
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parent = fs.listStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getParent())
    assert sorted(f.getPath().getName() for f in parent) == ["versions", "versions.__horizon"]


def test_upsert_null_and_text_partitions_moved_keys_and_append(spark):
    import pytest

    from zonecast.operators import tables as T

    path = work_dir(spark, "t-upsert") + "/t"
    kind = "k string, part string, n int"
    make = lambda *rows: spark.createDataFrame(list(rows), kind)
    read = lambda: sorted((tuple(r) for r in spark.read.schema(kind).parquet(path).select("k", "part", "n").collect()), key=str)
    T.upsert_table(spark, make(("a", "007", 1), ("b", None, 2), ("c", None, 3), ("d", "7", 4)), path, ["k", "part"], ["part"])
    T.upsert_table(spark, make(("b", None, 20), ("a", "007", 10)), path, ["k", "part"], ["part"])
    assert read() == sorted([("a", "007", 10), ("b", None, 20), ("c", None, 3), ("d", "7", 4)], key=str)
    T.upsert_table(spark, make(("e", None, 5)), path, ["k", "part"], ["part"])  # only the null partition
    assert len(read()) == 5
    with pytest.raises(ValueError, match="among the keys"):
        T.upsert_table(spark, make(("a", "x", 1)), path, ["k"], ["part"])
    T.upsert_table(spark, make(("a", "007", 11)), path, ["k", "part"], ["part"], force_append=True)
    assert [r for r in read() if r[0] == "a"] == [("a", "007", 10), ("a", "007", 11)]


def test_gross_fare_keeps_large_and_fine_values(spark):
    from zonecast.functions import columns as C

    df = spark.createDataFrame([(1e8, 1.0), (100.0, 1.005), (2e9, 1500.0), (None, 2.0), (-1.51, 1.0), (float("nan"), 1.0)], "a double, b double")
    assert [r[0] for r in df.select(C.money_times("a", "b")).collect()] == [1e8, 100.5, 3e12, None, -1.51, None]
    half = spark.createDataFrame([(-151, 100), (151, 100), (-149, 100)], "n long, d long")
    assert [r[0] for r in half.select(C.half_up_ratio(F.col("n"), F.col("d"))).collect()] == [-2, 2, -1]


def test_retrain_history_logs_the_random_split_beside_the_candidates(spark, monkeypatch):
    from zonecast.operators import model as MO

    whole = MO.build_pipeline

    def small():
        pipeline = whole()
        pipeline.getStages()[-1].setMaxIter(2)
        return pipeline

    monkeypatch.setattr(MO, "build_pipeline", small)
    root = work_dir(spark, "t-jobs-history")
    at = {k: f"{root}/{k}" for k in ("runs", "models", "history", "trips", "promoted")}
    X.trips(spark, SF).limit(600).write.parquet(at["trips"])
    assert J.load_history(spark, at["trips"], at["history"]) == 0
    assert J.retrain_history(spark, at["history"], at["runs"], at["models"]) == 0
    runs, compared = (spark.read.parquet(p).collect() for p in (at["runs"], MO.comparison_path(at["runs"])))
    assert [r["model"] for r in runs] == [MO.HIST_MODEL]
    assert [r["model"] for r in compared] == [MO.HIST_MODEL + "_random_split"]
    rows = spark.read.parquet(at["history"])
    test = rows.where("cast(conv(substr(md5(concat(ride_id, ':42')), 1, 8), 16, 10) as bigint) % 1000000 >= 800000")
    assert compared[0]["n"] == test.where("surge_multiplier is not null").count()
    assert 0 <= compared[0]["mae"] <= compared[0]["rmse"]
