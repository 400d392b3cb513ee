"""Work that is done once, and evenly, however large the input and whatever its files."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from zonecast.functions import constants as K
from zonecast.operators import metric_store as MS
from zonecast.operators import metrics as M
from zonecast.operators import model as MO
from zonecast.operators import silver as S
from zonecast.plans import models as PM
from zonecast.plans import streams as PS
from zonecast.session import materialize, work_dir
from zonecast.sources import fixtures as X
from zonecast.sources.schemas import SCHEMAS
from zonecast.streaming import live as LV


def test_a_fit_deals_the_rows_of_one_partition_over_all_cores(spark, monkeypatch):
    from pyspark.ml.regression import GBTRegressor

    whole, fit, seen = MO.build_pipeline, GBTRegressor.fit, []

    def small():
        pipeline = whole()
        pipeline.getStages()[-1].setMaxIter(2)
        return pipeline

    def watched(self, dataset, params=None):
        seen.append([len(p) for p in dataset.rdd.glom().collect()])
        return fit(self, dataset, params)

    monkeypatch.setattr(MO, "build_pipeline", small)
    monkeypatch.setattr(GBTRegressor, "fit", watched)
    rows = spark.range(0, 800, 1, 1).select(
        *[F.lit("unknown").alias(c) for c in K.CATEGORICAL_FEATURES], *[(F.col("id") % 7).cast("double").alias(c) for c in K.NUMERIC_FEATURES],
        (F.col("id") % 7 / 7 + 1).alias(K.TARGET))
    model = MO.fit(materialize(rows))
    cores = spark.sparkContext.defaultParallelism
    assert seen == [[800 // cores] * cores]
    assert MO.score(rows, model).count() == 800 and MO.feature_names(model, rows) == [*K.NUMERIC_FEATURES, *K.CATEGORICAL_FEATURES]


def test_tasks_of_a_fit_are_bounded_in_rows():
    assert [MO.fit_tasks(n, 12) for n in (0, 80_000, 12_000_000, 12_000_001, 30_000_000)] == [12, 12, 12, 24, 36]


def _counted(spark, frame, column):
    """The frame, and a count of how often a row of it was made."""
    made = spark.sparkContext.accumulator(0)

    def seen(value):
        made.add(1)
        return value

    return frame.withColumn(column, F.udf(seen, "double").asNondeterministic()(column)), made


def test_describe_makes_the_rides_once(spark, monkeypatch):
    values = [(float(i % 4001) / 7, 100.0 + i) for i in range(6000)]
    rides, made = _counted(spark, spark.createDataFrame(values, "surge_multiplier double, fare_base_inr double"), "surge_multiplier")
    monkeypatch.setattr(X, "rides_fine", lambda *_: rides)
    found = {r["measure"]: r for r in PM.surge_describe(spark, "").collect()}
    assert made.value == 6000
    assert found["surge_multiplier"]["p50"] == float(np.quantile([v for v, _ in values], 0.5))
    assert found["fare_share"]["n"] == 6000


def test_training_makes_its_rows_once(spark, monkeypatch):
    n = 2000
    at = spark.range(n).select(
        F.col("id").cast("string").alias("ride_id"), F.current_timestamp().alias("event_ts"), *[F.lit("unknown").alias(c) for c in K.CATEGORICAL_FEATURES],
        (F.col("id") % 5).cast("double").alias("distance_km"), (F.col("id") % 7).cast("double").alias("fare_base_inr"), F.lit(3).alias("event_hour"),
        (F.col("id") % 3 + 1).cast("double").alias(K.TARGET))
    rides, made = _counted(spark, at, "distance_km")
    monkeypatch.setattr(X, "rides", lambda *_: rides)
    train, test = PM.live_split(spark, "")
    assert train.count() + test.count() == n == train.unionByName(test).where("distance_km >= 0").count()
    assert made.value == n


def test_one_tasks_events_are_summed_to_what_a_zone_needs():
    rng = np.random.default_rng(3)
    n = 20_000
    at = rng.integers(0, 200, n) * 10_000_000 + 1_704_067_200_000_000
    events = pd.DataFrame({"city_zone": rng.choice(["cbd", "mall"], n), "event_micros": np.where(rng.random(n) < 0.01, np.nan, at.astype(float)),
                           "arrived": np.full(n, 1_800_000_000_000_000), "units": rng.integers(10_000, 35_000, n)})
    summed = pd.concat(LV._combined(iter([events[i:i + 1000].reset_index(drop=True) for i in range(0, n, 1000)])))
    assert len(summed) <= 2 * (31 + 1)
    assert list(LV._combined(iter([]))) == []
    for zone in ("cbd", "mall"):
        # the parts of several tasks, in any order, give what all events give
        parts = [pd.concat(LV._combined(iter([events[i::3].reset_index(drop=True)]))) for i in (2, 0, 1)]
        whole, merged = LV.ZoneWindow(), LV.ZoneWindow()
        whole.add(events[events["city_zone"] == zone])
        for part in parts:
            merged.add(part[part["city_zone"] == zone])
        assert merged.stored() == whole.stored() and merged.view(zone) == whole.view(zone)


def test_a_delivery_moves_its_own_files_alone(spark):
    root = work_dir(spark, "t-delivered")
    spark.range(30).select(F.col("id").cast("string").alias("value"), (F.col("id") % 3).alias("delivery")).write.partitionBy("delivery").text(f"{root}/staged")
    PS.delivered(spark, f"{root}/staged", 1, f"{root}/in")
    assert sorted(int(r[0]) for r in spark.read.text(f"{root}/in").collect()) == list(range(1, 30, 3))
    PS.delivered(spark, f"{root}/staged", 9, f"{root}/in")  # nothing came
    PS.delivered(spark, f"{root}/staged", 0, f"{root}/in")
    assert spark.read.text(f"{root}/in").count() == 20


def test_late_arrivals_are_made_once(spark, monkeypatch):
    """Only the deliveries: no stream is started."""
    made = []

    class Done:
        runId = None

        def awaitTermination(self):
            made.append(self)

    n = 400
    rides = spark.range(n).select(
        F.col("id").cast("string").alias("ride_id"), F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 30 + 1).cast("string"), 2, "0"), F.lit(" 08:00:00")).alias("event_timestamp"),
        F.lit(1.0).alias("distance_km"))
    rides, counted = _counted(spark, rides, "distance_km")
    monkeypatch.setattr(X, "rides_raw", lambda *_: rides)
    monkeypatch.setattr(PS.ST, "start_bronze", lambda *_a, **_k: Done())
    monkeypatch.setattr(PS.ST, "start_silver", lambda *_a, **_k: Done())
    there = []
    root = PS._chunked_silver(spark, "", "t-chunks", after=lambda at: there.append(spark.read.text(f"{at}/in").count()))
    days = [i % 30 + 1 for i in range(n) if i % 20]
    first = [sum(d < edge for d in days) for edge in (8, 16, 24)]
    assert there == [*first, len(days), n] and len(made) == 10
    assert counted.value == n
    assert "delivery" not in spark.read.text(f"{root}/in").first()[0]


def test_silver_writes_few_files_for_a_date(spark):
    """Rows of one date lie in all state partitions, yet few tasks write them; each row once, those without a time or an id too."""
    root = work_dir(spark, "t-by-date")
    n, partitions = 640, 32
    rows = spark.range(n).select(
        F.when(F.col("id") > 0, F.col("id").cast("string")).alias("ride_id"), F.lit("completed").alias("status"),
        F.when(F.col("id") % 64 != 5, F.concat(F.lit("2024-01-0"), (F.col("id") % 2 + 1).cast("string"), F.lit("T08:00:00+00:00"))).alias("event_timestamp"))
    full = rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in SCHEMAS["rides"].fields])
    full.unionByName(full.limit(100)).write.parquet(f"{root}/bronze")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        PS.ST.start_silver(spark, "rides", f"{root}/bronze", f"{root}/silver", f"{root}/chk").awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    silver = spark.read.parquet(f"{root}/silver")
    assert sorted(r[0] or "0" for r in silver.select("ride_id").collect()) == sorted(str(i) for i in range(n))
    files = (silver.select("event_date", F.input_file_name().alias("file")).groupBy("event_date")
             .agg(F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("rows")).collect())
    assert {str(r["event_date"]): r["rows"] for r in files} == {"None": 10, "2024-01-01": 320, "2024-01-02": 310}
    assert all(r["files"] <= 4 for r in files)
    # and not one task for a date
    assert all(r["files"] > 1 for r in files if r["rows"] > 100)


def test_rides_are_made_by_compiled_code(spark, tmp_path):
    """The JVM does not compile methods of more than 8,000 bytes of bytecode; it interprets them for every row."""
    spark.createDataFrame([(1, "2024-01-01 08:00:00", 7, "purchase", 10.0, '{"k": 3}')],
                          "event_id long, ts string, user_id long, event_type string, value double, props string").withColumn(
        "ts", F.col("ts").cast("timestamp")).write.parquet(f"{tmp_path}/events.parquet")
    rides = X.rides_bronze(spark, str(tmp_path))
    plan = rides.select(F.to_json(F.struct(*rides.columns)))._jdf.queryExecution().executedPlan()
    text = spark.sparkContext._jvm.org.apache.spark.sql.execution.debug.package.codegenString(plan)
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def _event_table(spark, path, *rows):
    spark.createDataFrame(list(rows), "event_id long, ts string, user_id long, event_type string, value double, props string").withColumn(
        "ts", F.col("ts").cast("timestamp")).write.parquet(f"{path}/events.parquet")


def test_live_deliveries_are_made_by_compiled_code(spark, tmp_path):
    """Each ride's text is read once, not once for every case of its delivery."""
    _event_table(spark, tmp_path, (1, "2024-01-01 08:00:00", 7, "purchase", 10.0, '{"k": 3}'), (97, "2024-01-02 08:00:00", 8, "view", 10.0, '{"k": 3}'),
                 (194, "2024-01-02 08:00:00", None, "view", 10.0, '{"k": 3}'), (2, "2024-01-30 08:00:00", 9, "view", None, None))
    dealt = PS.live_deliveries(S.enrich_rides(PS.rides_dense(spark, str(tmp_path))))
    found = {r["ride_id"]: r["delivery"] for r in dealt.collect()}
    assert found == {"1": 0, "97": zlib.crc32(b"8") % 4, "194": None, "2": 3}
    plan = dealt._jdf.queryExecution().executedPlan()
    text = spark.sparkContext._jvm.org.apache.spark.sql.execution.debug.package.codegenString(plan)
    assert max(int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text)) < 8000


def test_the_partitions_of_the_live_state_are_written_side_by_side(spark):
    """Not one after the other in one task: each view says which task made it."""
    def views(batches):
        from pyspark import TaskContext

        for batch in batches:
            yield batch.assign(ride_count=1 + TaskContext.get().partitionId())

    zones = spark.createDataFrame([(f"z{i}", 5_000_000 + i, True, 1, 10_000, [5_000_000 + i], [1]) for i in range(4)], LV.VIEW).repartitionByRange(4, "city_zone")
    root = work_dir(spark, "t-live-tasks")
    LV.LiveSink(f"{root}/metrics", f"{root}/zones", 0)(zones.mapInPandas(views, LV.VIEW), 0)
    rows = M.parse_payload(MS.read_metrics(spark, f"{root}/metrics", "1970-01-01 00:00:00")).collect()
    assert sorted(r["ride_count"] for r in rows if r["ride_count"]) == [1, 2, 3, 4]
    assert [r["count"] for r in rows if r["count"]] == [4]
