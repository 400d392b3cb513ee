"""Live view in keyed state, metric store, published upsert, retention horizon, side output, late counts, exact quantiles."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zonecast.operators import metric_store as MS
from zonecast.operators import metrics as M
from zonecast.operators import published as P
from zonecast.operators import quantiles as Q
from zonecast.operators import silver as S
from zonecast.operators import tables as T
from zonecast.plans.rolling import zone_rolling
from zonecast.session import work_dir
from zonecast.streaming import live as LV
from zonecast.streaming import streams as ST

RIDE = "ride_id string, event_ts timestamp, city_zone string, surge_multiplier double"
START = datetime(2024, 1, 1)


def files_below(spark, path):
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(root, True)
    names = []
    while found.hasNext():
        names.append(found.next().getPath().toString())
    return [n for n in names if n.endswith(".parquet")]


# ---------------------------------------------------------------- live view

EVENT = st.tuples(st.one_of(st.none(), st.integers(0, 900)), st.integers(0, 3))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(EVENT, max_size=8), max_size=6))
def test_zone_window_equals_a_list_of_events(batches):
    second = 1_000_000
    window = LV.ZoneWindow()
    timed, late, newest = [], [], None
    for i, batch in enumerate(batches):
        arrived = (10_000 + 100 * i) * second
        frame = pd.DataFrame({"event_micros": pd.array([None if t is None else t * second for t, _ in batch], "Int64"), "arrived": arrived,
                              "units": [u for _, u in batch]})
        frame["event_micros"] = frame["event_micros"].astype("float64")
        window = LV.ZoneWindow(window.stored())  # as state does between two batches
        window.add(frame)
        timed += [(t * second, u) for t, u in batch if t is not None]
        late += [(arrived, u) for t, u in batch if t is None]
        if timed:
            newest = max(t for t, _ in timed)
            want = [(t, u) for t, u in timed if t >= newest - LV.WINDOW_MICROS]
        elif late:
            newest = max(t for t, _ in late)
            want = [(t, u) for t, u in late if t >= newest - LV.WINDOW_MICROS]
        else:
            assert window.view("z") is None
            continue
        view = window.view("z")
        assert (view["at"], view["ride_count"], view["units"]) == (newest, len(want), sum(u for _, u in want))
        assert len(window.timed[0]) <= 301  # distinct seconds of the window, not events


def replay(spark, batches, **options):
    root = work_dir(spark, "t-live")
    for rows in batches:
        spark.createDataFrame(rows, RIDE).coalesce(1).write.mode("append").parquet(f"{root}/silver")
        for q in ST.start_live_view(spark, f"{root}/silver", f"{root}/metrics", f"{root}/chk", schema=RIDE, **options):
            q.awaitTermination()
    return f"{root}/metrics"


def test_one_event_without_a_time_loses_nothing(spark):
    at = lambda minutes: START + timedelta(minutes=minutes)
    batches = [[(f"a{i}{j}", at(i + j / 10), "cbd", 1.0 + j / 1000) for j in range(3)] for i in range(4)]
    batches[0].append(("x", None, "mall", 2.0))
    batches[1] += [("y", None, "cbd", 3.0), ("z", at(1.05), None, None)]
    path = replay(spark, batches)
    got = {r.metric_key: r for r in M.parse_payload(MS.read_metrics(spark, path, "1970-01-01 00:00:00")).collect()}
    rides = spark.createDataFrame([r for b in batches for r in b if r[1]], RIDE).fillna({"city_zone": "unknown", "surge_multiplier": 1.0})
    rolled = {(r.city_zone, r.event_ts): r for r in zone_rolling(rides).collect()}
    for zone, newest in (("cbd", at(3.2)), ("unknown", at(1.05))):
        want, live = rolled[zone, newest], got[f"live:zone:{zone}:demand"]
        assert (live.ride_count, live.surge_multiplier, live.written_at) == (want.zone_rides_5m, want.zone_avg_surge_5m, newest)
    assert got["live:zone:cbd:demand"].ride_count == 12
    assert got["live:rides_last_5min"]["count"] == 13  # not the two without a time: they arrived years later
    assert got["live:zone:mall:demand"].ride_count == 1  # a zone without any timed event: by arrival


def test_a_batch_that_runs_again_changes_nothing(spark):
    root = work_dir(spark, "t-live-again")
    sink = LV.LiveSink(f"{root}/metrics", f"{root}/zones", 0)
    view = lambda at, n: spark.createDataFrame([("cbd", at, True, n, n * 10000, [at], [n])], LV.VIEW)
    sink(view(5_000_000, 1), 0)
    sink(view(6_000_000, 2), 1)
    once = sorted(map(str, MS.stored_rows(spark, f"{root}/metrics", "1970-01-01 00:00:00").collect()))
    sink(view(6_000_000, 2), 1)
    assert sorted(map(str, MS.stored_rows(spark, f"{root}/metrics", "1970-01-01 00:00:00").collect())) == once


# ---------------------------------------------------------------- metric store

def test_many_batches_leave_few_files_and_expired_buckets_go(spark):
    path = work_dir(spark, "t-store") + "/metrics"
    for i in range(60):
        at = START + timedelta(seconds=30 * i)
        rows = [(k, f'{{"count": {i}}}', at, at + timedelta(seconds=ttl)) for k, ttl in (("a", 30), ("b", 900))]
        MS.write_metrics(spark.createDataFrame(rows, M.METRIC_SCHEMA), path, f"w{i}", i)
        if i % 10 == 9:
            MS.compact(spark, path, str(at), str(i))
    now = str(START + timedelta(seconds=30 * 59))
    assert len(files_below(spark, path)) <= 2 * 10  # buckets alive x batches between two compactions, at most
    got = {r.metric_key: (r.value, r.written_at) for r in MS.read_metrics(spark, path, now).collect()}
    assert got == {k: ('{"count": 59}', START + timedelta(seconds=30 * 59)) for k in "ab"}
    later = {r.metric_key for r in MS.read_metrics(spark, path, str(START + timedelta(seconds=30 * 59 + 31))).collect()}
    assert later == {"b"}
    MS.compact(spark, path, str(START + timedelta(days=1)), "end")
    assert files_below(spark, path) == []
    assert MS.read_metrics(spark, path + "-none", now).count() == 0


# ---------------------------------------------------------------- published upsert

KIND = "k string, part string, n int"


def published(spark, path, **options):
    return sorted((tuple(r) for r in P.read_published(spark, path, **options).collect()), key=str)


def test_published_upsert_null_and_text_partitions(spark):
    path = work_dir(spark, "t-pub") + "/t"
    make = lambda *rows: spark.createDataFrame(list(rows), KIND)
    P.publish_upsert(spark, make(("a", "007", 1), ("b", None, 2), ("c", None, 3), ("d", "7", 4), ("e", "", 5), ("f", "null", 6)), path, ["k", "part"], ["part"])
    P.publish_upsert(spark, make(("b", None, 20), ("a", "007", 10), ("g", None, 7)), path, ["k", "part"], ["part"])
    want = sorted([("a", "007", 10), ("b", None, 20), ("c", None, 3), ("d", "7", 4), ("e", "", 5), ("f", "null", 6), ("g", None, 7)], key=str)
    assert published(spark, path) == want
    assert len(published(spark, path, number=0)) == 6  # a reader of the version before
    live = P.pointer(spark, path)
    assert live["number"] == 1
    assert len(live["folders"]) == 5
    with pytest.raises(ValueError, match="among the keys"):
        P.publish_upsert(spark, make(("a", "x", 1)), path, ["k"], ["part"])
    with pytest.raises(ValueError, match="duplicate keys"):
        P.publish_upsert(spark, make(("a", "x", 1), ("a", "x", 2)), path, ["k", "part"], ["part"])
    assert published(spark, path) == want
    for n in range(4):
        P.publish_upsert(spark, make(("a", "007", n)), path, ["k", "part"], ["part"])
    assert len(files_below(spark, path)) <= 6  # two versions of the changed partition, one of the others
    with pytest.raises(FileNotFoundError):
        P.read_published(spark, path + "-none")


def test_an_upsert_that_fails_between_partitions_leaves_the_table(spark, monkeypatch):
    path = work_dir(spark, "t-pub-fail") + "/t"
    P.publish_upsert(spark, spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], KIND), path, ["k", "part"], ["part"])
    before = published(spark, path)
    change = spark.createDataFrame([("a", "x", 10), ("b", "y", 20)], KIND)
    # a row of the second partition fails while the first may be written already
    broken = change.withColumn("n", F.when(F.col("part") == "y", F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("n")))
    with pytest.raises(Exception, match="lost"):
        P.publish_upsert(spark, broken, path, ["k", "part"], ["part"])
    assert published(spark, path) == before
    publish = P._publish

    def interrupted(*args):
        raise RuntimeError("driver lost before the pointer")

    monkeypatch.setattr(P, "_publish", interrupted)
    with pytest.raises(RuntimeError, match="driver lost"):
        P.publish_upsert(spark, change, path, ["k", "part"], ["part"])
    assert published(spark, path) == before
    monkeypatch.setattr(P, "_publish", publish)
    P.publish_upsert(spark, change, path, ["k", "part"], ["part"])
    assert published(spark, path) == [("a", "x", 10), ("b", "y", 20)]
    with pytest.raises(RuntimeError, match="another writer"):
        P._publish(spark, path, P.pointer(spark, path))


# ---------------------------------------------------------------- retention horizon

def test_a_read_before_the_horizon_fails(spark):
    path = work_dir(spark, "t-horizon") + "/v"
    kind = "k int, v int"
    for n, rows in enumerate([[(1, 10), (2, 20)], [(1, 11)], [(2, 22)], [(1, 13)]]):
        T.append_version(spark, spark.createDataFrame(rows, kind), path, "APPEND", f"2024-01-0{n + 1} 00:00:00")
    read = lambda at: {r.k: r.v for r in T.read_as_of(spark, path, at, ["k"]).collect()}
    want = {at: read(at) for at in ("2024-01-03 00:00:00", "2024-01-03 12:00:00", "2024-01-09 00:00:00")}
    assert read("2024-01-01 12:00:00") == {1: 10, 2: 20}
    assert T.retention_horizon(spark, path) is None
    T.apply_retention(spark, path, "2024-01-04 00:00:00", 24, ["k"])
    assert T.retention_horizon(spark, path) == datetime(2024, 1, 3)
    assert {at: read(at) for at in want} == want
    with pytest.raises(ValueError, match="history before"):
        read("2024-01-02 12:00:00")
    T.apply_retention(spark, path, "2024-01-04 00:00:00", 72, ["k"])  # an older horizon does not bring rows back
    with pytest.raises(ValueError, match="history before"):
        read("2024-01-02 12:00:00")


# ---------------------------------------------------------------- side output, late rows

def test_ingest_keeps_every_document_once(spark):
    root = work_dir(spark, "t-ingest")
    from zonecast.sources import events as EV
    from zonecast.sources.schemas import SCHEMAS

    texts = ['{"ride_id": "1", "city_zone": "cbd"}', "{cut", "", "[1]", '{"ride_id": "2", "fare_base_inr": "x"}', '{"other": 1}', "null"]
    source = spark.createDataFrame([(t,) for t in texts], "value string")
    parsed = EV.decode_both(source, SCHEMAS["rides"])
    sink = ST.IngestSink(SCHEMAS["rides"], f"{root}/bronze", f"{root}/rejects")
    sink(parsed, 0)
    counts = lambda: (spark.read.parquet(f"{root}/bronze").count(), spark.read.parquet(f"{root}/rejects").count())
    assert counts() == (2, 5)
    names = files_below(spark, root)
    sink(parsed, 0)  # the batch runs again
    assert files_below(spark, root) == names
    T.delete_path(spark, f"{root}/rejects/batch=0/_SUCCESS")  # it had stopped between its sinks
    sink(parsed, 0)
    assert counts() == (2, 5)
    assert sorted(r.json_str for r in spark.read.parquet(f"{root}/rejects").collect()) == sorted(t for t in texts if "ride_id" not in t)


# ---------------------------------------------------------------- dedup, quantiles, ids

@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 3)), max_size=14))
def test_dedup_equals_ranking(spark, rows):
    frame = spark.createDataFrame([(None if k is None else str(k), None if t is None else START + timedelta(hours=t), v) for k, t, v in rows],
                                  "k string, event_timestamp timestamp, v int")
    got = sorted(map(str, (tuple(r) for r in S.dedup(frame, ["k"]).collect())))
    best = {}
    for k, t, v in rows:
        rank = (t is None, t if t is not None else 0, v)
        best[k] = min(best.get(k, rank), rank)
    want = sorted(str((None if k is None else str(k), None if r[0] else START + timedelta(hours=r[1]), r[2])) for k, r in best.items())
    assert got == want


def test_dedup_ranks_repeated_keys_only(spark):
    rows = spark.range(10_000).select(F.col("id").cast("string").alias("k"), F.current_timestamp().alias("event_timestamp"))
    S.dedup(rows.unionByName(rows.limit(3)), ["k"]).write.format("noop").mode("overwrite").save()
    plan = S.dedup(rows, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan
    assert "LeftAnti" in plan


@pytest.mark.parametrize("values", [[1.5], [2.0, 1.0], [0.1] * 3000, [float(i) ** 3 / 7 for i in range(5000)], [1e308, -1e308, 0.0, 5e-324] * 500,
                                    [10.0 ** (i % 300) for i in range(4000)]])
def test_quantiles_equal_sorting(spark, values):
    frame = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = Q.exact_quantiles(frame, "x", shares)
    ordered = sorted(values)
    for share, value in zip(shares, got, strict=True):
        at = share * (len(values) - 1)
        low, high = ordered[int(np.floor(at))], ordered[int(np.ceil(at))]
        assert value == pytest.approx(low + (high - low) * (at - int(at)), rel=1e-15) if np.isfinite(high - low) else low <= value <= high


def test_quantiles_of_nothing(spark):
    assert Q.exact_quantiles(spark.createDataFrame([], "x double"), "x", [0.5]) == [None]


def test_trip_ids_stay_the_same_in_every_load(spark):
    from zonecast.operators import history as H
    from zonecast.sources import fixtures as X

    path = work_dir(spark, "t-ids") + "/trips"
    X.trips(spark, "/root/testdata/sf0.001").limit(500).repartition(3).write.parquet(path)
    ids = lambda: sorted(r.ride_id for r in H.historical_silver(H.with_row_ids(spark.read.parquet(path))).collect())
    first = ids()
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        assert ids() == first
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert len(set(first)) == len(first)
