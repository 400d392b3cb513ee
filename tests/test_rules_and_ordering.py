"""Surge rule, quality rules, rolling windows and splits against brute force."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zonecast.functions import columns as C
from zonecast.functions import constants as K
from zonecast.operators import ordered as O
from zonecast.operators import quality as Q
from zonecast.operators import splits as SP


def _rule(zone: str, hour: int, weather: str) -> float:
    if K.PEAK_HOURS_MORNING[0] <= hour <= K.PEAK_HOURS_MORNING[1] or \
            K.PEAK_HOURS_EVENING[0] <= hour <= K.PEAK_HOURS_EVENING[1]:
        base = Decimal(str(K.PEAK_DEMAND))
    elif K.NIGHT_HOURS[0] <= hour <= K.NIGHT_HOURS[1]:
        base = Decimal(str(K.NIGHT_DEMAND))
    else:
        base = Decimal(str(K.NORMAL_DEMAND))
    factor = Decimal(str(dict((z[0], z[3]) for z in K.ZONES)[zone]))
    raw = base * Decimal(str(K.WEATHER_DEMAND[weather])) * factor / 2
    raw = min(max(raw, Decimal("1.0")), Decimal("3.5"))
    return float(raw.quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_surge_rule_all_points(spark):
    grid = [(z[0], h, w) for z in K.ZONES for h in range(24) for w in K.WEATHER_STATES]
    df = spark.createDataFrame(grid, "zone string, hour int, weather string")
    got = {(r[0], r[1], r[2]): r[3] for r in df.select("*", C.surge_rule("zone", "hour", "weather")).collect()}
    assert len(got) == 360
    for key, value in got.items():
        assert value == _rule(*key), key
        assert K.SURGE_MIN <= value <= K.SURGE_MAX


def test_surge_rule_unknown_is_null(spark):
    df = spark.createDataFrame([("moon", 8, "clear"), ("cbd", 8, "snow"), ("cbd", None, "clear")],
                               "zone string, hour int, weather string")
    assert all(r[0] is None for r in df.select(C.surge_rule("zone", "hour", "weather")).collect())


def test_quality_predicates(spark):
    df = spark.createDataFrame([(None, 1.5, None), ("r2", 0.9, None), ("r3", 4.0, None), ("r4", 1.0, None),
                                ("r5", 3.5, None), ("r6", None, None)],
                               "ride_id string, surge_multiplier double, event_ts timestamp")
    assert Q.null_key_rows(df).count() == 1
    assert Q.out_of_band_rows(df).count() == 2
    assert Q.stale_rows(df, "2024-01-01 00:00:00").count() == 0  # unparseable time is never stale


def test_dq_checks_rows(spark):
    silver = spark.createDataFrame(
        [("r1", 1.5, datetime(2024, 1, 1, 0, 0)), (None, 4.0, datetime(2024, 1, 1, 11, 0))],
        "ride_id string, surge_multiplier double, event_ts timestamp")
    gold_empty = spark.createDataFrame([], "city_zone string, ride_count long")
    out = {r["rule"]: r for r in Q.dq_checks(silver, gold_empty, "2024-01-01 12:00:00").collect()}
    assert out["null_ride_id"]["passed"] is False and out["null_ride_id"]["bad_rows"] == 1
    assert out["gold_not_empty"]["passed"] is False
    assert out["stale_events"]["bad_rows"] == 1 and out["stale_events"]["passed"] is False
    assert out["surge_out_of_band"]["bad_rows"] == 1


def _brute_rolling(rows, seconds):
    out = {}
    for rid, ts, zone in rows:
        lo = ts - timedelta(seconds=seconds)
        out[rid] = (sum(1 for _, t, _ in rows if lo <= t <= ts),
                    sum(1 for _, t, z in rows if lo <= t <= ts and z == zone))
    return out


def test_rolling_window_matches_brute_force(spark):
    rnd = random.Random(7)
    t0 = datetime(2024, 1, 1)
    rows = []
    for i in range(400):
        # clustered times with exact ties and edge distances of exactly 300 s
        base = t0 + timedelta(seconds=rnd.choice([0, 60, 300, 301, 599, 600, 900]) + 600 * rnd.randint(0, 20))
        rows.append((i, base, rnd.choice(["a", "b", "b", "b"])))
    df = spark.createDataFrame(rows, "id long, ts timestamp, zone string")
    want = _brute_rolling(rows, 300)
    total = {r["id"]: r["window_count"] for r in O.rolling_window(df, "id", "ts", 300, partitions=7).collect()}
    keyed = {r["id"]: r["window_count"]
             for r in O.rolling_window(df, "id", "ts", 300, key_col="zone", partitions=5).collect()}
    assert total == {k: v[0] for k, v in want.items()}
    assert keyed == {k: v[1] for k, v in want.items()}


def test_rolling_sums_and_null_time(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1, 0, 0), 150), (2, datetime(2024, 1, 1, 0, 4), None),
                                (3, datetime(2024, 1, 1, 0, 9), 100), (4, None, 5)],
                               "id long, ts timestamp, s long")
    out = {r["id"]: (r["window_count"], r["window_sum_s"])
           for r in O.rolling_window(df, "id", "ts", 300, sum_cols=("s",)).collect()}
    assert out == {1: (1, 150), 2: (2, 150), 3: (2, 100)}


def test_chronological_split(spark):
    rows = [(i, datetime(2024, 1, 1) + timedelta(minutes=(i * 37) % 50)) for i in range(50)] + [(99, None)]
    df = spark.createDataFrame(rows, "id long, ts timestamp")
    out = O.chronological_split(df, "ts", "id", 0.8, partitions=6).collect()
    order = sorted(rows, key=lambda r: (r[1] is None, r[1] or datetime.min, r[0]))
    want_train = {r[0] for r in order[: int(len(rows) * 0.8)]}
    assert {r["id"] for r in out if r["split"] == "train"} == want_train
    assert sorted(r["position"] for r in out) == list(range(1, len(rows) + 1))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=10**9), min_size=1, max_size=60, unique=True))
def test_hash_split_disjoint_complete_stable(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    a = {r["id"]: r["split"] for r in SP.hash_split(df, F.col("id")).collect()}
    b = {r["id"]: r["split"] for r in SP.hash_split(df.repartition(3), F.col("id")).collect()}
    assert a == b and set(a) == set(ids) and set(a.values()) <= {"train", "test"}


def test_rolling_window_hot_instant_is_split(spark):
    """A third of the rows share one timestamp: still exact, and spread over several partitions."""
    t0 = datetime(2024, 1, 1, 12, 0)
    rows = [(i, t0, "a") for i in range(300)] + [(300 + i, t0 + timedelta(seconds=i), "a") for i in range(600)]
    df = spark.createDataFrame(rows, "id long, ts timestamp, zone string")
    want = _brute_rolling(rows, 300)
    got = {r["id"]: r["window_count"] for r in O.rolling_window(df, "id", "ts", 300, partitions=8).collect()}
    assert got == {k: v[0] for k, v in want.items()}
    probe = df.select(F.col("ts").alias("_t"), F.lit(1).alias("_tie"), F.xxhash64("id").alias("_h"))
    sizes = [r[1] for r in probe.repartitionByRange(8, "_t", "_tie", "_h")
             .groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 300  # the hot instant does not land whole in one partition


def test_historical_bins_payment_and_tip_ratio(spark):
    from zonecast.operators import history as H

    ids = spark.createDataFrame([(0,), (1,), (50,), (51,), (200,), (201,), (None,)], "loc long")
    got = [r[0] for r in ids.select(C.hist_zone("loc")).collect()]
    assert got == [None, "zone_A", "zone_A", "zone_B", "zone_D", "zone_E", None]  # right-closed bins
    compat = [r[0] for r in ids.select(C.hist_zone("loc", nan_text=True)).collect()]
    assert compat[0] == "nan" and compat[-1] == "nan"
    codes = spark.createDataFrame([(1,), (2,), (3,), (None,)], "c long")
    assert [r[0] for r in codes.select(C.hist_payment("c")).collect()] == ["card", "cash", "other", "other"]
    trips = spark.createDataFrame([(10.0, 2.0), (-0.01, 1.0), (20.0, 0.0)], "fare_amount double, tip_amount double")
    ratios = [r[0] for r in trips.select(H.tip_ratio(trips)).collect()]
    assert ratios[1] is None  # zero denominator: null, not infinity
    scaled = H.minmax_scale(trips.withColumn("r", H.tip_ratio(trips)), "r", "s").collect()
    assert sorted(r["s"] for r in scaled if r["s"] is not None) == [1.0, 3.5]
