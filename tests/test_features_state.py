"""Feature frame defaults, one-hot columns, metric expiry, and bounded streaming state."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from zonecast.functions import constants as K
from zonecast.operators import features as FE
from zonecast.operators import metrics as M
from zonecast.session import work_dir


def test_feature_frame_and_one_hot(spark):
    rows = [("2024-03-05T23:59:59.5+00:00", "airport", "bike", None, "cancelled", 2.25, 90.0, 3.4999),
            ("no time", "mall", None, "rain", "requested", None, -5.0, None)]
    kind = ("event_timestamp string, city_zone string, vehicle_type string, weather string, status string, distance_km double, "
            "fare_base_inr double, surge_multiplier double")
    frame = FE.feature_frame(spark.createDataFrame(rows, kind), keep=("event_timestamp",))
    night, odd = sorted(frame.collect(), key=lambda r: -r["event_hour"])
    assert (night["event_hour"], night["weather"], night[K.TARGET]) == (23, "unknown", 3.4999)
    assert (odd["event_hour"], odd["vehicle_type"], odd["distance_km"], odd[K.TARGET]) == (0, "unknown", None, None)
    encoded = FE.one_hot(frame, keep=("event_timestamp",)).collect()
    for row, plain in zip(encoded, frame.collect(), strict=True):
        for column, values in FE.VOCAB.items():
            flags = {v: row[FE.dummy_name(column, v)] for v in values}
            assert {v for v, flag in flags.items() if flag} == ({plain[column]} & set(values))
            assert set(flags.values()) <= {0, 1}


def test_feature_frame_missing_columns(spark):
    df = spark.createDataFrame([("junk", None)], "event_timestamp string, city_zone string")
    row = FE.feature_frame(df, keep=()).collect()[0]
    assert row["event_hour"] == 0  # unparseable time -> hour 0
    assert row["city_zone"] == "unknown" and row["weather"] == "unknown"
    assert row["distance_km"] == 0.0 and row[K.TARGET] == 1.0  # target defaults when absent


def test_metric_expiry_and_defaults(spark):
    rows = spark.createDataFrame([
        ("live:zone:cbd:demand", '{"ride_count":3,"surge_multiplier":1.5}', datetime(2024, 1, 1, 0, 0, 0),
         datetime(2024, 1, 1, 0, 0, 30)),
        ("live:zone:cbd:demand", '{"ride_count":4,"surge_multiplier":1.6}', datetime(2024, 1, 1, 0, 1, 0),
         datetime(2024, 1, 1, 0, 1, 30)),
        ("dashboard:total_revenue", '{"amount":10.5}', datetime(2024, 1, 1, 0, 0, 0),
         datetime(2024, 1, 1, 0, 15, 0)),
    ], M.METRIC_SCHEMA)
    table = M.metric_table(rows)
    assert table.count() == 2
    alive = M.metric_read(table, F.lit("2024-01-01 00:01:40").cast("timestamp"))
    got = {r["metric_key"]: r for r in alive.collect()}
    assert "live:zone:cbd:demand" not in got  # expired 10 s earlier
    assert got["dashboard:total_revenue"]["amount"] == 10.5
    assert got["live:rides_last_5min"]["count"] == 0  # absent live total reads as 0
    health = M.pipeline_health(alive).collect()[0]
    assert health["rides_last_5min"] == 0 and health["silver_fresh"] is False and health["gold_ok"] is True


def test_stream_dedup_state_is_bounded(spark):
    """Ten batches of 100 new rides each (plus redelivered copies): the dedup state holds only
    keys inside the watermark, not every key seen."""
    from zonecast.sources.schemas import SCHEMAS
    from zonecast.streaming import streams as ST

    root = work_dir(spark, "t-state")
    base = datetime(2024, 1, 1)
    for b in range(10):
        rows = []
        for i in range(100):
            rid = b * 100 + i
            ts = base.replace(hour=b, minute=i % 60).isoformat() + "+00:00"
            rows.append((str(rid), ts, "completed", 100.0, 1.5, "cbd"))
        df = spark.createDataFrame(rows, "ride_id string, event_timestamp string, status string, "
                                         "fare_base_inr double, surge_multiplier double, city_zone string")
        full = df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                           for f in SCHEMAS["rides"].fields])
        full.unionByName(full.limit(10)).write.mode("append").parquet(f"{root}/bronze")
        q = ST.start_silver(spark, "rides", f"{root}/bronze", f"{root}/silver", f"{root}/chk")
        q.awaitTermination()
        state_rows = sum(op["numRowsTotal"] for op in (q.lastProgress or {}).get("stateOperators", []))
        assert state_rows <= 200, state_rows  # at most this hour's keys and the previous one's
    assert spark.read.parquet(f"{root}/silver").count() == 1000


def test_json_decode_routes_rejects(spark):
    from zonecast.sources import events as EV
    from zonecast.sources.schemas import RIDE_SCHEMA

    df = spark.createDataFrame([('{"ride_id": "r1", "surge_multiplier": 1.5}',), ('{"ride_id": "r2", "surge',),
                                ("{}",), ("not json",)], "value string")
    good = EV.decode_events(df, RIDE_SCHEMA)
    assert [(r["ride_id"], r["surge_multiplier"]) for r in good.collect()] == [("r1", 1.5)]
    assert good.columns == RIDE_SCHEMA.fieldNames()
    assert EV.decode_rejects(df, RIDE_SCHEMA).count() == 3
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1  # one parse per row


def test_json_decode_keeps_a_row_with_one_bad_field(spark):
    from zonecast.sources import events as EV
    from zonecast.sources.schemas import RIDE_SCHEMA

    df = spark.createDataFrame([('{"ride_id": "r1", "distance_km": "oops", "surge_multiplier": 1.5}',)], "value string")
    row = EV.decode_events(df, RIDE_SCHEMA).first()
    assert (row["ride_id"], row["distance_km"], row["surge_multiplier"]) == ("r1", None, 1.5)
    assert EV.decode_rejects(df, RIDE_SCHEMA).count() == 0


def test_metrics_are_taken_from_raw_predictions(spark):
    from zonecast.operators import model as MO

    df = spark.createDataFrame([(1.5, 1.504), (1.2, 1.2049), (None, 1.0)], "label double, prediction double")
    m = MO.regression_metrics(df).first()
    assert m["n"] == 2 and abs(m["mae"] - 0.00445) < 1e-9 and abs(m["rmse"] - ((0.004 ** 2 + 0.0049 ** 2) / 2) ** 0.5) < 1e-9


def test_empty_inputs_do_not_divide_by_zero(spark):
    from zonecast.operators import features as FE2
    from zonecast.operators import model as MO

    empty = spark.createDataFrame([], "ride_id string, label double, prediction double, surge_multiplier double")
    m = MO.regression_metrics(empty).collect()[0]
    assert m["n"] == 0 and m["mae"] is None and m["r2"] is None
    assert M.avg_surge(empty).collect()[0]["surge"] is None
    assert FE2.describe(empty).collect()[0]["mean"] is None
