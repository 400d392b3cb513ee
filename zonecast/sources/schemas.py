"""Declared event schemas (flat, all nullable). Event time arrives as ISO-8601 text."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType


def _schema(fields: list[tuple[str, object]]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


S, D, I = StringType(), DoubleType(), IntegerType()

RIDE_SCHEMA = _schema([
    ("ride_id", S), ("event_timestamp", S), ("driver_id", S), ("user_id", S), ("status", S),
    ("pickup_lat", D), ("pickup_lon", D), ("dropoff_lat", D), ("dropoff_lon", D), ("city_zone", S),
    ("distance_km", D), ("vehicle_type", S), ("fare_base_inr", D), ("surge_multiplier", D), ("weather", S),
    ("event_delay_ms", I), ("schema_version", S),
])

DRIVER_SCHEMA = _schema([
    ("driver_id", S), ("event_timestamp", S), ("status", S), ("current_zone", S), ("lat", D), ("lon", D),
    ("rating", D), ("schema_version", S),
])

PAYMENT_SCHEMA = _schema([
    ("payment_id", S), ("ride_id", S), ("event_timestamp", S), ("payment_method", S), ("amount_inr", D),
    ("currency", S), ("status", S), ("schema_version", S),
])

SCHEMAS = {"rides": RIDE_SCHEMA, "drivers": DRIVER_SCHEMA, "payments": PAYMENT_SCHEMA}
# bronze layout: rides by zone, drivers by their zone, payments unpartitioned
BRONZE_PARTITION = {"rides": ["city_zone"], "drivers": ["current_zone"], "payments": []}
