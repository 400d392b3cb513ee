"""Views over the driver-generated test tables (see FIXTURES.md part B).

Every view is a plain deterministic expression over ``events``, ``lineitem`` or
``orders`` so the same rows can be rebuilt in DuckDB (``zonecast.plans.oracle``)
and compared. Integer arithmetic is used wherever a derived double must be
bit-identical in both engines (``(a + b) / 10.0`` instead of ``a / 10 + b``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions import columns as C
from zonecast.functions import constants as K
from zonecast.session import ensure_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(index: Column, names: list[str]) -> Column:
    expr = None
    for i, name in enumerate(names):
        expr = F.when(index == i, name) if expr is None else expr.when(index == i, name)
    return expr


def _k() -> Column:
    return F.get_json_object("props", "$.k").try_cast("int")


def _zone_index() -> Column:
    return F.pmod(F.col("user_id"), F.lit(len(K.ZONES)))


def _zone_name(index: Column) -> Column:
    return _pick(index, [z[0] for z in K.ZONES])


def _zone_centre(index: Column, which: int) -> Column:
    """Zone centre in 1e-4 degrees (exact integer)."""
    return _pick(index, [int(round(z[which] * 10000)) for z in K.ZONES]).cast("long")


def _base_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", "user_id", "event_type", "value", "ts",
        _k().alias("k"), F.hour("ts").alias("_hour"), _zone_index().alias("_zi"),
    )


RIDE_COLUMNS = [
    "ride_id", "event_timestamp", "driver_id", "user_id", "status", "pickup_lat", "pickup_lon",
    "dropoff_lat", "dropoff_lon", "city_zone", "distance_km", "vehicle_type", "fare_base_inr",
    "surge_multiplier", "weather", "event_delay_ms", "schema_version",
]
DRIVER_COLUMNS = ["driver_id", "event_timestamp", "status", "current_zone", "lat", "lon", "rating",
                  "schema_version"]
PAYMENT_COLUMNS = ["payment_id", "ride_id", "event_timestamp", "payment_method", "amount_inr", "currency",
                   "status", "schema_version"]


def _ride_fields(b: DataFrame) -> DataFrame:
    """The zone and the weather are named before the surge rule reads them, and the rule's result before the rest is made: with all
    in one projection the generated method passes 8,000 bytes of bytecode, and the JVM interprets it for every row."""
    zi = F.col("_zi")
    hour = F.col("_hour")
    weather = (
        F.when(hour.between(6, 11), "clear")
        .when(hour.between(12, 17), "cloudy")
        .otherwise(_pick(F.pmod(F.col("event_id"), F.lit(3)), K.WEATHER_STATES))
    )
    status = (F.when(F.col("event_type") == "purchase", "completed")
              .when(F.col("event_type") == "error", "cancelled")
              .otherwise("requested"))
    k = F.col("k")
    b = b.select("*", _zone_name(zi).alias("city_zone"), weather.alias("weather"))
    b = b.select("*", C.surge_rule("city_zone", hour, "weather").alias("surge_multiplier"))
    return b.select(
        "event_id", "k",
        F.col("event_id").cast("string").alias("ride_id"),
        C.iso_text("ts").alias("event_timestamp"),
        F.pmod(F.col("user_id"), F.lit(50)).cast("string").alias("driver_id"),
        F.col("user_id").cast("string").alias("user_id"),
        status.alias("status"),
        ((_zone_centre(zi, 1) + k) / F.lit(10000.0)).alias("pickup_lat"),
        ((_zone_centre(zi, 2) + k) / F.lit(10000.0)).alias("pickup_lon"),
        ((_zone_centre(zi, 1) - k) / F.lit(10000.0)).alias("dropoff_lat"),
        ((_zone_centre(zi, 2) - k) / F.lit(10000.0)).alias("dropoff_lon"),
        "city_zone",
        ((F.lit(15) + k) / F.lit(10.0)).alias("distance_km"),
        _pick(F.pmod(F.col("event_id"), F.lit(4)), K.VEHICLE_TYPES).alias("vehicle_type"),
        F.col("value").alias("fare_base_inr"),
        "surge_multiplier",
        "weather",
        F.lit(0).cast("int").alias("event_delay_ms"),
        F.lit("1.0").alias("schema_version"),
    )


def ride_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze ride columns plus the source ``event_id`` and ``k`` (for derived test inputs)."""
    return _ride_fields(_base_events(spark, sf_dir))


def rides_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze ride events, one per ``events`` row (unique ``ride_id``)."""
    return _ride_fields(_base_events(spark, sf_dir)).select(*RIDE_COLUMNS)


def _with_copies(df: DataFrame, id_col: str = "event_id") -> DataFrame:
    """The view plus an exact copy of every row whose id is divisible by 10."""
    return df.unionByName(df.filter(F.pmod(F.col(id_col), F.lit(10)) == 0))


def rides_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rides with 10 % exact duplicates (redelivery)."""
    r = _ride_fields(_base_events(spark, sf_dir))
    return _with_copies(r).select(*RIDE_COLUMNS)


def rides_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rides with null ids, null / out-of-band surge, unparseable time, null zone."""
    r = _ride_fields(_base_events(spark, sf_dir))
    eid = F.col("event_id")
    m = lambda n: F.pmod(eid, F.lit(n)) == 0
    return r.select(
        F.when(m(101), F.lit(None).cast("string")).otherwise(F.col("ride_id")).alias("ride_id"),
        F.when(m(97), F.lit("junk")).otherwise(F.col("event_timestamp")).alias("event_timestamp"),
        *[c for c in RIDE_COLUMNS[2:9]],
        F.when(m(89), F.lit(None).cast("string")).otherwise(F.col("city_zone")).alias("city_zone"),
        "distance_km", "vehicle_type", "fare_base_inr",
        F.when(m(37), F.lit(None).cast("double"))
        .when(m(53), F.lit(0.9))
        .when(m(59), F.lit(4.0))
        .otherwise(F.col("surge_multiplier")).alias("surge_multiplier"),
        "weather", "event_delay_ms", "schema_version",
    )


def _driver_fields(b: DataFrame) -> DataFrame:
    zi = F.col("_zi")
    zone = _zone_name(zi)
    odd = F.pmod(F.col("event_id"), F.lit(2)) == 1
    k = F.col("k")
    return b.select(
        "event_id",
        F.col("user_id").cast("string").alias("driver_id"),
        C.iso_text("ts").alias("event_timestamp"),
        _pick(F.pmod(F.col("event_id"), F.lit(3)), K.DRIVER_STATUSES).alias("status"),
        F.when(odd, F.concat(F.lit("  "), F.upper(zone), F.lit("  "))).otherwise(zone).alias("current_zone"),
        ((_zone_centre(zi, 1) + k) / F.lit(10000.0)).alias("lat"),
        ((_zone_centre(zi, 2) - k) / F.lit(10000.0)).alias("lon"),
        ((F.lit(36) + F.pmod(k, F.lit(15))) / F.lit(10.0)).alias("rating"),
        F.lit("1.0").alias("schema_version"),
    )


def drivers_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _driver_fields(_base_events(spark, sf_dir))
    return _with_copies(d).select(*DRIVER_COLUMNS)


def _payment_fields(b: DataFrame) -> DataFrame:
    k = F.col("k")
    odd = F.pmod(F.col("event_id"), F.lit(2)) == 1
    method = _pick(F.pmod(k, F.lit(4)), K.PAYMENT_METHODS)
    k50 = F.pmod(k, F.lit(50))
    return b.filter(F.col("event_type") == "purchase").select(
        "event_id",
        F.concat(F.lit("pay-"), F.col("event_id").cast("string")).alias("payment_id"),
        F.col("event_id").cast("string").alias("ride_id"),
        C.iso_text("ts").alias("event_timestamp"),
        F.when(odd, F.concat(F.lit("  "), F.upper(method), F.lit("  "))).otherwise(method).alias("payment_method"),
        F.col("value").alias("amount_inr"),
        F.lit("INR").alias("currency"),
        F.when(k50 == 0, "failed").when(k50 == 1, "refunded").otherwise("success").alias("status"),
        F.lit("1.0").alias("schema_version"),
    )


def payments_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _payment_fields(_base_events(spark, sf_dir))
    return _with_copies(p).select(*PAYMENT_COLUMNS)


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rides: the enrich step over the (already unique) bronze rides."""
    from zonecast.operators.silver import enrich_rides

    return enrich_rides(rides_raw(spark, sf_dir))


def rides_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rides_dirty`` with surges of four places."""
    units = C.to_units("surge_multiplier") + F.pmod(F.col("user_id").cast("long"), F.lit(97))
    return rides_dirty(spark, sf_dir).withColumn("surge_multiplier", units.cast("double") / F.lit(10000.0))


def trips(spark: SparkSession, sf_dir: str, with_row_id: bool = False, id_columns: tuple[str, ...] = ()) -> DataFrame:
    """Raw historical taxi trips (TLC-like column names) derived from ``lineitem``.

    ``trip_row_id`` (file name + row index inside the file, from the scan's hidden
    metadata) is a stable per-row id that survives repartitioning and retries; with ``id_columns``
    it is made of these columns instead, which SQL can name as well.
    """
    li = table(spark, sf_dir, "lineitem")
    extra = []
    if with_row_id:
        extra = [F.concat(F.col("_metadata.file_name"), F.lit(":"),
                          F.col("_metadata.row_index").cast("string")).alias("trip_row_id")]
    if id_columns:
        extra = [F.concat_ws("-", *[F.col(c).cast("string") for c in id_columns]).alias("trip_row_id")]
    return li.select(
        (F.col("l_shipdate") + F.make_dt_interval(hours=F.pmod(F.col("l_partkey"), F.lit(24)).cast("int")))
        .cast("timestamp").alias("tpep_pickup_datetime"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("long"))
        .otherwise(F.pmod(F.col("l_partkey"), F.lit(266))).alias("PULocationID"),
        F.col("l_quantity").alias("trip_distance"),
        (F.col("l_extendedprice") / F.lit(1000)).alias("fare_amount"),
        ((F.col("l_extendedprice") / F.lit(1000)) * F.col("l_discount")).alias("tip_amount"),
        F.pmod(F.col("l_linenumber"), F.lit(5)).cast("long").alias("payment_type"),
        *extra,
    )


def zone_dim(spark: SparkSession) -> DataFrame:
    """The 5-row zone dimension (fixed values)."""
    rows = [(name, lat, lon, factor) for name, lat, lon, factor in K.ZONES]
    return spark.createDataFrame(
        rows, "city_zone string, lat_center double, lon_center double, demand_multiplier double")


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-only version table: order rows committed in 5 versions, one day apart."""
    o = table(spark, sf_dir, "orders")
    v = F.pmod(F.col("o_orderkey"), F.lit(5))
    return o.select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice",
        v.cast("int").alias("commit_version"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(days=v.cast("int")))
        .alias("committed_at"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides with a label (surge) and two candidate predictions, clipped to the surge band."""
    r = _ride_fields(_base_events(spark, sf_dir))
    label_h = C.to_hundredths("surge_multiplier")
    k = F.col("k")
    clip = lambda x: F.least(F.lit(350), F.greatest(F.lit(100), x))
    return r.select(
        "ride_id", "city_zone",
        C.parse_event_ts("event_timestamp").alias("event_ts"),
        F.col("surge_multiplier").alias("label"),
        # more than two decimals, as a model's raw predictions have
        (clip(label_h + k - 50) / F.lit(100.0) + F.pmod(k, F.lit(13)) * F.lit(0.00037)).alias("prediction"),
        (clip(label_h + F.pmod(k, F.lit(11)) * 4 - 20) / F.lit(100.0) - F.pmod(k, F.lit(7)) * F.lit(0.00053)).alias("prediction_alt"),
    )
