"""Registered queries: rolling 5-minute views, latest location, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonecast.functions import columns as C
from zonecast.functions import constants as K
from zonecast.operators import ordered as O
from zonecast.operators import silver as S
from zonecast.operators import splits as SP
from zonecast.plans.catalog import register
from zonecast.plans.oracle import add_view, half_up_sql, parse_sql, units_sql, with_views
from zonecast.sources import fixtures as X

W = K.LIVE_WINDOW_SECONDS


add_view("rides_twice", ["rides_fine"], f"""
    SELECT *, {parse_sql('event_timestamp')} AS event_ts FROM (SELECT * FROM rides_fine UNION ALL SELECT * FROM rides_fine)""")


def rides_twice(spark, sf):
    """Rides with null ids, zones, times and surges, each delivered twice."""
    r = X.rides_fine(spark, sf)
    return S.enrich_rides(r.unionByName(r))


@register("rolling_rides_5m", with_views("rides_twice") + f"""
SELECT ride_id, event_ts,
       count(*) OVER (ORDER BY event_ts RANGE BETWEEN INTERVAL {W} SECOND PRECEDING AND CURRENT ROW)
         AS rides_last_5min
FROM rides_twice WHERE event_ts IS NOT NULL""", "W1 D16")
def rolling_rides_5m(spark, sf):
    out = O.rolling_window(rides_twice(spark, sf), "ride_id", "event_ts", W)
    return out.select("ride_id", "event_ts", F.col("window_count").alias("rides_last_5min"))


def zone_rolling(rides):
    src = rides.select("ride_id", "event_ts", "city_zone",
                       C.to_units("surge_multiplier").alias("surge_u"),
                       F.col("surge_multiplier").isNotNull().cast("long").alias("surge_n"))
    out = O.rolling_window(src, "ride_id", "event_ts", W, key_col="city_zone", sum_cols=("surge_u", "surge_n"))
    return out.select(
        "ride_id", "event_ts", "city_zone", F.col("window_count").alias("zone_rides_5m"),
        C.from_cents(C.half_up_ratio(F.col("window_sum_surge_u"), F.col("window_sum_surge_n") * 100))
        .alias("zone_avg_surge_5m"))


@register("rolling_zone_5m", with_views("rides_twice") + f"""
SELECT ride_id, event_ts, city_zone, zone_rides_5m,
       {half_up_sql('sh', '100 * sn')} / 100.0 AS zone_avg_surge_5m
FROM (SELECT ride_id, event_ts, city_zone,
             count(*) OVER w AS zone_rides_5m,
             sum({units_sql('surge_multiplier')}) OVER w AS sh,
             count(surge_multiplier) OVER w AS sn
      FROM rides_twice WHERE event_ts IS NOT NULL
      WINDOW w AS (PARTITION BY city_zone ORDER BY event_ts
                   RANGE BETWEEN INTERVAL {W} SECOND PRECEDING AND CURRENT ROW))""", "W2 D16")
def rolling_zone_5m(spark, sf):
    return zone_rolling(rides_twice(spark, sf))


@register("latest_driver_location", with_views("drivers_bronze") + f"""
SELECT driver_id, event_ts, lat, lon, event_ts + INTERVAL {K.TTL_DRIVER_LOCATION} SECOND AS expires_at
FROM (SELECT driver_id, {parse_sql('event_timestamp')} AS event_ts, lat, lon FROM drivers_bronze)
WHERE event_ts IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY driver_id ORDER BY event_ts DESC, lat DESC, lon DESC) = 1""", "W3")
def latest_driver_location(spark, sf):
    d = S.enrich_drivers(X.drivers_bronze(spark, sf)).filter(F.col("event_ts").isNotNull())
    best = d.groupBy("driver_id").agg(F.max(F.struct("event_ts", "lat", "lon")).alias("m"))
    return best.select("driver_id", "m.event_ts", "m.lat", "m.lon",
                       (F.col("m.event_ts") + F.make_dt_interval(secs=F.lit(K.TTL_DRIVER_LOCATION)))
                       .alias("expires_at"))


@register("time_split", with_views("rides") + """
SELECT ride_id, event_ts, position, CASE WHEN position <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split
FROM (SELECT ride_id, event_ts,
             row_number() OVER (ORDER BY event_ts IS NULL, event_ts, ride_id) AS position,
             count(*) OVER () AS n
      FROM rides)""", "W4")
def time_split(spark, sf):
    r = X.rides(spark, sf).select("ride_id", "event_ts")
    return O.chronological_split(r, "event_ts", "ride_id", 0.8).select("ride_id", "event_ts", "position", "split")


@register("hash_split", with_views("rides_dirty") + """
SELECT id AS ride_id,
       CASE WHEN ('0x' || substr(md5(coalesce(id, 'null') || ':42'), 1, 8))::BIGINT % 1000000 < 812500 THEN 'train' ELSE 'test' END AS split
FROM (SELECT 'ride-' || ride_id AS id FROM rides_dirty)""", "W5")
def hash_split(spark, sf):
    """Text ids, null ones among them; a fraction that is no whole percent."""
    r = X.rides_dirty(spark, sf).select(F.concat(F.lit("ride-"), "ride_id").alias("ride_id"))
    return SP.hash_split(r, F.col("ride_id"), 0.8125).select("ride_id", "split")
