"""Registered queries: dashboard metrics, metric table, quality rules."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from zonecast.operators import gold as G
from zonecast.operators import metrics as M
from zonecast.operators import quality as Q
from zonecast.operators import silver as S
from zonecast.operators import tables as T
from zonecast.plans.catalog import register
from zonecast.plans.oracle import add_view, cents_sql, count_if_sql, mean2_sql, units_sql, with_views
from zonecast.session import work_root
from zonecast.sources import fixtures as X

DQ_AS_OF = "2024-01-04 01:00:00"
READ_LAG_SECONDS = 40

add_view("metric_tbl", ["rides", "gold"], f"""
    SELECT * FROM (
      SELECT 'live:zone:' || city_zone || ':demand' AS metric_key, last_ts AS written_at,
             last_ts + INTERVAL 30 SECOND AS expires_at, NULL::BIGINT AS count, ride_count,
             surge_multiplier, NULL::DOUBLE AS surge, NULL::DOUBLE AS amount,
             NULL::DOUBLE AS utilisation_percent, NULL::BIGINT AS total_rides
      FROM (SELECT city_zone, count(ride_id) AS ride_count, {mean2_sql('surge_multiplier')} AS surge_multiplier,
                   max(event_ts) AS last_ts
            FROM rides WHERE city_zone IS NOT NULL AND event_ts >= (SELECT max(event_ts) FROM rides) - INTERVAL 5 MINUTE
            GROUP BY city_zone)
      UNION ALL
      SELECT 'live:rides_last_5min', last_ts, last_ts + INTERVAL 60 SECOND, cnt, NULL, NULL, NULL, NULL, NULL, NULL
      FROM (SELECT count(ride_id) AS cnt, max(event_ts) AS last_ts FROM rides
            WHERE event_ts >= (SELECT max(event_ts) FROM rides) - INTERVAL 5 MINUTE)
      UNION ALL
      SELECT 'dashboard:total_revenue', n.last_ts, n.last_ts + INTERVAL 900 SECOND, NULL, NULL, NULL, NULL,
             (SELECT coalesce(CAST(sum({cents_sql('coalesce(gross_revenue_inr, 0.0::DOUBLE)')}) AS BIGINT), 0)
                     / 100.0 FROM gold), NULL, NULL
      FROM (SELECT max(event_ts) AS last_ts FROM rides) n
      UNION ALL
      SELECT 'dashboard:avg_surge', n.last_ts, n.last_ts + INTERVAL 900 SECOND, NULL, NULL, NULL,
             (SELECT CAST(sum({units_sql('coalesce(surge_multiplier, 1.0::DOUBLE)')}) AS DOUBLE) / count(*) / 10000.0
              FROM rides), NULL, NULL, NULL
      FROM (SELECT max(event_ts) AS last_ts FROM rides) n
      UNION ALL
      SELECT 'dashboard:zone:' || z.city_zone || ':count', n.last_ts, n.last_ts + INTERVAL 900 SECOND, z.cnt, NULL, NULL,
             NULL, NULL, NULL, NULL
      FROM (SELECT city_zone, count(ride_id) AS cnt FROM rides WHERE city_zone IS NOT NULL GROUP BY city_zone) z,
           (SELECT max(event_ts) AS last_ts FROM rides) n
      UNION ALL
      SELECT 'dashboard:driver_utilisation', n.last_ts, n.last_ts + INTERVAL 900 SECOND, NULL, NULL, NULL, NULL, NULL,
             u.util, u.total
      FROM (SELECT count(*) AS total,
                   CASE WHEN count(*) > 0 THEN CAST({count_if_sql("status = 'completed'")} AS DOUBLE) / count(*) * 100.0
                        ELSE 0.0 END AS util FROM rides) u,
           (SELECT max(event_ts) AS last_ts FROM rides) n)""")

add_view("metric_alive", ["metric_tbl"], f"""
    SELECT a.* FROM metric_tbl a
    WHERE a.expires_at > (SELECT max(written_at) FROM metric_tbl) - INTERVAL {READ_LAG_SECONDS} SECOND
    UNION ALL
    SELECT 'live:rides_last_5min', NULL::TIMESTAMP, NULL::TIMESTAMP, 0, NULL, NULL, NULL, NULL, NULL, NULL
    WHERE NOT EXISTS (SELECT 1 FROM metric_tbl
                      WHERE metric_key = 'live:rides_last_5min'
                        AND expires_at > (SELECT max(written_at) FROM metric_tbl) - INTERVAL {READ_LAG_SECONDS} SECOND)
""")


def _silver_gold(spark, sf):
    silver = X.rides(spark, sf)
    return silver, G.hourly_kpis(silver)


def _metric_path(spark, sf) -> str:
    return f"{work_root(spark)}/metrics-{hashlib.md5(sf.encode()).hexdigest()[:12]}"


def _write_metrics(spark, sf):
    """The writer: one row per key, stored for the readers."""
    path = _metric_path(spark, sf)
    M.metric_table(M.metric_rows(X.rides(spark, sf))).coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.schema(M.METRIC_SCHEMA).parquet(path)


def _alive(spark, sf):
    """The readers' view of the stored table; written first where this application has none."""
    path = _metric_path(spark, sf)
    tbl = spark.read.schema(M.METRIC_SCHEMA).parquet(path) if T.table_exists(spark, path) else _write_metrics(spark, sf)
    as_of = tbl.agg((F.max("written_at") - F.make_dt_interval(secs=F.lit(READ_LAG_SECONDS))).alias("as_of"))
    return M.metric_read(tbl, as_of)


@register("total_revenue", with_views("gold") + f"""
SELECT coalesce(CAST(sum({cents_sql('coalesce(gross_revenue_inr, 0.0::DOUBLE)')}) AS BIGINT), 0) / 100.0 AS amount
FROM gold""", "A4")
def total_revenue(spark, sf):
    return M.total_revenue(_silver_gold(spark, sf)[1])


@register("avg_surge", with_views("silver_fine") + f"""
SELECT CAST(sum(CAST(coalesce(surge_multiplier, 1.0::DOUBLE) AS DECIMAL(20,4))) AS DOUBLE) / count(*) AS surge
FROM silver_fine""", "A5")
def avg_surge(spark, sf):
    """Surges of four places: their mean is that of the values as they are."""
    return M.avg_surge(S.silver_rides(X.rides_fine(spark, sf)))


@register("rides_by_zone", with_views("silver_dirty") + """
SELECT city_zone, count(ride_id) AS count FROM silver_dirty WHERE city_zone IS NOT NULL GROUP BY city_zone""",
          "A6")
def rides_by_zone(spark, sf):
    return M.rides_by_zone(S.silver_rides(X.rides_dirty(spark, sf)))


_UTIL_SQL = f"""
SELECT count(*) AS total_rides,
       CASE WHEN count(*) > 0 THEN CAST({count_if_sql("status = 'completed'")} AS DOUBLE) / count(*) * 100.0
            ELSE 0.0 END AS utilisation_percent
FROM rides"""


@register("utilisation", with_views("rides") + _UTIL_SQL, "A7 D15")
def utilisation(spark, sf):
    return M.utilisation(X.rides(spark, sf))


@register("utilisation_split", with_views("rides") + f"""
SELECT total_rides, utilisation_percent,
       CASE WHEN utilisation_percent < 100 THEN 100.0 - utilisation_percent ELSE 0.0 END AS cancelled_percent,
       CAST(trunc(total_rides * utilisation_percent / 100) AS BIGINT) AS completed_count,
       CAST(trunc(total_rides * (100 - utilisation_percent) / 100) AS BIGINT) AS cancelled_count
FROM ({_UTIL_SQL})""", "A8")
def utilisation_split(spark, sf):
    return M.utilisation_split(M.utilisation(X.rides(spark, sf)))


@register("metric_table", with_views("metric_tbl") + "SELECT * FROM metric_tbl", "S13")
def metric_table(spark, sf):
    return M.parse_payload(_write_metrics(spark, sf))


@register("metric_read", with_views("metric_alive") + "SELECT * FROM metric_alive", "S14")
def metric_read(spark, sf):
    return _alive(spark, sf)


@register("zone_heatmap", with_views("metric_alive", "zone_dim") + """
SELECT d.city_zone, d.lat_center AS lat_grid, d.lon_center AS lon_grid,
       CASE WHEN f.live_found THEN greatest(coalesce(l.ride_count, CAST(trunc(d.demand_multiplier * 100) AS BIGINT)), 1)
            ELSE CAST(trunc(d.demand_multiplier * 100) AS BIGINT) END AS ride_count,
       CASE WHEN f.live_found THEN coalesce(l.surge_multiplier, d.demand_multiplier) END AS surge_multiplier,
       f.live_found
FROM zone_dim d
LEFT JOIN (SELECT regexp_extract(metric_key, '^live:zone:(.*):demand$', 1) AS city_zone, ride_count,
                  surge_multiplier
           FROM metric_alive WHERE metric_key LIKE 'live:zone:%:demand') l ON d.city_zone = l.city_zone
CROSS JOIN (SELECT count(*) > 0 AS live_found FROM metric_alive WHERE metric_key LIKE 'live:zone:%:demand') f
""", "J2")
def zone_heatmap(spark, sf):
    return M.zone_heatmap(X.zone_dim(spark), _alive(spark, sf))


@register("pipeline_health", with_views("metric_alive") + """
SELECT coalesce(max(CASE WHEN metric_key = 'live:rides_last_5min' THEN count END), 0) AS rides_last_5min,
       max(metric_key LIKE 'live:zone:%:demand') AS silver_fresh,
       max(metric_key = 'dashboard:total_revenue') AS gold_ok
FROM metric_alive""", "DQ6")
def pipeline_health(spark, sf):
    return M.pipeline_health(_alive(spark, sf))


@register("zone_metric_ranking", with_views("metric_alive") + """
SELECT split_part(metric_key, ':', 3) AS city_zone, count AS rides,
       sum(count) OVER () AS total_rides,
       coalesce((SELECT max(metric_key = 'dashboard:total_revenue') FROM metric_alive), false)
         AND coalesce((SELECT max(metric_key = 'dashboard:avg_surge') FROM metric_alive), false) AS panel_visible
FROM metric_alive WHERE metric_key LIKE 'dashboard:zone:%:count'""", "A26")
def zone_metric_ranking(spark, sf):
    return M.zone_metric_ranking(_alive(spark, sf))


add_view("dirty_gold", ["silver_dirty"], f"""
    SELECT event_date, event_hour, city_zone, count(ride_id) AS ride_count
    FROM silver_dirty GROUP BY event_date, event_hour, city_zone""")


@register("dq_checks", with_views("silver_dirty", "dirty_gold") + f"""
, s AS (SELECT count(*) AS n,
               {count_if_sql('ride_id IS NULL')} AS null_ids,
               {count_if_sql(f"event_ts < TIMESTAMP '{DQ_AS_OF}' - INTERVAL 2 HOUR")} AS stale,
               {count_if_sql('coalesce(surge_multiplier < 1.0 OR surge_multiplier > 3.5, false)')} AS oob
        FROM silver_dirty),
  g AS (SELECT count(*) AS gold_rows, count(DISTINCT city_zone) AS gold_zones FROM dirty_gold)
SELECT 'null_ride_id' AS rule, 'fail' AS severity, null_ids AS bad_rows, n AS total_rows,
       null_ids = 0 AS passed FROM s
UNION ALL SELECT 'gold_not_empty', 'fail', CASE WHEN gold_rows = 0 THEN 1 ELSE 0 END, gold_rows, gold_rows > 0 FROM g
UNION ALL SELECT 'gold_zone_count', 'info', 0, gold_zones, gold_zones > 0 FROM g
UNION ALL SELECT 'stale_events', 'warn', stale, n, NOT (n > 0 AND stale * 100 > n * 10) FROM s
UNION ALL SELECT 'surge_out_of_band', 'fail', oob, n, oob = 0 FROM s""", "DQ1-DQ4 A10 F1-F3")
def dq_checks(spark, sf):
    silver = S.silver_rides(X.rides_dirty(spark, sf))
    return Q.dq_checks(silver, G.hourly_kpis(silver), DQ_AS_OF)
