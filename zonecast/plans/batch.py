"""Registered batch queries: silver, dedup, gold KPIs and the analysis reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonecast.functions import columns as C
from zonecast.operators import gold as G
from zonecast.operators import silver as S
from zonecast.plans.catalog import register
from zonecast.plans.oracle import (
    DRIVER_COLS, PAYMENT_COLS, RIDE_COLS, _dedup_sql, cents_sql, count_if_sql, half_up_sql, mean2_sql,
    mean3_sql, money_sum_sql, parse_sql, with_views,
)
from zonecast.sources import fixtures as X

# ---------------------------------------------------------------- flagship (A1)

HOURLY_KPIS_SQL = with_views("gold") + "SELECT * FROM gold"


@register("hourly_kpis", HOURLY_KPIS_SQL, "A1 P1-P6")
def hourly_kpis(spark, sf):
    return G.hourly_kpis(X.rides(spark, sf))


# ---------------------------------------------------------------- silver

@register("silver_rides", with_views("silver_rides") + "SELECT * FROM silver_rides", "T1 P1-P6")
def silver_rides(spark, sf):
    return S.silver_rides(X.rides_bronze(spark, sf))


_DRIVER_EXTRA = ("event_ts, CAST(event_ts AS DATE) AS event_date, CAST(hour(event_ts) AS INTEGER) AS event_hour, "
                 "status = 'online' AS is_available")


@register("silver_drivers", with_views("drivers_bronze") + f"""
SELECT driver_id, event_timestamp, status, trim(lower(current_zone)) AS current_zone, lat, lon, rating,
       schema_version, {_DRIVER_EXTRA}
FROM (SELECT *, {parse_sql('event_timestamp')} AS event_ts
      FROM ({_dedup_sql('drivers_bronze', 'driver_id, event_timestamp', DRIVER_COLS)}))
""", "T1 P1-P3 P5 P7")
def silver_drivers(spark, sf):
    return S.silver_drivers(X.drivers_bronze(spark, sf))


@register("silver_payments", with_views("payments_bronze") + f"""
SELECT *, CAST(event_ts AS DATE) AS event_date, CAST(hour(event_ts) AS INTEGER) AS event_hour,
       lower(trim(payment_method)) AS payment_method_clean, status = 'success' AS is_completed
FROM (SELECT *, {parse_sql('event_timestamp')} AS event_ts
      FROM ({_dedup_sql('payments_bronze', 'payment_id', PAYMENT_COLS)}))
""", "T1 P1-P4 P8")
def silver_payments(spark, sf):
    return S.silver_payments(X.payments_bronze(spark, sf))


@register("dedup_rides", with_views("rides_bronze") + _dedup_sql("rides_bronze", "ride_id", RIDE_COLS), "T1")
def dedup_rides(spark, sf):
    return S.dedup(X.rides_bronze(spark, sf), S.RIDE_KEYS)


@register("dedup_drivers", with_views("drivers_bronze")
          + _dedup_sql("drivers_bronze", "driver_id, event_timestamp", DRIVER_COLS), "T1")
def dedup_drivers(spark, sf):
    return S.dedup(X.drivers_bronze(spark, sf), S.DRIVER_KEYS)


@register("dedup_payments", with_views("payments_bronze")
          + _dedup_sql("payments_bronze", "payment_id", PAYMENT_COLS), "T1")
def dedup_payments(spark, sf):
    return S.dedup(X.payments_bronze(spark, sf), S.PAYMENT_KEYS)


@register("duplicate_report", with_views("rides_bronze") + """
SELECT count(*) AS total_rows, count(DISTINCT ride_id) + max(CASE WHEN ride_id IS NULL THEN 1 ELSE 0 END)
       AS distinct_ids,
       count(*) - count(DISTINCT ride_id) - max(CASE WHEN ride_id IS NULL THEN 1 ELSE 0 END) AS duplicates
FROM rides_bronze""", "A12")
def duplicate_report(spark, sf):
    b = X.rides_bronze(spark, sf)
    # dropDuplicates counts a null id as one value; count(DISTINCT) skips it, so add it back.
    has_null = F.max(F.when(F.col("ride_id").isNull(), 1).otherwise(0))
    return b.agg(F.count(F.lit(1)).alias("total_rows"),
                 (F.countDistinct("ride_id") + has_null).alias("distinct_ids"),
                 (F.count(F.lit(1)) - F.countDistinct("ride_id") - has_null).alias("duplicates"))


# ---------------------------------------------------------------- gold variants (A2, A3 in history)

@register("gold_refresh_defaults", with_views("silver_dirty") + f"""
SELECT event_date, event_hour, city_zone,
       count(ride_id) AS ride_count,
       {count_if_sql('is_completed')} AS completed_rides,
       {count_if_sql("status = 'cancelled'")} AS cancelled_rides,
       {money_sum_sql('gross_fare_inr')} AS gross_revenue_inr,
       {mean2_sql('surge_multiplier')} AS avg_surge_multiplier
FROM (SELECT event_date, city_zone, ride_id, status,
             coalesce(event_hour, 0) AS event_hour,
             coalesce(is_completed, false) AS is_completed,
             CASE WHEN status = 'requested' THEN 0.0::DOUBLE ELSE coalesce(gross_fare_inr, 0.0::DOUBLE) END AS gross_fare_inr,
             coalesce(surge_multiplier, 1.0::DOUBLE) AS surge_multiplier
      FROM silver_dirty WHERE city_zone IS NOT NULL)
GROUP BY event_date, event_hour, city_zone""", "A2 P12 P13 D6")
def gold_refresh_defaults(spark, sf):
    """Numbers that arrive as text, some of them none."""
    silver = S.silver_rides(X.rides_dirty(spark, sf))
    fare = F.when(F.col("status") == "requested", "n/a").otherwise(F.col("gross_fare_inr").cast("string"))
    text = {"gross_fare_inr": fare, "event_hour": F.col("event_hour").cast("string"), "surge_multiplier": F.col("surge_multiplier").cast("string")}
    return G.hourly_kpis_with_defaults(silver.withColumns(text))


@register("zone_revenue_gold", with_views("gold") + f"""
SELECT city_zone, {money_sum_sql('gross_revenue_inr')} AS gross_revenue_inr, count(*) AS gold_rows
FROM gold GROUP BY city_zone""", "A9")
def zone_revenue_gold(spark, sf):
    return G.zone_revenue(G.hourly_kpis(X.rides(spark, sf)))


@register("peak_anomaly", with_views("gold") + """
SELECT *, peak_avg < off_peak_avg * 0.5 AS anomaly FROM (
  SELECT coalesce(avg(CASE WHEN event_hour BETWEEN 8 AND 21 THEN ride_count END), 0.0) AS peak_avg,
         coalesce(avg(CASE WHEN NOT (event_hour BETWEEN 8 AND 21) THEN ride_count END), 0.0) AS off_peak_avg
  FROM gold)""", "A11 DQ5 F4 D14")
def peak_anomaly(spark, sf):
    return G.peak_anomaly(G.hourly_kpis(X.rides(spark, sf)))


# ---------------------------------------------------------------- notebook reports

@register("status_distribution", with_views("rides_bronze", "drivers_bronze") + """
SELECT status, count(*) AS count, 'rides' AS entity FROM rides_bronze GROUP BY status
UNION ALL
SELECT status, count(*) AS count, 'drivers' AS entity FROM drivers_bronze GROUP BY status""", "A13 T2")
def status_distribution(spark, sf):
    return G.status_distribution(X.rides_bronze(spark, sf), X.drivers_bronze(spark, sf))


@register("surge_by_zone", with_views("rides_bronze") + f"""
SELECT city_zone, count(ride_id) AS ride_count, {mean2_sql('surge_multiplier')} AS avg_surge,
       min(surge_multiplier) AS min_surge, max(surge_multiplier) AS max_surge
FROM rides_bronze GROUP BY city_zone""", "A14")
def surge_by_zone(spark, sf):
    return G.surge_by_zone(X.rides_bronze(spark, sf))


@register("null_report", with_views("silver_dirty") + """
SELECT CAST(sum(CASE WHEN ride_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS ride_id,
       CAST(sum(CASE WHEN event_ts IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS event_ts,
       CAST(sum(CASE WHEN city_zone IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS city_zone,
       CAST(sum(CASE WHEN surge_multiplier IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS surge_multiplier,
       CAST(sum(CASE WHEN gross_fare_inr IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS gross_fare_inr,
       count(*) AS total_rows
FROM silver_dirty""", "A15")
def null_report(spark, sf):
    return G.null_report(S.silver_rides(X.rides_dirty(spark, sf)))


@register("volume_by_hour", with_views("rides") + f"""
SELECT event_hour, count(ride_id) AS ride_count, {mean2_sql('surge_multiplier')} AS avg_surge,
       {money_sum_sql('gross_fare_inr')} AS total_revenue_inr
FROM rides GROUP BY event_hour""", "A16 T2")
def volume_by_hour(spark, sf):
    return G.volume_by_hour(X.rides(spark, sf))


@register("revenue_by_zone", with_views("rides") + f"""
SELECT city_zone, count(ride_id) AS rides, {money_sum_sql('gross_fare_inr')} AS revenue_inr,
       {mean3_sql('surge_multiplier')} AS avg_surge
FROM rides GROUP BY city_zone""", "A17 T2")
def revenue_by_zone(spark, sf):
    return G.revenue_by_zone(X.rides(spark, sf))


@register("top_revenue_zones", with_views("gold") + f"""
SELECT city_zone, CAST(sum(ride_count) AS BIGINT) AS total_rides,
       CAST(sum(completed_rides) AS BIGINT) AS completed_rides,
       CAST(sum(cancelled_rides) AS BIGINT) AS cancelled_rides,
       {money_sum_sql('gross_revenue_inr')} AS total_revenue_inr,
       {mean3_sql('avg_surge_multiplier')} AS avg_surge
FROM gold GROUP BY city_zone""", "A18")
def top_revenue_zones(spark, sf):
    return G.top_revenue_zones(G.hourly_kpis(X.rides(spark, sf)))


_PERIOD = ("CASE WHEN event_hour BETWEEN 7 AND 10 THEN 'morning_peak' WHEN event_hour BETWEEN 17 AND 21 "
           "THEN 'evening_peak' WHEN event_hour BETWEEN 0 AND 5 THEN 'night' ELSE 'off_peak' END")


@register("peak_offpeak", with_views("gold") + f"""
SELECT {_PERIOD} AS period, CAST(sum(ride_count) AS BIGINT) AS rides,
       {money_sum_sql('gross_revenue_inr')} AS revenue_inr,
       {mean3_sql('avg_surge_multiplier')} AS avg_surge
FROM gold GROUP BY 1""", "A19 P24")
def peak_offpeak(spark, sf):
    return G.peak_offpeak(G.hourly_kpis(X.rides(spark, sf)))


@register("cancellation_rate", with_views("gold") + f"""
SELECT city_zone, total, cancelled, {half_up_sql('cancelled * 10000', 'total')} / 100.0 AS cancel_rate_pct
FROM (SELECT city_zone, CAST(sum(ride_count) AS BIGINT) AS total,
             CAST(sum(cancelled_rides) AS BIGINT) AS cancelled
      FROM gold GROUP BY city_zone)""", "A20 P25")
def cancellation_rate(spark, sf):
    return G.cancellation_rate(G.hourly_kpis(X.rides(spark, sf)))


_GOLD_CENTS = cents_sql("gross_revenue_inr")
_PIVOT_CELLS = ", ".join(
    f"coalesce(CAST({half_up_sql(f'sum(CASE WHEN event_hour = {h} THEN {_GOLD_CENTS} END)', '100')} AS DOUBLE), "
    f"0.0) AS h{h}" for h in range(24))


@register("revenue_pivot", with_views("gold") + f"SELECT city_zone, {_PIVOT_CELLS} FROM gold GROUP BY city_zone",
          "A21")
def revenue_pivot(spark, sf):
    return G.revenue_pivot(G.hourly_kpis(X.rides(spark, sf)))


@register("top_k_zones", with_views("rides") + """
SELECT city_zone, count(ride_id) AS ride_count FROM rides GROUP BY city_zone
ORDER BY ride_count DESC, city_zone ASC NULLS LAST LIMIT 3""", "T3 T2")
def top_k_zones(spark, sf):
    return G.top_k_zones(X.rides(spark, sf))


# ---------------------------------------------------------------- surge rule


@register("surge_rule", with_views("rides") + """
SELECT ride_id, city_zone, event_hour, weather, surge_multiplier AS rule_surge FROM rides""", "P26")
def surge_rule(spark, sf):
    r = X.rides(spark, sf)
    return r.select("ride_id", "city_zone", "event_hour", "weather",
                    C.surge_rule("city_zone", "event_hour", "weather").alias("rule_surge"))
