"""Registered queries: historical trip mapping, min-max surge, historical KPIs."""

from __future__ import annotations

from zonecast.operators import gold as G
from zonecast.operators import history as H
from zonecast.plans.catalog import register
from zonecast.plans.oracle import (
    add_view, count_if_sql, mean2_sql, money_sum_sql, money_times_sql, with_views,
)
from zonecast.sources import fixtures as X

_R2 = "(floor(({x}) * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE)"

add_view("hist", ["trips"], f"""
    SELECT *, {money_times_sql('fare_base_inr', 'surge_multiplier')} AS gross_fare_inr
    FROM (
      SELECT tpep_pickup_datetime AS event_timestamp,
             CAST(tpep_pickup_datetime AS DATE) AS event_date,
             CAST(hour(tpep_pickup_datetime) AS INTEGER) AS event_hour,
             CASE WHEN PULocationID > 0 AND PULocationID <= 50 THEN 'zone_A'
                  WHEN PULocationID > 50 AND PULocationID <= 100 THEN 'zone_B'
                  WHEN PULocationID > 100 AND PULocationID <= 150 THEN 'zone_C'
                  WHEN PULocationID > 150 AND PULocationID <= 200 THEN 'zone_D'
                  WHEN PULocationID > 200 THEN 'zone_E' END AS city_zone,
             {_R2.format(x='trip_distance * 1.60934::DOUBLE')} AS distance_km,
             {_R2.format(x='greatest(fare_amount * 83.0::DOUBLE, 0.0::DOUBLE)')} AS fare_base_inr,
             tip_ratio,
             CASE WHEN tip_ratio IS NOT NULL THEN
               {_R2.format(x='CASE WHEN mx = mn THEN 1.0::DOUBLE ELSE 1.0::DOUBLE + (tip_ratio - mn) / (mx - mn) * 2.5::DOUBLE END')}
             END AS surge_multiplier,
             CASE payment_type WHEN 1 THEN 'card' WHEN 2 THEN 'cash' ELSE 'other' END AS payment_method,
             'yellow_taxi' AS vehicle_type, true AS is_completed, 'completed' AS status
      FROM (SELECT *, CASE WHEN fare_amount + 0.01::DOUBLE <> 0 THEN tip_amount / (fare_amount + 0.01::DOUBLE) END
                      AS tip_ratio FROM trips) t,
           (SELECT min(CASE WHEN fare_amount + 0.01::DOUBLE <> 0 THEN tip_amount / (fare_amount + 0.01::DOUBLE) END) AS mn,
                   max(CASE WHEN fare_amount + 0.01::DOUBLE <> 0 THEN tip_amount / (fare_amount + 0.01::DOUBLE) END) AS mx
            FROM trips) s
      WHERE tpep_pickup_datetime IS NOT NULL)""")


def _hist(spark, sf, with_id=False):
    return H.historical_silver(X.trips(spark, sf, with_row_id=with_id), with_id=with_id)


@register("historical_trips", with_views("hist") + "SELECT * FROM hist", "S9 P17-P20 P22 P23")
def historical_trips(spark, sf):
    return _hist(spark, sf)


@register("minmax_surge", with_views("hist") + """
SELECT event_timestamp, tip_ratio, surge_multiplier FROM hist""", "P21 J3")
def minmax_surge(spark, sf):
    return _hist(spark, sf).select("event_timestamp", "tip_ratio", "surge_multiplier")


@register("historical_kpis", with_views("hist") + f"""
SELECT event_date, event_hour, city_zone,
       count(*) AS ride_count, {count_if_sql('is_completed')} AS completed_rides,
       {count_if_sql("status = 'cancelled'")} AS cancelled_rides,
       {money_sum_sql('gross_fare_inr')} AS gross_revenue_inr,
       {mean2_sql('surge_multiplier')} AS avg_surge_multiplier
FROM hist GROUP BY event_date, event_hour, city_zone""", "A3")
def historical_kpis(spark, sf):
    h = _hist(spark, sf, with_id=True)
    return G.hourly_kpis(h)
