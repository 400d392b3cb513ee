"""Registered queries: scans, sinks, upsert, as-of, history, retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonecast.functions import constants as K
from zonecast.operators import gold as G
from zonecast.operators import published as P
from zonecast.operators import silver as S
from zonecast.operators import tables as T
from zonecast.plans.catalog import register
from zonecast.plans.oracle import (
    add_view, count_if_sql, mean2_sql, money_sum_sql, money_times_sql, parse_sql, with_views,
)
from zonecast.session import materialize, work_dir
from zonecast.sources import fixtures as X

AS_OF = "2024-01-03 00:00:00"
RETENTION_AS_OF = "2024-01-10 00:00:00"
VERSION_KEYS = ["o_custkey"]
VERSION_ORDER = ["commit_version", "o_orderkey"]
UPSERT_KEYS = G.GOLD_KEYS


@register("table_scan", """
SELECT event_id, user_id, event_type, value, ts FROM events""", "S7")
def table_scan(spark, sf):
    """The whole events table, and a table that does not exist: an empty frame of the given schema."""
    df = T.read_table(spark, f"{sf}/events.parquet").select("event_id", "user_id", "event_type", "value", "ts")
    return df.unionByName(T.read_table(spark, f"{sf}/no_such_table.parquet", df.schema))


@register("ensure_table", with_views("rides_raw") + "SELECT * FROM rides_raw", "S4")
def ensure_table(spark, sf):
    from zonecast.sources.schemas import RIDE_SCHEMA

    path = work_dir(spark, "ensure") + "/bronze_rides"
    T.ensure_table(spark, path, RIDE_SCHEMA, ["city_zone"])  # absent: created empty
    T.write_table(X.rides_raw(spark, sf), path, "append", ["city_zone"])
    T.ensure_table(spark, path, RIDE_SCHEMA, ["city_zone"])  # present: left as it is, never truncated
    return spark.read.schema(RIDE_SCHEMA).parquet(path)


@register("table_write", with_views("rides") + "SELECT * FROM rides", "S8")
def table_write(spark, sf):
    path = work_dir(spark, "write") + "/silver_rides"
    silver = X.rides(spark, sf)
    T.write_table(silver, path, "overwrite", ["event_date"])
    # rewrite one day: dynamic partition overwrite replaces only that partition
    one_day = silver.filter(F.col("event_date") == F.lit("2024-01-02").cast("date"))
    T.write_table(one_day, path, "overwrite", ["event_date"])
    return spark.read.parquet(path)


# ---------------------------------------------------------------- upsert

add_view("upsert_src_rides", ["rides_bronze"], f"""
    SELECT *, CAST(event_ts AS DATE) AS event_date, CAST(hour(event_ts) AS INTEGER) AS event_hour,
           status = 'completed' AS is_completed,
           {money_times_sql('fare_base_inr', 'surge_multiplier')} AS gross_fare_inr
    FROM (SELECT *, {parse_sql('event_timestamp')} AS event_ts FROM rides_bronze)""")

add_view("gold_dirty", ["silver_dirty"], f"""
    SELECT event_date, event_hour, city_zone, count(ride_id) AS ride_count, {count_if_sql('is_completed')} AS completed_rides,
           {count_if_sql("status = 'cancelled'")} AS cancelled_rides, {money_sum_sql('gross_fare_inr')} AS gross_revenue_inr,
           {mean2_sql('surge_multiplier')} AS avg_surge_multiplier
    FROM silver_dirty GROUP BY event_date, event_hour, city_zone""")

_KPI = f"""count(ride_id) AS ride_count, {count_if_sql('is_completed')} AS completed_rides,
           {count_if_sql("status = 'cancelled'")} AS cancelled_rides,
           {money_sum_sql('gross_fare_inr')} AS gross_revenue_inr,
           {mean2_sql('surge_multiplier')} AS avg_surge_multiplier"""


@register("upsert", with_views("gold", "upsert_src_rides") + f"""
SELECT * FROM gold g WHERE g.event_date < DATE '2024-01-21'
  AND NOT EXISTS (SELECT 1 FROM upsert_src_rides s
                  WHERE s.event_date >= DATE '2024-01-16'
                    AND s.event_date IS NOT DISTINCT FROM g.event_date
                    AND s.event_hour IS NOT DISTINCT FROM g.event_hour
                    AND s.city_zone IS NOT DISTINCT FROM g.city_zone)
UNION ALL
SELECT event_date, event_hour, city_zone, {_KPI}
FROM upsert_src_rides WHERE event_date >= DATE '2024-01-16'
GROUP BY event_date, event_hour, city_zone""", "J1 U3")
def upsert(spark, sf):
    """Target: gold of the first 20 days. Source: gold of the last 15 days recomputed from
    the bronze rides (redelivered copies included, so matching keys change value)."""
    target = G.hourly_kpis(X.rides(spark, sf)).filter(F.col("event_date") < F.lit("2024-01-21").cast("date"))
    source = (S.enrich_rides(X.rides_bronze(spark, sf))
              .filter(F.col("event_date") >= F.lit("2024-01-16").cast("date"))
              .transform(G.hourly_kpis))  # U3: the user transform applied before the merge
    return T.merge_upsert(target, source, UPSERT_KEYS)


_TOUCHED = "(city_zone IS NULL OR city_zone IN ('cbd', 'mall'))"


@register("upsert_table", with_views("gold_dirty") + f"""
SELECT * FROM gold_dirty WHERE NOT coalesce({_TOUCHED} AND event_date >= DATE '2024-01-16', false)
UNION ALL
SELECT event_date, event_hour, city_zone, ride_count + 1, completed_rides, cancelled_rides, gross_revenue_inr, avg_surge_multiplier
FROM gold_dirty WHERE {_TOUCHED} AND event_date >= DATE '2024-01-16'
UNION ALL
SELECT event_date, event_hour, '007', ride_count, completed_rides, cancelled_rides, gross_revenue_inr, avg_surge_multiplier
FROM gold_dirty WHERE city_zone = 'cbd'""", "J1")
def upsert_table(spark, sf):
    """The merge through storage on the full hourly KPIs of rides with null zones and times, a partition per zone: changed rows in some
    partitions (the null partition among them), a new partition whose name looks like a number, and partitions that are not touched."""
    path = work_dir(spark, "upsert") + "/gold"
    gold = materialize(G.hourly_kpis(S.silver_rides(X.rides_dirty(spark, sf))))
    P.publish_upsert(spark, gold, path, UPSERT_KEYS, ["city_zone"])
    changed = gold.where((F.col("city_zone").isNull() | F.col("city_zone").isin("cbd", "mall")) &
                         (F.col("event_date") >= F.lit("2024-01-16").cast("date"))).withColumn("ride_count", F.col("ride_count") + 1)
    new = gold.where(F.col("city_zone") == "cbd").withColumn("city_zone", F.lit("007"))
    P.publish_upsert(spark, changed.unionByName(new), path, UPSERT_KEYS, ["city_zone"])
    return P.read_published(spark, path)


# ---------------------------------------------------------------- version table

def version_table(spark, sf) -> str:
    """The fixture's commits, written one after another by the version writer."""
    path = work_dir(spark, "versions") + "/orders"
    v = X.versions(spark, sf)
    for n in range(5):
        T.append_version(spark, v.where(F.col("commit_version") == n).drop("commit_version", "committed_at"), path,
                         "CREATE" if n == 0 else "APPEND", f"2024-01-0{n + 1} 00:00:00")
    return path


VERSION_COLUMNS = ["o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "commit_version", "committed_at", "operation"]


def read_versions(spark, path):
    return spark.read.parquet(path).select(*VERSION_COLUMNS)


VERSIONED = "(SELECT *, CASE commit_version WHEN 0 THEN 'CREATE' ELSE 'APPEND' END AS operation FROM versions)"


@register("as_of_read", with_views("versions") + f"""
SELECT * FROM {VERSIONED} WHERE committed_at <= TIMESTAMP '{AS_OF}'
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY commit_version DESC, o_orderkey DESC) = 1""", "S10")
def as_of_read(spark, sf):
    return T.read_as_of(spark, version_table(spark, sf), AS_OF, VERSION_KEYS, VERSION_ORDER).select(*VERSION_COLUMNS)


@register("version_history", with_views("versions") + """
SELECT commit_version, max(committed_at) AS committed_at, count(*) AS num_rows,
       count(DISTINCT o_custkey) AS num_keys,
       CASE WHEN commit_version = 0 THEN 'CREATE' ELSE 'APPEND' END AS operation
FROM versions GROUP BY commit_version ORDER BY commit_version DESC LIMIT 10""", "S11 T3")
def version_history(spark, sf):
    return T.version_history(read_versions(spark, version_table(spark, sf)), VERSION_KEYS, 10)


@register("retention_filter", with_views("versions") + f"""
SELECT * FROM {VERSIONED} WHERE committed_at >= TIMESTAMP '{RETENTION_AS_OF}' - INTERVAL {K.RETENTION_HOURS} HOUR
UNION ALL
SELECT * FROM {VERSIONED} WHERE committed_at < TIMESTAMP '{RETENTION_AS_OF}' - INTERVAL {K.RETENTION_HOURS} HOUR
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY commit_version DESC, o_orderkey DESC) = 1""", "S12")
def retention_filter(spark, sf):
    """Retention through storage: the table is rewritten in place, then read back."""
    path = version_table(spark, sf)
    T.apply_retention(spark, path, RETENTION_AS_OF, K.RETENTION_HOURS, VERSION_KEYS, VERSION_ORDER)
    return read_versions(spark, path)


_AT_HORIZON = f"TIMESTAMP '{RETENTION_AS_OF}' - INTERVAL {K.RETENTION_HOURS} HOUR"


@register("retained_as_of", with_views("versions") + f"""
SELECT 'horizon' AS read_at, * FROM {VERSIONED} WHERE committed_at <= {_AT_HORIZON}
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY commit_version DESC, o_orderkey DESC) = 1
UNION ALL
SELECT 'later', * FROM {VERSIONED} WHERE committed_at <= TIMESTAMP '2024-01-04 12:00:00'
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY commit_version DESC, o_orderkey DESC) = 1""", "S10 S12")
def retained_as_of(spark, sf):
    """As-of reads behind retention, at the horizon and later: what they were before it. An earlier read must fail."""
    path = version_table(spark, sf)
    T.apply_retention(spark, path, RETENTION_AS_OF, K.RETENTION_HOURS, VERSION_KEYS, VERSION_ORDER)
    try:
        T.read_as_of(spark, path, "2024-01-01 12:00:00", VERSION_KEYS, VERSION_ORDER)
    except ValueError:
        pass
    else:
        raise AssertionError("a read before the horizon did not fail")
    horizon = str(T.retention_horizon(spark, path))
    reads = [T.read_as_of(spark, path, at, VERSION_KEYS, VERSION_ORDER).select(F.lit(name).alias("read_at"), *VERSION_COLUMNS)
             for name, at in (("horizon", horizon), ("later", "2024-01-04 12:00:00"))]
    return reads[0].unionByName(reads[1])
