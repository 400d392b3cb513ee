"""Data-quality rules evaluated in one scan of silver and one of gold.

The source ran each rule as its own full-table load; here every silver rule is a
conditional count in the same aggregate (one partial-aggregated pass), gold's row
and zone counts are scalar subqueries, and the single aggregate row is turned into
one row per rule with ``inline``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions import columns as C
from zonecast.functions import constants as K
from zonecast.operators.aggregates import count_if


def _rule(name: str, severity: str, bad, total, passed):
    return F.struct(F.lit(name).alias("rule"), F.lit(severity).alias("severity"),
                    bad.cast("long").alias("bad_rows"), total.cast("long").alias("total_rows"),
                    passed.alias("passed"))


def dq_checks(silver: DataFrame, gold: DataFrame, as_of: str) -> DataFrame:
    """DQ1-DQ4 and A10: (rule, severity, bad_rows, total_rows, passed)."""
    cutoff = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {K.STALE_AFTER_HOURS} HOURS")
    s = silver.agg(
        F.count(F.lit(1)).alias("n"),
        count_if(F.col("ride_id").isNull()).alias("null_ids"),
        count_if(F.col("event_ts") < cutoff).alias("stale"),
        count_if(C.surge_out_of_band("surge_multiplier")).alias("out_of_band"),
    ).withColumn(
        # one scalar subquery (one aggregate over gold), referenced once, carrying both numbers
        "_gold", gold.select(F.struct(F.count(F.lit(1)).alias("rows"),
                                      F.countDistinct("city_zone").alias("zones"))).scalar())
    gold_rows, gold_zones = F.col("_gold.rows"), F.col("_gold.zones")
    n, stale = F.col("n"), F.col("stale")
    # warn only when strictly more than 10 % are stale; an empty table is 0 %
    stale_ok = ~((n > 0) & (stale * 100 > n * int(K.STALE_WARN_FRACTION * 100)))
    rules = F.array(
        _rule("null_ride_id", "fail", F.col("null_ids"), n, F.col("null_ids") == 0),
        _rule("gold_not_empty", "fail", F.when(gold_rows == 0, 1).otherwise(0), gold_rows, gold_rows > 0),
        _rule("gold_zone_count", "info", F.lit(0), gold_zones, gold_zones > 0),
        _rule("stale_events", "warn", stale, n, stale_ok),
        _rule("surge_out_of_band", "fail", F.col("out_of_band"), n, F.col("out_of_band") == 0),
    )
    return s.select(F.inline(rules))


def null_key_rows(df: DataFrame, key: str = "ride_id") -> DataFrame:
    """rows whose key is null."""
    return df.filter(F.col(key).isNull())


def out_of_band_rows(df: DataFrame) -> DataFrame:
    """F2: rows whose surge is outside [1.0, 3.5] (null surge passes)."""
    return df.filter(C.surge_out_of_band("surge_multiplier"))


def stale_rows(df: DataFrame, as_of: str, hours: int = K.STALE_AFTER_HOURS) -> DataFrame:
    """rows older than as_of - hours; unparseable time is never stale."""
    cutoff = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {hours} HOURS")
    return df.filter(F.col("event_ts") < cutoff)
