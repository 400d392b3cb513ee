"""Historical taxi trips mapped onto the silver ride schema (P17-P23, J3/P21) and their KPIs (A3).

The source did this in single-machine pandas; here it is one projection, one
single-row aggregate (min / max tip ratio) cross-joined back, and the usual
gold aggregate. Real-valued products are rounded half-up to cents as
floor(x * 100 + 0.5) with every literal a double.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions import columns as C
from zonecast.functions import constants as K
from zonecast.session import with_scalars


def tip_ratio(trips: DataFrame):
    """tip / (fare + 0.01); a zero denominator gives null instead of infinity."""
    return F.try_divide(F.col("tip_amount"), F.col("fare_amount") + F.lit(K.TIP_RATIO_EPSILON))


def minmax_scale(df: DataFrame, col: str, out: str, lo: float = K.SURGE_MIN, hi: float = K.SURGE_MAX) -> DataFrame:
    """Scale ``col`` linearly onto [lo, hi] using its global min and max; a constant
    column maps to ``lo``. Min and max are one aggregate over the same frame, attached as a
    scalar subquery (evaluated once; every task gets the two values)."""
    x = F.col(col)
    stats = df.agg(F.min(col).alias("mn"), F.max(col).alias("mx"))
    mn, mx = F.col("_mm.mn"), F.col("_mm.mx")
    scaled = F.when(mx == mn, F.lit(lo)).otherwise(F.lit(lo) + (x - mn) / (mx - mn) * F.lit(hi - lo))
    return with_scalars(df, "_mm", stats).withColumn(out, F.when(x.isNotNull(), C.round_half_up_2(scaled))) \
        .drop("_mm")


def with_row_ids(trips: DataFrame) -> DataFrame:
    """``trips`` as read from files, with ``trip_row_id``: file name and the row's place in the file, the same in every load."""
    return trips.select("*", F.concat(F.col("_metadata.file_name"), F.lit(":"), F.col("_metadata.row_index").cast("string")).alias("trip_row_id"))


def historical_silver(trips: DataFrame, nan_text: bool = False, with_id: bool = True) -> DataFrame:
    """TLC trip columns -> silver ride columns."""
    pickup = F.col("tpep_pickup_datetime")
    t = trips.withColumn("tip_ratio", tip_ratio(trips))
    t = minmax_scale(t, "tip_ratio", "surge_multiplier")
    fare = C.round_half_up_2(F.greatest(F.col("fare_amount") * F.lit(K.USD_TO_INR), F.lit(0.0)))
    cols = []
    if with_id:
        cols.append(F.concat(F.lit("nyc-"), F.col("trip_row_id")).alias("ride_id"))
    cols += [
        pickup.alias("event_timestamp"),
        F.to_date(pickup).alias("event_date"),
        F.hour(pickup).alias("event_hour"),
        C.hist_zone("PULocationID", nan_text).alias("city_zone"),
        C.round_half_up_2(F.col("trip_distance") * F.lit(K.MILES_TO_KM)).alias("distance_km"),
        fare.alias("fare_base_inr"),
        "tip_ratio",
        "surge_multiplier",
        C.hist_payment("payment_type").alias("payment_method"),
        F.lit("yellow_taxi").alias("vehicle_type"),
        F.lit(True).alias("is_completed"),
        F.lit("completed").alias("status"),
    ]
    mapped = t.select(*cols)
    return (mapped.withColumn("gross_fare_inr", C.money_times("fare_base_inr", "surge_multiplier"))
            .filter(F.col("event_timestamp").isNotNull()))
