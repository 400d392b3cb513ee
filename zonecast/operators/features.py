"""Feature preparation (P10, P14-P16, M1) and data profiles.

The one-hot vocabulary is fixed from the domain constants (plus "unknown"), so
training and scoring always see the same columns (the source rebuilt dummies
from every batch, so they could drift).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions import columns as C
from zonecast.functions import constants as K
from zonecast.operators.quantiles import exact_quantiles
from zonecast.session import materialize, with_scalars

UNKNOWN = "unknown"
VOCAB = {
    "city_zone": [z[0] for z in K.ZONES] + [UNKNOWN],
    "vehicle_type": K.VEHICLE_TYPES + [UNKNOWN],
    "weather": K.WEATHER_STATES + [UNKNOWN],
    "status": K.RIDE_STATUSES + [UNKNOWN],
}


def dummy_name(col: str, value: str) -> str:
    return f"{col}_{re.sub(r'[^0-9A-Za-z_]', '_', value)}"


def feature_frame(df: DataFrame, keep: tuple[str, ...] = ("ride_id",)) -> DataFrame:
    """Hour from the event time when no hour column exists (unparseable -> 0);
    missing categorical columns "unknown", missing numeric 0.0, null categories
    "unknown"; target = surge, or 1.0 when the frame has none."""
    cols = set(df.columns)
    out = [F.col(c) for c in keep if c in cols]
    for c in K.CATEGORICAL_FEATURES:
        out.append((F.coalesce(F.col(c), F.lit(UNKNOWN)) if c in cols else F.lit(UNKNOWN)).alias(c))
    for c in K.NUMERIC_FEATURES:
        if c in cols:
            out.append(F.col(c))
        elif c == "event_hour" and "event_timestamp" in cols:
            out.append(F.coalesce(F.hour(C.parse_event_ts("event_timestamp")), F.lit(0)).alias(c))
        else:
            out.append(F.lit(0.0).alias(c))
    out.append((F.col(K.TARGET) if K.TARGET in cols else F.lit(1.0)).alias(K.TARGET))
    return df.select(*out)


def one_hot(frame: DataFrame, keep: tuple[str, ...] = ("ride_id",)) -> DataFrame:
    """M1: numeric features plus a 0/1 column per vocabulary value of each categorical."""
    dummies = [(F.col(c) == v).cast("int").alias(dummy_name(c, v)) for c, vals in VOCAB.items() for v in vals]
    return frame.select(*[c for c in keep if c in frame.columns], *K.NUMERIC_FEATURES, *dummies)


def score_input(silver: DataFrame) -> DataFrame:
    """P10: the scoring projection, hour defaulting to 0."""
    return silver.select("ride_id", "event_ts", *K.CATEGORICAL_FEATURES, "distance_km", "fare_base_inr",
                         F.coalesce(F.col("event_hour"), F.lit(0)).alias("event_hour"), K.TARGET)


def feature_correlation(frame: DataFrame, places: int = 6) -> DataFrame:
    """Pearson correlation of each numeric feature with the target, rounded."""
    aggs = F.array(*[F.struct(F.lit(c).alias("feature"),
                              F.round(F.corr(F.col(c).cast("double"), F.col(K.TARGET)), places).alias("correlation"))
                     for c in K.NUMERIC_FEATURES])
    return frame.agg(aggs.alias("r")).select(F.inline("r"))


def surge_histogram(frame: DataFrame, bins: int = 30, col: str = K.TARGET) -> DataFrame:
    """Equal-width bins of the raw values between min and max (last bin closed), all bins listed."""
    x = F.col(col).cast("double")
    # one pass for the bounds; the single row is materialised because two branches read it
    stats = materialize(frame.agg(F.min(x).alias("lo"), F.max(x).alias("hi")))
    lo, hi = F.col("_s.lo"), F.col("_s.hi")
    width = hi - lo
    binned = with_scalars(frame.select(x.alias("x")).filter(F.col("x").isNotNull()), "_s", stats).select(
        F.when(width > 0, F.least(F.lit(bins - 1), F.floor((F.col("x") - lo) * F.lit(float(bins)) / F.nullif(width, F.lit(0.0))).cast("int")))
        .otherwise(F.lit(0)).alias("bin"))
    counts = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    # the bin list is the operator's own 0..bins-1, shown even when a bin is empty
    all_bins = with_scalars(frame.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")), "_s", stats)
    return (all_bins.join(counts, "bin", "left").select(
        "bin", (lo + F.col("bin") * width / F.lit(float(bins))).alias("bin_start"), F.coalesce(F.col("count"), F.lit(0)).alias("count")))


def describe(frame: DataFrame, col: str = K.TARGET) -> DataFrame:
    """Count, mean, sample sd (nine places), min, quartiles (linear interpolation), max of the raw values. The quartiles are selected
    exactly in a few passes (``quantiles``), so memory does not grow with the number of distinct values."""
    x = F.col(col).cast("double")
    values = frame.select(x.alias("x")).where("x is not null and not isnan(x)")
    quartiles = exact_quantiles(values, "x", [0.25, 0.5, 0.75])
    return values.agg(
        F.count("x").alias("n"), F.round(F.avg("x"), 9).alias("mean"), F.round(F.stddev_samp("x"), 9).alias("std"), F.min("x").alias("min"),
        *[F.lit(q).cast("double").alias(name) for name, q in zip(("p25", "p50", "p75"), quartiles, strict=True)], F.max("x").alias("max"))
