"""Registered queries: features, profiles, model metrics and promotion, training and scoring."""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions import columns as C
from zonecast.functions import constants as K
from zonecast.operators import features as FE
from zonecast.operators import history as H
from zonecast.operators import model as MO
from zonecast.operators import ordered as O
from zonecast.operators import silver as S
from zonecast.operators import splits as SP
from zonecast.operators import tables as T
from zonecast.plans import history  # noqa: F401  (adds the view of historical rides)
from zonecast.plans.catalog import register
from zonecast.plans.oracle import RIDE_COLS, add_view, parse_sql, surge_rule_sql, with_views
from zonecast.session import checkpoint_root, materialize, work_dir
from zonecast.sources import events as EV
from zonecast.sources import fixtures as X
from zonecast.sources.schemas import RIDE_SCHEMA

LIVE_AS_OF = "2024-02-01 00:00:00"

# ---------------------------------------------------------------- features

_FEATURE_SQL = f"""
SELECT ride_id, coalesce(city_zone, 'unknown') AS city_zone, coalesce(vehicle_type, 'unknown') AS vehicle_type,
       coalesce(weather, 'unknown') AS weather, coalesce(status, 'unknown') AS status,
       distance_km, fare_base_inr,
       coalesce(CAST(hour({parse_sql('event_timestamp')}) AS INTEGER), 0) AS event_hour,
       surge_multiplier
FROM rides_dirty"""


@register("feature_frame", with_views("rides_dirty") + _FEATURE_SQL, "P14-P16")
def feature_frame(spark, sf):
    return FE.feature_frame(X.rides_dirty(spark, sf))


def _dummy_sql() -> str:
    return ", ".join(f"CAST({c} = '{v}' AS INTEGER) AS {FE.dummy_name(c, v)}"
                     for c, vals in FE.VOCAB.items() for v in vals)


@register("one_hot", with_views("rides_dirty") + f"""
SELECT ride_id, distance_km, fare_base_inr, event_hour, {_dummy_sql()} FROM ({_FEATURE_SQL})""", "M1 D4")
def one_hot(spark, sf):
    return FE.one_hot(FE.feature_frame(X.rides_dirty(spark, sf)))


@register("score_input", with_views("silver_dirty") + """
SELECT ride_id, event_ts, city_zone, vehicle_type, weather, status, distance_km, fare_base_inr,
       coalesce(event_hour, 0) AS event_hour, surge_multiplier
FROM silver_dirty""", "P10")
def score_input(spark, sf):
    return FE.score_input(S.silver_rides(X.rides_dirty(spark, sf)))


# ---------------------------------------------------------------- profiles

@register("feature_correlation", with_views("rides") + """
SELECT 'distance_km' AS feature, round(corr(distance_km, surge_multiplier), 6) AS correlation FROM rides
UNION ALL SELECT 'fare_base_inr', round(corr(fare_base_inr, surge_multiplier), 6) FROM rides
UNION ALL SELECT 'event_hour', round(corr(CAST(event_hour AS DOUBLE), surge_multiplier), 6) FROM rides""", "A22")
def feature_correlation(spark, sf):
    return FE.feature_correlation(X.rides(spark, sf))




@register("surge_histogram", with_views("rides_fine") + """
, s AS (SELECT min(surge_multiplier) AS lo, max(surge_multiplier) AS hi FROM rides_fine)
SELECT b.bin, s.lo + b.bin * (s.hi - s.lo) / 30.0::DOUBLE AS bin_start, coalesce(c.cnt, 0) AS count
FROM s CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range(30)) b
LEFT JOIN (SELECT least(29, CAST(floor((surge_multiplier - s.lo) * 30.0::DOUBLE / (s.hi - s.lo)) AS INTEGER)) AS bin, count(*) AS cnt
           FROM rides_fine, s WHERE surge_multiplier IS NOT NULL GROUP BY 1) c ON c.bin = b.bin""", "A23")
def surge_histogram(spark, sf):
    return FE.surge_histogram(X.rides_fine(spark, sf))


_SPREAD = "(fare_base_inr * surge_multiplier / 7.0::DOUBLE)"


@register("surge_describe", with_views("rides_fine") + f"""
SELECT measure, count(x) AS n, round(avg(x), 9) AS mean, round(stddev_samp(x), 9) AS std, min(x) AS min,
       quantile_cont(x, 0.25) AS p25, quantile_cont(x, 0.5) AS p50, quantile_cont(x, 0.75) AS p75, max(x) AS max
FROM (SELECT 'surge_multiplier' AS measure, surge_multiplier AS x FROM rides_fine
      UNION ALL SELECT 'fare_share', {_SPREAD} FROM rides_fine) GROUP BY measure""", "A24")
def surge_describe(spark, sf):
    """The surge, and a measure whose values are nearly all different."""
    share = F.col("fare_base_inr") * F.col("surge_multiplier") / F.lit(7.0)
    # both measures of one run over the rides; the quartiles' passes read these two columns alone
    rides = materialize(X.rides_fine(spark, sf).select("surge_multiplier", share.alias("share")))
    return (FE.describe(rides).withColumn("measure", F.lit("surge_multiplier"))
            .unionByName(FE.describe(rides, "share").withColumn("measure", F.lit("fare_share"))))


# ---------------------------------------------------------------- metrics, residuals, promotion

def _metrics_sql(y: str, p: str) -> str:
    return (f"count({y}) AS n, round(avg(abs({y} - {p})), 9) AS mae, round(sqrt(avg(({y} - {p}) ** 2)), 9) AS rmse, "
            f"round(CASE WHEN var_pop({y}) > 0 THEN 1 - sum(({y} - {p}) ** 2) / (var_pop({y}) * count({y})) END, 9) AS r2")


@register("regression_metrics", with_views("scored") + f"""
SELECT {_metrics_sql('label', 'prediction')} FROM scored WHERE label IS NOT NULL AND prediction IS NOT NULL""", "A25")
def regression_metrics(spark, sf):
    return MO.regression_metrics(X.scored(spark, sf))


@register("residuals", with_views("scored") + """
SELECT ride_id, label, prediction, label - prediction AS residual FROM scored""", "M7")
def residuals(spark, sf):
    return MO.residuals(X.scored(spark, sf))


add_view("model_runs", ["scored"], f"""
    SELECT model || '-' || strftime(event_date, '%Y%m%d') AS run_id, model, event_date, n, mae, rmse, r2, start_time
    FROM (SELECT event_date, model, {_metrics_sql('label', 'p')}, max(event_ts) AS start_time
          FROM (SELECT CAST(event_ts AS DATE) AS event_date, event_ts, label, prediction AS p,
                       '{MO.LIVE_MODEL}' AS model FROM scored
                UNION ALL
                SELECT CAST(event_ts AS DATE), event_ts, label, prediction_alt, '{MO.HIST_MODEL}' FROM scored)
          GROUP BY event_date, model)""")


@register("promotion_gate", with_views("model_runs") + f"""
SELECT event_date, model, run_id, mae, mae < {K.PROMOTION_MAE_THRESHOLD} AS promoted
FROM model_runs
QUALIFY row_number() OVER (PARTITION BY event_date
                           ORDER BY mae, CASE WHEN model = '{MO.HIST_MODEL}' THEN 0 ELSE 1 END, model, run_id) = 1""",
          "M4")
def promotion_gate(spark, sf):
    return MO.promotion_gate(MO.model_runs_from_scores(X.scored(spark, sf)))


@register("run_leaderboard", with_views("model_runs") + """
SELECT * FROM model_runs ORDER BY start_time DESC, run_id DESC LIMIT 10""", "M8 T3")
def run_leaderboard(spark, sf):
    return MO.leaderboard(MO.model_runs_from_scores(X.scored(spark, sf)))


# ---------------------------------------------------------------- surge audit, live defaults, JSON decode

@register("surge_audit", with_views("silver_dirty") + f"""
SELECT city_zone, count(*) AS rows,
       CAST(sum(CASE WHEN surge_multiplier IS NOT DISTINCT FROM
                          CAST({surge_rule_sql('city_zone', 'event_hour', 'weather')} AS DOUBLE) / 100.0
                     THEN 0 ELSE 1 END) AS BIGINT) AS mismatched
FROM silver_dirty GROUP BY city_zone""", "P26")
def surge_audit(spark, sf):
    s = S.silver_rides(X.rides_dirty(spark, sf))
    rule = C.surge_rule("city_zone", "event_hour", "weather")
    return s.groupBy("city_zone").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.when(F.col("surge_multiplier").eqNullSafe(rule), 0).otherwise(1)).alias("mismatched"))


@register("live_defaults", with_views("rides_dirty") + f"""
SELECT ride_id, coalesce({parse_sql('event_timestamp')}, TIMESTAMP '{LIVE_AS_OF}') AS event_ts,
       coalesce(city_zone, 'unknown') AS city_zone, coalesce(surge_multiplier, 1.0::DOUBLE) AS surge_multiplier
FROM rides_dirty""", "P28")
def live_defaults(spark, sf):
    d = X.rides_dirty(spark, sf)
    return d.select("ride_id",
                    F.coalesce(C.parse_event_ts("event_timestamp"), F.lit(LIVE_AS_OF).cast("timestamp")).alias("event_ts"),
                    F.coalesce(F.col("city_zone"), F.lit("unknown")).alias("city_zone"),
                    F.coalesce(F.col("surge_multiplier"), F.lit(1.0)).alias("surge_multiplier"))


def encoded_rides(spark, sf):
    """Ride events as JSON documents: every 97th one is truncated (undecodable), every 89th has a text for its distance."""
    r = X.ride_events(spark, sf)
    plain = F.to_json(F.struct(*X.RIDE_COLUMNS))
    text = F.when(F.pmod("event_id", F.lit(89)) == 0,
                  F.regexp_replace(plain, r'"distance_km":[^,]+', '"distance_km":"oops"')).otherwise(plain)
    return r.select(F.when(F.pmod("event_id", F.lit(97)) == 0, F.substring(text, 1, 20)).otherwise(text)
                    .alias("value"))


_DECODED = RIDE_COLS.replace("distance_km", "CASE WHEN event_id % 89 <> 0 THEN distance_km END AS distance_km")


@register("json_decode", with_views("rides_f") + f"SELECT {_DECODED} FROM rides_f WHERE event_id % 97 <> 0", "S2")
def json_decode(spark, sf):
    return EV.decode_events(encoded_rides(spark, sf), RIDE_SCHEMA)


@register("json_rejects", with_views("rides_f") + """
SELECT substr('{"ride_id":"' || ride_id || '","event_timestamp"', 1, 20) AS json_str FROM rides_f WHERE event_id % 97 = 0""", "S2")
def json_rejects(spark, sf):
    """The documents that gave no field, with their text."""
    return EV.decode_rejects(encoded_rides(spark, sf), RIDE_SCHEMA)


# ---------------------------------------------------------------- training and scoring

def _folders(spark, sf) -> dict[str, str]:
    """Run table, promoted runs and models of this session's training queries, below the shared folder."""
    name = hashlib.md5(f"{spark.sparkContext.applicationId}:{sf}".encode()).hexdigest()[:12]
    root = f"{checkpoint_root(spark).rstrip('/')}/zonecast-models/{name}"
    return {"runs": f"{root}/runs", "models": f"{root}/models", "promoted": f"{root}/promoted"}


def live_split(spark, sf):
    """Train and test rows, from one stored frame."""
    frame = FE.score_input(X.rides(spark, sf)).filter(F.col(K.TARGET).isNotNull())
    split = materialize(SP.hash_split(frame, F.col("ride_id"), 0.8).select(*K.CATEGORICAL_FEATURES, *K.NUMERIC_FEATURES, K.TARGET, "split"))
    return split.filter(F.col("split") == "train"), split.filter(F.col("split") == "test")


def train_live(spark, sf):
    """Train, log and promote the live model; returns its metrics row and its test rows."""
    at = _folders(spark, sf)
    train, test = live_split(spark, sf)
    model, metrics = MO.train(train, test, MO.LIVE_MODEL)
    metrics = materialize(metrics)
    MO.log_run(spark, model, metrics, at["runs"], at["models"])
    MO.promote_run(spark, at["runs"], at["promoted"])
    return metrics, test


def promoted_model(spark, sf):
    """The promoted model from its path; trained first where this session has none."""
    at = _folders(spark, sf)
    if not T.table_exists(spark, at["promoted"]):
        train_live(spark, sf)
    return MO.load_promoted(spark, at["promoted"])


def _checked(metrics, test_df):
    """A run as invariants: rows judged, and whether it beats the mean of its test rows."""
    spread = test_df.agg(F.avg(F.abs(F.col(K.TARGET) - test_df.agg(F.avg(K.TARGET)).scalar())).alias("s"))
    return metrics.select("model", "n", (F.col("mae") < spread.scalar()).alias("beats_mean"), (F.col("mae") <= F.col("rmse")).alias("ordered"))


_SPLIT_SQL = "('0x' || substr(md5({id} || ':42'), 1, 8))::BIGINT % 1000000 < 800000"


@register("train_surge", with_views("rides") + f"""
SELECT '{MO.LIVE_MODEL}' AS model, count(*) AS n, true AS beats_mean, true AS ordered
FROM rides WHERE surge_multiplier IS NOT NULL AND NOT ({_SPLIT_SQL.format(id='ride_id')})""", "M2")
def train_surge(spark, sf):
    return _checked(*train_live(spark, sf))


@register("score_batch", with_views("silver_dirty") + """
SELECT ride_id, event_ts, city_zone, vehicle_type, surge_multiplier, true AS in_band FROM silver_dirty""", "U1 U2 P27")
def score_batch(spark, sf):
    preds = MO.score(FE.score_input(S.silver_rides(X.rides_dirty(spark, sf))), promoted_model(spark, sf))
    return preds.select("ride_id", "event_ts", "city_zone", "vehicle_type", "surge_multiplier",
                        F.col("predicted_surge_multiplier").between(K.SURGE_MIN, K.SURGE_MAX).alias("in_band"))


@register("feature_importance", "SELECT unnest(['" + "', '".join(sorted(K.NUMERIC_FEATURES + K.CATEGORICAL_FEATURES)) + """']) AS feature,
       true AS in_range, 1.0::DOUBLE AS total""", "M6 T3")
def feature_importance(spark, sf):
    frame = FE.score_input(X.rides(spark, sf))
    found = MO.feature_importance(spark, promoted_model(spark, sf), frame, 15)
    return found.select("feature", F.col("importance").between(0, 1).alias("in_range"),
                        F.round(found.agg(F.sum("importance")).scalar(), 6).alias("total"))


def train_history(feats):
    """Two models from one stored frame, fitted side by side: on the earlier 80 % of trips (registered model) and on a hash split of 80 %
    (comparison). Returns (time model, random model, frame with ``time_split`` and ``split``)."""
    timed = O.chronological_split(feats, "event_timestamp", "ride_id", 0.8).withColumnRenamed("split", "time_split")
    frame = materialize(SP.hash_split(timed, F.col("ride_id"), 0.8))
    with ThreadPoolExecutor(2) as pool:
        fits = [pool.submit(MO.fit, frame.where(F.col(side) == "train")) for side in ("time_split", "split")]
        models = [f.result() for f in fits]
    return (*models, frame)


def leakage_report(time_model, random_model, frame, names):
    """M3: each model on its own test rows, and the random model on the later rows that the time model is judged by. ``n_seen`` of
    those it was trained on: what it gains there is the leak that a random split hides."""
    later, held = frame.where(F.col("time_split") == "test"), frame.where(F.col("split") == "test")
    seen = later.agg(F.count_if(F.col("split") == "train")).scalar()
    rows = []
    for model, name, rows_of, test, n_seen in ((time_model, names[0], "later", later, F.lit(0)), (random_model, names[1], "random", held, F.lit(0)),
                                                (random_model, names[1], "later", later, seen)):
        spread = test.agg(F.avg(F.abs(F.col(K.TARGET) - test.agg(F.avg(K.TARGET)).scalar())))
        rows.append(MO.evaluate(test, model, name).withColumns({"test_rows": F.lit(rows_of), "n_seen": n_seen.cast("bigint"),
                                                               "mean_predictor_mae": spread.scalar()}))
    return reduce(DataFrame.unionByName, rows)


_HIST_SPLIT = """
, hist_rows AS (SELECT 'nyc-' || l_orderkey || '-' || l_linenumber AS ride_id, l_shipdate + (l_partkey % 24) * INTERVAL 1 HOUR AS event_timestamp
                FROM lineitem WHERE l_shipdate IS NOT NULL AND l_extendedprice / 1000 + 0.01::DOUBLE <> 0 AND l_discount IS NOT NULL),
  sides AS (SELECT ride_id, row_number() OVER (ORDER BY event_timestamp, ride_id) > floor(count(*) OVER () * 0.8::DOUBLE) AS later,
                   NOT (""" + _SPLIT_SQL.format(id="ride_id") + """) AS held FROM hist_rows)"""


@register("train_historical", "WITH one AS (SELECT 1)" + _HIST_SPLIT + f"""
SELECT '{MO.HIST_MODEL}' AS model, 'later' AS test_rows, (SELECT count(*) FROM sides WHERE later) AS n, 0::BIGINT AS n_seen,
       true AS near_mean, false AS gains
UNION ALL
SELECT '{MO.HIST_MODEL}_random_split', 'random', (SELECT count(*) FROM sides WHERE held), 0, true, false
UNION ALL
SELECT '{MO.HIST_MODEL}_random_split', 'later', (SELECT count(*) FROM sides WHERE later), (SELECT count(*) FROM sides WHERE later AND NOT held), true, true
""", "M3 W4 W5")
def train_historical(spark, sf):
    """The fixture's tips follow no feature, so no honest model can do better than their mean (``near_mean``: not 5 % worse either). On the
    later rows the random model does better than the time model (``gains``), as it has seen most of them."""
    trips = X.trips(spark, sf, id_columns=("l_orderkey", "l_linenumber"))
    feats = FE.feature_frame(H.historical_silver(trips, with_id=True), keep=("ride_id", "event_timestamp")).filter(F.col(K.TARGET).isNotNull())
    names = (MO.HIST_MODEL, MO.HIST_MODEL + "_random_split")
    model, other, frame = train_history(feats)
    report = materialize(leakage_report(model, other, frame, names))
    at = _folders(spark, sf)
    logged = {rows_of: report.where(F.col("test_rows") == rows_of).select("model", "n", "mae", "rmse", "r2", "start_time") for rows_of in ("later", "random")}
    MO.log_run(spark, model, logged["later"].where(F.col("model") == names[0]), at["runs"], at["models"])
    # beside the candidates, so that it is never promoted
    MO.log_run(spark, other, logged["random"], MO.comparison_path(at["runs"]), at["models"])
    MO.promote_run(spark, at["runs"], at["promoted"])
    honest = report.where((F.col("test_rows") == "later") & (F.col("model") == names[0])).select("mae").scalar()
    gains = (F.col("test_rows") == "later") & (F.col("model") == names[1]) & (F.col("mae") < honest)
    return report.select("model", "test_rows", "n", "n_seen", (F.col("mae") < 1.05 * F.col("mean_predictor_mae")).alias("near_mean"),
                         gains.alias("gains"))


@register("historical_load", with_views("hist") + "SELECT * FROM hist", "M5 S9 S8")
def historical_load(spark, sf):
    """Load the historical silver table only when it is absent or empty (second call skips)."""
    path = work_dir(spark, "history") + "/rides_historical"
    for _ in range(2):
        if T.table_exists(spark, path) and spark.read.parquet(path).limit(1).count() > 0:
            continue
        T.write_table(H.historical_silver(X.trips(spark, sf, with_row_id=True)), path, "append")
    # the id is the file's row number, which SQL cannot name
    return spark.read.parquet(path).drop("ride_id")
