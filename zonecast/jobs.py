"""Batch and streaming jobs over table paths, composed from the operators.

    python -m zonecast.jobs gold-refresh   --silver PATH --gold PATH [--since DATE]
    python -m zonecast.jobs quality        --silver PATH --gold PATH [--as-of TS]
    python -m zonecast.jobs dashboard      --silver PATH --metrics PATH
    python -m zonecast.jobs retrain        --silver PATH --runs PATH --models PATH
    python -m zonecast.jobs load-history   --trips PATH --history PATH
    python -m zonecast.jobs retrain-history --history PATH --runs PATH --models PATH
    python -m zonecast.jobs promote        --runs PATH --promoted PATH
    python -m zonecast.jobs score          --silver PATH --promoted PATH --predictions PATH
    python -m zonecast.jobs predictions    --silver PATH --promoted PATH --predictions PATH --checkpoint PATH
    python -m zonecast.jobs live-view      --silver PATH --metrics PATH --checkpoint PATH
    python -m zonecast.jobs rejects        --source DIR --entity NAME --table PATH --checkpoint PATH
    python -m zonecast.jobs retention      --table PATH --keys k1,k2 [--hours 168] [--as-of TS]
    python -m zonecast.jobs compact        --silver PATH --compacted PATH [--before DATE]
    python -m zonecast.jobs streams        --rides DIR --drivers DIR --payments DIR --root PATH [--kafka-servers HOSTS]

Each job runs in the session spark-submit provides (or a local one). Failures exit
non-zero and leave target tables as they were.
"""

from __future__ import annotations

import argparse
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions import constants as K
from zonecast.operators import compaction as CO
from zonecast.operators import features as FE
from zonecast.operators import gold as G
from zonecast.operators import history as H
from zonecast.operators import metric_store as MS
from zonecast.operators import metrics as M
from zonecast.operators import model as MO
from zonecast.operators import ordered as O
from zonecast.operators import published as P
from zonecast.operators import quality as Q
from zonecast.operators import splits as SP
from zonecast.operators import tables as T
from zonecast.session import clear_work, ensure_utc, materialize

GOLD_KEYS = G.GOLD_KEYS


def gold_refresh(spark: SparkSession, silver_path: str, gold_path: str, since: str | None = None) -> int:
    """Silver -> hourly KPIs -> keyed upsert into gold, published in one step (``operators/published.py``; read it with
    ``read_published``). Only the touched dates are rewritten: all, or those from ``since`` on (rows without a date are then left alone)."""
    silver = spark.read.parquet(silver_path)
    if since:
        silver = silver.filter(F.col("event_date") >= F.lit(since).cast("date"))
    if not silver.limit(1).collect():
        print("silver is empty: nothing to aggregate")
        return 1
    P.publish_upsert(spark, G.hourly_kpis(silver), gold_path, GOLD_KEYS, partition_by=["event_date"])
    return 0


def quality(spark: SparkSession, silver_path: str, gold_path: str, as_of: str | None = None) -> int:
    """All silver rules in one scan plus the gold checks; exit 1 when a 'fail' rule fails."""
    silver = spark.read.parquet(silver_path)
    if P.pointer(spark, gold_path) is not None:
        gold = P.read_published(spark, gold_path)
    else:
        gold = spark.createDataFrame([], "event_date date, event_hour int, city_zone string, ride_count long")
    as_of = as_of or spark.sql("SELECT CAST(current_timestamp() AS STRING)").first()[0]
    rows = Q.dq_checks(silver, gold, as_of).collect()  # five rule rows
    for r in rows:
        print(f"{r['rule']:20s} {r['severity']:5s} bad={r['bad_rows']} total={r['total_rows']} "
              f"{'ok' if r['passed'] else 'FAILED'}")
    return 1 if any(r["severity"] == "fail" and not r["passed"] for r in rows) else 0


def dashboard(spark: SparkSession, silver_path: str, metrics_path: str) -> int:
    """Write this run's metric rows to the metric store and drop what has expired (``operators/metric_store.py``); readers
    take the newest row alive per key (``read_metrics``)."""
    rows = materialize(M.metric_rows(spark.read.parquet(silver_path)))
    run = uuid.uuid4().hex
    MS.write_metrics(rows, metrics_path, f"dashboard-{run}", 0)
    newest = rows.agg(F.max("written_at").cast("string")).first()[0]
    if newest is not None:
        MS.compact(spark, metrics_path, newest, run)
    return 0


def retrain(spark: SparkSession, silver_path: str, runs_path: str, models_path: str,
            model_name: str = MO.LIVE_MODEL) -> int:
    """Fit on a reproducible 80 % hash split, evaluate on the rest, save the pipeline and
    append the run's metrics to the ``model_runs`` table."""
    silver = spark.read.parquet(silver_path)
    frame = FE.score_input(silver).filter(F.col(K.TARGET).isNotNull())
    if not frame.limit(1).collect():
        print("no data available for training")
        return 1
    split = materialize(SP.hash_split(frame, F.col("ride_id"), 0.8))
    model, metrics = MO.train(split.filter(F.col("split") == "train"), split.filter(F.col("split") == "test"),
                              model_name)
    MO.log_run(spark, model, materialize(metrics), runs_path, models_path)
    return 0


def load_history(spark: SparkSession, trips_path: str, history_path: str) -> int:
    """Historical trips -> silver columns, only when the table is absent or empty. A trip's id is its file's name and its
    place in it, so that it is the same after another load, whatever the split of the files."""
    if T.table_exists(spark, history_path) and spark.read.parquet(history_path).limit(1).count():
        print("history is loaded already")
        return 0
    trips = spark.read.parquet(trips_path)
    T.write_table(H.historical_silver(H.with_row_ids(trips)), history_path, "append")
    return 0


def retrain_history(spark: SparkSession, history_path: str, runs_path: str, models_path: str) -> int:
    """Fit the historical model on the earliest 80 % of trips and log it; a model of a hash split is logged for comparison only,
    in a run table of its own (``MO.comparison_path``), which promotion does not read."""
    feats = FE.feature_frame(spark.read.parquet(history_path), keep=("ride_id", "event_timestamp")).filter(F.col(K.TARGET).isNotNull())
    if not feats.limit(1).collect():
        print("no data available for training")
        return 1
    timed = O.chronological_split(feats, "event_timestamp", "ride_id", 0.8)
    timed = materialize(timed)
    model, metrics = MO.train(timed.filter(F.col("split") == "train"), timed.filter(F.col("split") == "test"), MO.HIST_MODEL)
    MO.log_run(spark, model, materialize(metrics), runs_path, models_path)
    mixed = SP.hash_split(timed.drop("split"), F.col("ride_id"), 0.8)
    model, metrics = MO.train(mixed.filter(F.col("split") == "train"), mixed.filter(F.col("split") == "test"),
                              MO.HIST_MODEL + "_random_split")
    MO.log_run(spark, model, materialize(metrics), MO.comparison_path(runs_path), models_path)
    return 0


def score(spark: SparkSession, silver_path: str, promoted_path: str, predictions_path: str) -> int:
    """Batch predictions of the promoted model."""
    model = MO.load_promoted(spark, promoted_path)
    preds = MO.score(FE.score_input(spark.read.parquet(silver_path)), model)
    (preds.select("ride_id", "event_ts", "city_zone", "vehicle_type", "surge_multiplier", "predicted_surge_multiplier")
     .write.mode("append").partitionBy("city_zone").parquet(predictions_path))
    return 0


def promote(spark: SparkSession, runs_path: str, promoted_path: str, threshold: float = K.PROMOTION_MAE_THRESHOLD) -> DataFrame:
    """Among the newest run of each candidate model, the lower MAE wins (tie -> historical model);
    below the threshold it becomes the promoted model that scoring reads."""
    decision = MO.promote_run(spark, runs_path, promoted_path, threshold)
    row = decision.first()
    print(f"{row['model']} run {row['run_id']} mae={row['mae']:.4f} promoted={row['promoted']}")
    return decision


def retention(spark: SparkSession, table_path: str, keys: list[str], hours: int = K.RETENTION_HOURS,
              as_of: str | None = None) -> int:
    """Keep a version table's history inside the horizon and the newest older row per key; only older commits are
    rewritten, in their own partitions."""
    as_of = as_of or spark.sql("SELECT CAST(current_timestamp() AS STRING)").first()[0]
    T.apply_retention(spark, table_path, as_of, hours, keys)
    return 0


def compact(spark: SparkSession, silver_path: str, compacted_path: str, before: str | None = None) -> int:
    """Publish the closed dates of a streamed silver table in large files (``operators/compaction.py``; read both with ``read_compacted``), and delete
    small files that nobody reads any more. ``before``: first date that stays open, by default that of the watermark at the newest event."""
    silver = spark.read.parquet(silver_path)
    if before is None:
        before = silver.agg((F.max("event_ts") - F.expr(f"INTERVAL {K.WATERMARK_DELAY}")).cast("date").cast("string").alias("d")).first()["d"]
    if before is not None:
        CO.compact_closed(spark, silver_path, compacted_path, silver.schema, before)
        CO.remove_sources(spark, silver_path, compacted_path)
    return 0


def _running(seconds: int = 30):
    from zonecast.streaming.streams import Trigger

    return Trigger(available_now=False, processing_time=f"{seconds} seconds")


def streams(spark: SparkSession, sources: dict[str, str], root: str, trigger_seconds: int = 30, kafka_servers: str | None = None) -> int:
    """The six ingest streams; with ``kafka_servers`` the sources are topics instead of folders."""
    from zonecast.streaming import launcher as L

    queries = L.start_all(spark, sources, root, _running(trigger_seconds), kafka_servers)
    status = L.supervise(queries)
    return 1 if any(s["exception"] for s in status) else 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="zonecast.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    for name, args in {
        "gold-refresh": ["silver", "gold"], "quality": ["silver", "gold"], "dashboard": ["silver", "metrics"],
        "retrain": ["silver", "runs", "models"], "promote": ["runs", "promoted"], "retention": ["table", "keys"],
        "load-history": ["trips", "history"], "retrain-history": ["history", "runs", "models"],
        "score": ["silver", "promoted", "predictions"], "predictions": ["silver", "promoted", "predictions", "checkpoint"],
        "live-view": ["silver", "metrics", "checkpoint"], "rejects": ["source", "entity", "table", "checkpoint"],
        "compact": ["silver", "compacted"], "streams": ["rides", "drivers", "payments", "root"],
    }.items():
        sp = sub.add_parser(name)
        for a in args:
            sp.add_argument(f"--{a}", required=True)
        if name in ("quality", "retention"):
            sp.add_argument("--as-of", default=None)
        if name == "retention":
            sp.add_argument("--hours", type=int, default=K.RETENTION_HOURS)
        if name == "compact":
            sp.add_argument("--before", default=None)
        if name == "gold-refresh":
            sp.add_argument("--since", default=None)
        if name == "streams":
            sp.add_argument("--kafka-servers", default=None)
    a = p.parse_args(argv)
    spark = ensure_utc(SparkSession.builder.appName(f"zonecast-{a.job}").getOrCreate())
    try:
        return _run(spark, a)
    finally:
        clear_work(spark)


def _run(spark: SparkSession, a: argparse.Namespace) -> int:
    from zonecast.streaming import launcher as L
    from zonecast.streaming import streams as ST

    if a.job == "gold-refresh":
        return gold_refresh(spark, a.silver, a.gold, a.since)
    if a.job == "quality":
        return quality(spark, a.silver, a.gold, a.as_of)
    if a.job == "dashboard":
        return dashboard(spark, a.silver, a.metrics)
    if a.job == "retrain":
        return retrain(spark, a.silver, a.runs, a.models)
    if a.job == "promote":
        promote(spark, a.runs, a.promoted)
        return 0
    if a.job == "load-history":
        return load_history(spark, a.trips, a.history)
    if a.job == "retrain-history":
        return retrain_history(spark, a.history, a.runs, a.models)
    if a.job == "score":
        return score(spark, a.silver, a.promoted, a.predictions)
    queries = None
    if a.job == "predictions":
        queries = [ST.start_scoring(spark, a.silver, a.predictions, a.checkpoint, MO.load_promoted(spark, a.promoted), trigger=_running())]
    if a.job == "live-view":
        queries = ST.start_live_view(spark, a.silver, a.metrics, a.checkpoint, trigger=_running())
    if a.job == "rejects":
        queries = [ST.start_rejects(spark, a.entity, a.table, a.checkpoint, a.source, trigger=_running())]
    if queries:
        return 1 if any(s["exception"] for s in L.supervise(queries)) else 0
    if a.job == "compact":
        return compact(spark, a.silver, a.compacted, a.before)
    if a.job == "retention":
        return retention(spark, a.table, a.keys.split(","), a.hours, a.as_of)
    return streams(spark, {"rides": a.rides, "drivers": a.drivers, "payments": a.payments}, a.root, kafka_servers=a.kafka_servers)


if __name__ == "__main__":
    sys.exit(main())
