"""Surge model: metrics, run table, promotion gate, training and scoring on Spark ML.

Training uses a Spark ML ``Pipeline`` (fixed-vocabulary StringIndexerModel with a kept bucket
for other values -> VectorAssembler -> GBTRegressor with 100 trees, depth
5, step 0.1, row subsample 0.8, column subsample 0.8, seed 42), fitted over
cells (``boosting``) and scored JVM-side; the vocabulary travels with the model, so scoring a
stream or a batch needs no Python UDF. Runs are rows of a ``model_runs`` table
instead of a tracking server; promotion is a query over that table, and scoring loads the
newest promoted run.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions import constants as K
from zonecast.operators import tables as T
from zonecast.operators.features import VOCAB
from zonecast.session import materialize

FEATURE_PARAMS = dict(maxIter=100, maxDepth=5, stepSize=0.1, subsamplingRate=0.8, seed=42,
                      featureSubsetStrategy="0.8")
#: Categories of live and historical rides.
MODEL_VOCAB = VOCAB | {"city_zone": [*VOCAB["city_zone"], *K.HIST_ZONE_LABELS], "vehicle_type": [*VOCAB["vehicle_type"], "yellow_taxi"]}
#: Most rows of one task of a fit.
ROWS_PER_TASK = 1_000_000
LIVE_MODEL = "surge_price_model"
HIST_MODEL = "surge_price_model_nyc"


def regression_aggregates(label: Column, prediction: Column) -> list[Column]:
    """N, MAE, RMSE and R^2 of the raw values, rounded once, to nine places, at the end. Rows without a label or a
    prediction are not counted."""
    both = label.isNotNull() & prediction.isNotNull()
    y, p = F.when(both, label), F.when(both, prediction)
    sse, sst = F.sum((y - p) * (y - p)), F.var_pop(y) * F.count(y)
    return [F.count(y).alias("n"), F.round(F.avg(F.abs(y - p)), 9).alias("mae"),
            F.round(F.sqrt(F.avg((y - p) * (y - p))), 9).alias("rmse"),
            F.round(F.when(sst > 0, F.lit(1.0) - sse / sst), 9).alias("r2")]


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """MAE, RMSE, R^2 in one aggregate."""
    return df.agg(*regression_aggregates(F.col(label), F.col(prediction)))


def residuals(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """M7: actual - predicted."""
    return df.select("ride_id", label, prediction, (F.col(label) - F.col(prediction)).alias("residual"))


def model_runs_from_scores(scored: DataFrame) -> DataFrame:
    """One evaluation run per day and candidate: (run_id, model, event_date, n, mae, rmse, r2, start_time)."""
    base = scored.withColumn("event_date", F.to_date("event_ts"))
    a = base.select("event_date", "event_ts", "label", F.col("prediction").alias("p"), F.lit(LIVE_MODEL).alias("model"))
    b = base.select("event_date", "event_ts", "label", F.col("prediction_alt").alias("p"),
                    F.lit(HIST_MODEL).alias("model"))
    g = a.unionByName(b).groupBy("event_date", "model").agg(
        *regression_aggregates(F.col("label"), F.col("p")), F.max("event_ts").alias("start_time"))
    return g.select(
        F.concat(F.col("model"), F.lit("-"), F.date_format("event_date", "yyyyMMdd")).alias("run_id"),
        "model", "event_date", "n", "mae", "rmse", "r2", "start_time")


def promotion_gate(runs: DataFrame, threshold: float = K.PROMOTION_MAE_THRESHOLD,
                   group: str = "event_date") -> DataFrame:
    """M4: per retrain cycle, the candidate with the lower MAE (tie -> historical model,
    missing MAE = +inf); promoted only if that MAE is strictly below the threshold.
    A cycle with no metric at all is reported with a null model."""
    pref = F.when(F.col("model") == HIST_MODEL, 0).otherwise(1)
    mae = F.coalesce(F.col("mae"), F.lit(float("inf")))
    best = runs.groupBy(group).agg(F.min(F.struct(mae.alias("mae"), pref.alias("pref"), "model", "run_id")).alias("b"))
    chosen_mae = F.col("b.mae")
    return best.select(
        group,
        F.when(F.isnan(chosen_mae) | (chosen_mae == float("inf")), F.lit(None)).otherwise(F.col("b.model"))
        .alias("model"),
        F.col("b.run_id").alias("run_id"),
        F.when(chosen_mae == float("inf"), F.lit(None)).otherwise(chosen_mae).alias("mae"),
        (chosen_mae < threshold).alias("promoted"))


def leaderboard(runs: DataFrame, n: int = 10) -> DataFrame:
    """M8: newest n runs (a top-k report)."""
    return runs.orderBy(F.desc("start_time"), F.desc("run_id")).limit(n)


# ---------------------------------------------------------------- training and scoring

def build_pipeline(label: str = K.TARGET):
    """Fixed vocabularies (no pass over the data), each category one nominal feature, boosted trees."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexerModel, VectorAssembler

    from zonecast.operators.boosting import CellGBTRegressor

    cats = K.CATEGORICAL_FEATURES
    # values outside the vocabulary share the extra index that "keep" adds
    idx = StringIndexerModel.from_arrays_of_labels([MODEL_VOCAB[c] for c in cats], inputCols=cats,
                                                   outputCols=[f"{c}_idx" for c in cats], handleInvalid="keep")
    vec = VectorAssembler(inputCols=K.NUMERIC_FEATURES + [f"{c}_idx" for c in cats], outputCol="features", handleInvalid="keep")
    gbt = CellGBTRegressor(featuresCol="features", labelCol=label, predictionCol="raw_prediction",
                           checkpointInterval=10, **FEATURE_PARAMS)
    return Pipeline(stages=[idx, vec, gbt])


def fit_tasks(rows: int, cores: int, most: int = ROWS_PER_TASK) -> int:
    """Tasks of each of a fit's jobs: one for every core, or a multiple of it where that would be more than ``most`` rows in one."""
    return cores * max(1, math.ceil(rows / (cores * most)))


def fit(rows: DataFrame):
    """The pipeline fitted on stored rows (``materialize``). The fit passes over the feature vectors twice, for the bins and for the cells: they
    are stored once, dealt evenly over all cores, however few or many files or sorted ranges the rows come from."""
    from pyspark.ml import PipelineModel

    *prepare, trees = build_pipeline().getStages()
    n = fit_tasks(rows.count(), rows.sparkSession.sparkContext.defaultParallelism)
    vectors = PipelineModel(prepare).transform(rows).select(trees.getFeaturesCol(), trees.getLabelCol())
    return PipelineModel([*prepare, trees.fit(materialize(vectors.repartition(n)))])


def evaluate(test_df: DataFrame, model, model_name: str) -> DataFrame:
    """One-row metrics frame of the raw (unclipped) predictions."""
    m = model.transform(test_df).agg(*regression_aggregates(F.col(K.TARGET), F.col("raw_prediction")))
    return m.select(F.lit(model_name).alias("model"), "n", "mae", "rmse", "r2", F.current_timestamp().alias("start_time"))


def train(train_df: DataFrame, test_df: DataFrame, model_name: str):
    """Fit on ``train_df``, evaluate on ``test_df`` (both stored); returns (PipelineModel, one-row metrics frame)."""
    model = fit(train_df)
    return model, evaluate(test_df, model, model_name)


def score(df: DataFrame, model) -> DataFrame:
    """JVM pipeline prediction clipped to the surge band."""
    out = model.transform(df)
    clipped = F.least(F.lit(K.SURGE_MAX), F.greatest(F.lit(K.SURGE_MIN), F.col("raw_prediction")))
    drop = [c for c in out.columns if c.endswith("_idx") or c in ("features", "raw_prediction")]
    return out.withColumn("predicted_surge_multiplier", clipped).drop(*drop)


def feature_names(model, frame: DataFrame) -> list[str]:
    """Names of the feature vector's entries, as its column's metadata gives them."""
    attrs = model.transform(frame.limit(0)).schema["features"].metadata["ml_attr"]["attrs"]
    found = {a["idx"]: a["name"] for kind in attrs.values() for a in kind}
    return [found[i].removesuffix("_idx") for i in range(len(found))]


def feature_importance(spark: SparkSession, model, frame: DataFrame, top: int = 15) -> DataFrame:
    """M6: importance per feature of the vector that the model reads from frames like ``frame``, top n.

    The vector is as long as the feature space (a handful of entries), not the data."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    rows = [(name, float(v)) for name, v in zip(feature_names(model, frame), values, strict=True)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(top)


# ---------------------------------------------------------------- run table and promoted model

RUN_SCHEMA = ("run_id string, model string, n long, mae double, rmse double, r2 double, start_time timestamp, model_path string")
PROMOTED_SCHEMA = "promoted_at timestamp, run_id string, model string, mae double, model_path string"


def log_run(spark: SparkSession, model, metrics: DataFrame, runs_path: str, models_path: str) -> str:
    """Save a fitted pipeline and append its run row; returns the model's path."""
    name = metrics.first()["model"]
    run_id = f"{name}-{uuid.uuid4().hex[:12]}"
    path = f"{models_path.rstrip('/')}/{run_id}"
    model.write().save(path)
    metrics.select(F.lit(run_id).alias("run_id"), "model", "n", "mae", "rmse", "r2", "start_time",
                   F.lit(path).alias("model_path")).write.mode("append").parquet(runs_path)
    return path


def comparison_path(runs_path: str) -> str:
    """Run table of models that are only compared with; promotion does not read it."""
    return runs_path.rstrip("/") + "_comparison"


def promote_run(spark: SparkSession, runs_path: str, promoted_path: str, threshold: float = K.PROMOTION_MAE_THRESHOLD) -> DataFrame:
    """M4: among the newest run of each candidate the lower MAE wins (tie -> historical model); below the threshold it is
    appended to the promoted runs, which scoring reads. Returns the decision."""
    runs = spark.read.schema(RUN_SCHEMA).parquet(runs_path)
    newest = T.newest_per_key(runs.select("model", "start_time", "run_id", "mae", "model_path"), ["model"], ["start_time", "run_id"])
    decision = promotion_gate(newest.withColumn("cycle", F.lit(1)), threshold, group="cycle")
    row = decision.first()  # one row: the single promotion cycle
    if row is None or row["model"] is None:
        raise ValueError("no model metrics found for the promotion check")
    if row["promoted"]:
        (newest.where(F.col("run_id") == row["run_id"])
         .select(F.current_timestamp().alias("promoted_at"), "run_id", "model", "mae", "model_path")
         .write.mode("append").parquet(promoted_path))
    return decision


def load_promoted(spark: SparkSession, promoted_path: str):
    """The newest promoted pipeline."""
    from pyspark.ml import PipelineModel

    rows = T.read_table(spark, promoted_path, PROMOTED_SCHEMA)
    newest = rows.agg(F.max_by("model_path", F.struct("promoted_at", "run_id")).alias("path")).first()["path"]
    if newest is None:
        raise ValueError(f"no promoted model in {promoted_path}")
    return PipelineModel.load(newest)
