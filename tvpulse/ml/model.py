"""Train, register, score and publish with MLlib.

Everything stays distributed: the feature table is assembled and fitted as a
DataFrame, scoring is ``transform``, the prediction table is written and read
back for its count. Iterative boosting checkpoints its intermediate state to
the shared checkpoint folder so a lost executor does not replay all rounds.
"""

from __future__ import annotations

import datetime as dt
import json
from math import ceil

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tvpulse.plans.versions import Versions
from tvpulse.schemas import DATASET_VERSION, FEATURE_COLUMNS, MODEL_NAME, MODEL_VERSION, PREDICTIONS, THRESHOLD
from tvpulse.session import checkpoint_dir

# boosting settings matching the reference's tree ensemble where MLlib allows
GBT_PARAMS = dict(maxIter=200, maxDepth=3, stepSize=0.05, subsamplingRate=0.8, featureSubsetStrategy="0.8",
                  seed=42, lossType="logistic")
#: Training rows of one task. Boosting runs some 750 jobs, each with a task per
#: partition of the training rows, whatever these hold.
TRAIN_ROWS_PER_TASK = 25_000


def build_pipeline(features=FEATURE_COLUMNS, label: str = "TARGET_F1", **overrides) -> Pipeline:
    params = dict(GBT_PARAMS, **overrides)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    gbt = GBTClassifier(labelCol=label, featuresCol="features", checkpointInterval=10, cacheNodeIds=False, **params)
    return Pipeline(stages=[assembler, gbt])


def train_model(train: DataFrame, **overrides) -> PipelineModel:
    """M8: boosted trees on the training split (label cast to double).

    The rows are dealt out by their number, so that small partitions don't
    multiply the tasks of every round, and ordered, so that rounds draw the
    same rows however they arrived."""
    checkpoint_dir(train.sparkSession)
    data = train.withColumn("TARGET_F1", F.col("TARGET_F1").cast("double"))
    data = data.repartition(max(1, ceil(train.count() / TRAIN_ROWS_PER_TASK)), "DEVICE_ID").sortWithinPartitions("DEVICE_ID")
    return build_pipeline(**overrides).fit(data)


def score_devices(model: PipelineModel, features: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Probability of the positive class and the class at the threshold."""
    scored = model.transform(features)
    prob = vector_to_array(F.col("probability"))[1]
    return scored.select("DEVICE_ID", prob.alias("PROB_F1")).withColumn(
        "PREDICTED_HAS_F1", F.when(F.col("PROB_F1") >= threshold, 1).otherwise(0).cast("int"))


def model_path(root: str, name: str = MODEL_NAME, version: str = MODEL_VERSION) -> str:
    return f"{root.rstrip('/')}/{name}/{version}"


def register_model(model: PipelineModel, root: str, metrics: dict, name: str = MODEL_NAME,
                   version: str = MODEL_VERSION, threshold: float = THRESHOLD,
                   dataset_version: str = DATASET_VERSION) -> str:
    """Register under root/name/version; registering the same version
    again replaces it. Each registration is written to its own run folder
    (model + one metadata row: metrics, threshold, dataset, features) and
    becomes current by one pointer row, so an interrupted save never leaves a
    broken version behind. Returns the run folder."""
    versions = Versions(_session(), model_path(root, name, version))
    run = versions.new_run()
    model.write().save(f"{run}/model")
    meta = {"MODEL_NAME": name, "MODEL_VERSION": version, "PREDICTION_THRESHOLD": threshold,
            "DATASET_VERSION": dataset_version, "FEATURES": list(FEATURE_COLUMNS),
            "METRICS": {k: (None if v is None else float(v)) for k, v in metrics.items()},
            "REGISTERED_AT": dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat()}
    session = _session()
    session.createDataFrame([(json.dumps(meta, ensure_ascii=False),)], "METADATA string") \
        .coalesce(1).write.mode("overwrite").text(f"{run}/metadata")
    versions.publish(run)
    return run


def current_run(root: str, name: str = MODEL_NAME, version: str = MODEL_VERSION) -> str:
    """The current run folder of the version (LookupError if never registered)."""
    return Versions(_session(), model_path(root, name, version)).current()


def load_model(root: str, name: str = MODEL_NAME, version: str = MODEL_VERSION) -> PipelineModel:
    return PipelineModel.load(f"{current_run(root, name, version)}/model")


def load_metadata(root: str, name: str = MODEL_NAME, version: str = MODEL_VERSION) -> dict:
    row = _session().read.text(f"{current_run(root, name, version)}/metadata").first()
    return json.loads(row[0])


def publish_predictions(scored: DataFrame, path: str, expected_rows: int | None = None,
                        name: str = MODEL_NAME, version: str = MODEL_VERSION, threshold: float = THRESHOLD,
                        dataset_version: str = DATASET_VERSION, predicted_at: dt.datetime | None = None) -> DataFrame:
    """M15 + S13: stamp identity columns, write the table's next version, read
    it back and verify its row count, and only then make it current; a table
    that fails the check is never seen. Returns the published table."""
    when = predicted_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    out = scored.select(
        "DEVICE_ID", F.col("PROB_F1").cast("double").alias("PROB_F1"),
        F.col("PREDICTED_HAS_F1").cast("int").alias("PREDICTED_HAS_F1"),
        F.lit(name).alias("MODEL_NAME"), F.lit(version).alias("MODEL_VERSION"),
        # from text: a datetime literal would pass through the process time zone
        F.lit(when.isoformat(sep=" ")).cast("timestamp_ntz").alias("PREDICTED_AT"),
        F.lit(float(threshold)).alias("PREDICTION_THRESHOLD"), F.lit(dataset_version).alias("DATASET_VERSION"))
    versions = Versions(scored.sparkSession, path)
    run = versions.new_run()
    out.write.parquet(run)
    written = scored.sparkSession.read.schema(PREDICTIONS).parquet(run)
    if expected_rows is not None:
        n = written.count()
        if n != expected_rows:
            raise RuntimeError(f"wrote {n} prediction rows, expected {expected_rows}: not published")
    versions.publish(run)
    return written


def published_predictions(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a published prediction table."""
    return spark.read.schema(PREDICTIONS).parquet(Versions(spark, path).current())


def _session():
    return SparkSession.getActiveSession()
