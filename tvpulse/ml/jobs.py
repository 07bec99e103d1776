"""The model job as reusable steps: train once per data set, register,
explain, score and publish, each as Spark jobs."""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from tvpulse.ml import evaluate as ME
from tvpulse.ml import explain as MX
from tvpulse.ml import model as MM
from tvpulse.ml.features import require_clean_features
from tvpulse.plans.pipeline import Pipeline
from tvpulse.schemas import DATASET_VERSION, FEATURE_COLUMNS, MODEL_NAME, MODEL_VERSION, THRESHOLD
from tvpulse.session import output_dir
from tvpulse.sources.testdata import fingerprint

_TRAINED: dict[tuple[str, str, str], PipelineModel] = {}
_PREPARED: dict[tuple[str, str, str], dict[str, DataFrame]] = {}
#: Stages that the model job's steps share, in the order in which each needs the ones before.
_SHARED = ("features", "labels", "split")


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """Application, folder and the state of the files that the features come from."""
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"), fingerprint(spark, sf_dir))


def registry_root(spark: SparkSession, sf_dir: str) -> str:
    tag = hashlib.sha1(sf_dir.rstrip("/").encode()).hexdigest()[:10]
    return f"{output_dir(spark)}/registry/{tag}"


def prepared(spark: SparkSession, sf_dir: str) -> Pipeline:
    """The pipeline over stored features, labels and split.

    Every step of the job reads them several times, and each time they would be
    made again from the raw logs. They are written once per session and data
    set, each from the stored ones before it: one pass over the logs in all."""
    key, p = _key(spark, sf_dir), Pipeline(spark, sf_dir)
    if key not in _PREPARED:
        base = f"{registry_root(spark, sf_dir)}/prepared/run={uuid.uuid4().hex}"
        for stage in _SHARED:
            made = getattr(p, stage)
            made.write.parquet(f"{base}/{stage}")
            p.__dict__[stage] = spark.read.schema(made.schema).parquet(f"{base}/{stage}")
        _PREPARED[key] = {stage: getattr(p, stage) for stage in _SHARED}
    p.__dict__.update(_PREPARED[key])
    return p


def trained(spark: SparkSession, sf_dir: str) -> PipelineModel:
    """M8 once per session and data set; later steps reuse the fitted model."""
    key = _key(spark, sf_dir)
    if key not in _TRAINED:
        p = prepared(spark, sf_dir)
        require_clean_features(p.features, p.labels)
        _TRAINED[key] = MM.train_model(p.train)
    return _TRAINED[key]


def test_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = prepared(spark, sf_dir)
    scored = MM.score_devices(trained(spark, sf_dir), p.test)
    return scored.join(p.test.select("DEVICE_ID", "TARGET_F1"), "DEVICE_ID")


def register(spark: SparkSession, sf_dir: str) -> str:
    """Evaluate on the test split and register under name/version."""
    scored = test_scores(spark, sf_dir)
    auc = ME.eval_auc(scored).first()
    thr = ME.eval_threshold_metrics(scored).first()
    metrics = {"ROC_AUC": auc["ROC_AUC"], "PRECISION": thr["PRECISION"], "RECALL": thr["RECALL"],
               "F1_SCORE": thr["F1_SCORE"]}
    return MM.register_model(trained(spark, sf_dir), registry_root(spark, sf_dir), metrics)


def registered_model_dir(spark: SparkSession, sf_dir: str) -> str:
    """The registered version's model folder; registers first when this
    session has not trained it (or nothing is registered yet)."""
    root = registry_root(spark, sf_dir)
    if _key(spark, sf_dir) not in _TRAINED:
        return register(spark, sf_dir) + "/model"
    try:
        return MM.current_run(root) + "/model"
    except LookupError:  # not registered yet
        return register(spark, sf_dir) + "/model"


def explanations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M13 over every test device, with the registered model."""
    return MX.explain(spark, registered_model_dir(spark, sf_dir), prepared(spark, sf_dir).test)


def background_explanations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M13 over every test device against all training devices."""
    p = prepared(spark, sf_dir)
    return MX.explain(spark, registered_model_dir(spark, sf_dir), p.test, background=p.train)


def model_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8, M12-M15 in figures that don't depend on the trained weights: one row
    (STEP, DEVICES, HOLDS) per step."""
    p = prepared(spark, sf_dir)
    valid = F.col("PROB_F1").between(0.0, 1.0) & (F.col("PREDICTED_HAS_F1") == (F.col("PROB_F1") >= THRESHOLD).cast("int"))
    tested, scored = test_scores(spark, sf_dir), all_scores(spark, sf_dir)
    total = sum((F.col(c + "_EXPLANATION") for c in FEATURE_COLUMNS), F.col("BASE_VALUE"))
    odds = F.log(F.col("PROB_F1") / (1 - F.col("PROB_F1")))

    def row(step: str, rows: DataFrame, holds) -> DataFrame:
        return rows.agg(F.count_distinct("DEVICE_ID").alias("DEVICES"), F.bool_and(holds).alias("HOLDS")).select(
            F.lit(step).alias("STEP"), "DEVICES", "HOLDS")
    explained = [row(step, found.join(tested.select("DEVICE_ID", "PROB_F1"), "DEVICE_ID"), F.abs(total - odds) < 1e-6)
                 for step, found in (("explain", explanations(spark, sf_dir)), ("explain_background", background_explanations(spark, sf_dir)))]
    meta = MM.load_metadata(registry_root(spark, sf_dir))
    named = [meta[k] for k in ("MODEL_NAME", "MODEL_VERSION", "PREDICTION_THRESHOLD", "DATASET_VERSION", "FEATURES")]
    registered = named == [MODEL_NAME, MODEL_VERSION, THRESHOLD, DATASET_VERSION, list(FEATURE_COLUMNS)]
    auc = ME.eval_auc(tested).first()["ROC_AUC"]  # None if the test split has one class only
    published = publish(spark, sf_dir)
    again = MM.published_predictions(spark, f"{registry_root(spark, sf_dir)}/predictions")
    return reduce(DataFrame.unionByName, [
        row("train", tested, valid & F.lit(auc is None or 0.0 <= auc <= 1.0)), row("register", p.train, F.lit(registered)), row("score", scored, valid), *explained,
        row("publish", published.join(again, "DEVICE_ID"), F.lit(True))])


def all_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every device scored by the registered model."""
    model = PipelineModel.load(registered_model_dir(spark, sf_dir))
    return MM.score_devices(model, prepared(spark, sf_dir).features)


def publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M15 + S13: publish all devices' predictions and verify the count."""
    scores = all_scores(spark, sf_dir)
    expected = prepared(spark, sf_dir).features.count()
    path = f"{registry_root(spark, sf_dir)}/predictions"
    return MM.publish_predictions(scores, path, expected_rows=expected)


def top_per_class(predictions: DataFrame, k: int = 5) -> DataFrame:
    """Top ``k`` devices by probability in each predicted class (ties by id).

    Catalyst applies the row_number limit partially before the shuffle, so
    each class moves at most k rows per input partition."""
    w = Window.partitionBy("PREDICTED_HAS_F1").orderBy(F.col("PROB_F1").desc(), F.col("DEVICE_ID").asc())
    return (predictions.withColumn("RANK", F.row_number().over(w)).filter(F.col("RANK") <= k)
            .select("PREDICTED_HAS_F1", "RANK", "DEVICE_ID", "PROB_F1"))


def require_both_classes(rows) -> None:
    """W7 guard on the collected top rows (at most 2k rows)."""
    if {r["PREDICTED_HAS_F1"] for r in rows} != {0, 1}:
        raise RuntimeError("both predicted classes are required in the examples")
