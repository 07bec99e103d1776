"""ROC AUC, threshold metrics and the confusion matrix, all as
aggregates over a scored table (label column, probability column)."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tvpulse.functions.ranking import cumulative_before
from tvpulse.schemas import THRESHOLD
from tvpulse.session import checkpoint_dir

#: Slices of the ordered scores, each ranked by one task.
BUCKETS = 256


def eval_auc(scored: DataFrame, label: str = "TARGET_F1", score: str = "PROB_F1") -> DataFrame:
    """M9: Mann-Whitney AUC = P(s+ > s-) + 0.5 P(s+ = s-), exact.

    Counts per distinct score, then negatives strictly below each score via
    the bucketed prefix. The buckets end at quantiles of the distinct scores, so
    scores that crowd into a narrow range still spread over all of them; the
    bounds move only work between tasks, never the result."""
    checkpoint_dir(scored.sparkSession)
    per_score = scored.groupBy(score).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("_pos"), F.count(F.when(F.col(label) == 0, 1)).alias("_neg")).checkpoint()
    pos = F.col("_pos").cast("decimal(19,0)")
    bounds = sorted(set(per_score.approxQuantile(score, [i / BUCKETS for i in range(1, BUCKETS)], 1 / (4 * BUCKETS))))
    cut = Bucketizer(splits=[float("-inf"), *bounds, float("inf")], inputCol=score, outputCol="_slice", handleInvalid="keep")
    ranked = cumulative_before(cut.transform(per_score), [], [score], F.col("_slice").cast("bigint"), F.col("_neg"), "_neg_below")
    agg = ranked.agg(F.sum(pos * (F.col("_neg_below") * 2 + F.col("_neg")).cast("decimal(19,0)")).alias("_num2"),
                     F.sum("_pos").alias("POSITIVES"), F.sum("_neg").alias("NEGATIVES"))
    return agg.select(
        (F.col("_num2").cast("double") / F.nullif(F.col("POSITIVES").cast("double") * F.col("NEGATIVES") * 2, F.lit(0.0)))
        .alias("ROC_AUC"), "POSITIVES", "NEGATIVES")


def _counts(scored: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    pred = (F.col(score) >= threshold)
    y = F.col(label) == 1
    return scored.agg(F.count(F.when(pred & y, 1)).alias("TP"), F.count(F.when(pred & ~y, 1)).alias("FP"),
                      F.count(F.when(~pred & y, 1)).alias("FN"), F.count(F.when(~pred & ~y, 1)).alias("TN"))


def eval_threshold_metrics(scored: DataFrame, label: str = "TARGET_F1", score: str = "PROB_F1",
                           threshold: float = THRESHOLD) -> DataFrame:
    """Precision, recall, F1 at the threshold; 0 when undefined."""
    c = _counts(scored, label, score, threshold)
    tp, fp, fn = (F.col(x).cast("double") for x in ("TP", "FP", "FN"))
    safe = lambda n, d: F.coalesce(F.try_divide(n, F.nullif(d, F.lit(0.0))), F.lit(0.0))
    return c.select(safe(tp, tp + fp).alias("PRECISION"), safe(tp, tp + fn).alias("RECALL"),
                    safe(tp * 2, tp * 2 + fp + fn).alias("F1_SCORE"), "TP", "FP", "FN", "TN")


def eval_confusion(scored: DataFrame, label: str = "TARGET_F1", score: str = "PROB_F1",
                   threshold: float = THRESHOLD) -> DataFrame:
    """The 2x2 matrix with empty cells kept as 0 (a four-row grid)."""
    spark = scored.sparkSession
    grid = spark.range(4).select((F.col("id") / 2).cast("int").alias("ACTUAL"), (F.col("id") % 2).cast("int")
                                 .alias("PREDICTED"))
    counts = scored.groupBy(F.col(label).cast("int").alias("ACTUAL"),
                            F.when(F.col(score) >= threshold, 1).otherwise(0).alias("PREDICTED")) \
        .agg(F.count(F.lit(1)).alias("TV_COUNT"))
    return (F.broadcast(grid).join(counts, ["ACTUAL", "PREDICTED"], "left")
            .select("ACTUAL", "PREDICTED", F.coalesce("TV_COUNT", F.lit(0)).cast("bigint").alias("TV_COUNT")))
