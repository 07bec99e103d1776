"""Interval validity, exact dedupe, genre normalisation, minutes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tvpulse.functions.text import normalize_genre
from tvpulse.functions.time import micros_between, view_minutes
from tvpulse.schemas import MAX_INTERVAL_MICROS, RAW_COLUMNS


def valid_interval(start="VIEW_FROM", end="VIEW_TO"):
    """P2 predicate: positive length, at most 24 h (exactly 24 h is kept)."""
    return (F.col(end) > F.col(start)) & (micros_between(start, end) <= MAX_INTERVAL_MICROS)


def valid_intervals_filter(raw: DataFrame) -> DataFrame:
    return raw.filter(valid_interval())


def exact_dedup(raw: DataFrame) -> DataFrame:
    """Drop rows identical on all six raw columns (before normalisation).

    The shuffle hashes all six columns, so a hot device or station cannot
    concentrate rows in one task; the partial aggregate removes copies map-side.
    """
    return raw.select(*RAW_COLUMNS).dropDuplicates(RAW_COLUMNS)


def genre_normalize(df: DataFrame) -> DataFrame:
    return df.withColumn("GENRE", normalize_genre("GENRE"))


def clean_viewing(raw: DataFrame) -> DataFrame:
    """P1 = P2 -> P3 -> P4 -> P5. Filter first so Parquet sees the predicate."""
    deduped = exact_dedup(valid_intervals_filter(raw))
    return deduped.select(
        "EVENT_ID", "NETWORK_ID", "DEVICE_ID", "VIEW_FROM", "VIEW_TO",
        normalize_genre("GENRE").alias("GENRE"),
        view_minutes().alias("VIEW_MINUTES"),
    )


REJECT_REASONS = ("MISSING_TIME", "REVERSED", "ZERO_LENGTH", "OVER_24H", "DUPLICATE", "KEPT")


def rejects_report(raw: DataFrame) -> DataFrame:
    """Raw rows by reason; every reason is listed, absent ones with 0.

    Extra copies are counted per distinct valid row as ``rows - 1`` after a
    partial aggregate, never by collecting a group.
    """
    start, end = F.col("VIEW_FROM"), F.col("VIEW_TO")
    classified = raw.select(
        F.when(start.isNull() | end.isNull(), F.lit("MISSING_TIME"))
        .when(end < start, F.lit("REVERSED"))
        .when(end == start, F.lit("ZERO_LENGTH"))
        .when(micros_between(start, end) > MAX_INTERVAL_MICROS, F.lit("OVER_24H"))
        .otherwise(F.lit("VALID")).alias("REASON"), *RAW_COLUMNS)
    invalid = (classified.filter(F.col("REASON") != "VALID")
               .groupBy("REASON").agg(F.count(F.lit(1)).alias("ROW_COUNT")))
    copies = (classified.filter(F.col("REASON") == "VALID")
              .groupBy(*RAW_COLUMNS).agg(F.count(F.lit(1)).alias("n"))
              .agg(F.sum(F.col("n") - 1).alias("DUPLICATE"), F.count(F.lit(1)).alias("KEPT")))
    valid = copies.select(F.expr("stack(2, 'DUPLICATE', DUPLICATE, 'KEPT', KEPT) AS (REASON, ROW_COUNT)"))
    spark = raw.sparkSession
    reasons = spark.createDataFrame([(r, i) for i, r in enumerate(REJECT_REASONS)], "REASON string, ORD int")
    counts = invalid.unionByName(valid)
    # six literal rows: broadcast is size-bounded
    return (F.broadcast(reasons).join(counts, "REASON", "left")
            .select("REASON", F.coalesce("ROW_COUNT", F.lit(0)).cast("bigint").alias("ROW_COUNT")))
