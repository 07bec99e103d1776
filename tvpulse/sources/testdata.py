"""Adapter from the shared test tables to the engine's input tables.

The reference's own log files are not available, so the viewing logs, device
labels, a prediction snapshot and the program tables are derived from the
``events`` and ``part`` tables with a fixed rule (see FIXTURES.md). The rule
deliberately plants duplicates, reversed, zero-length, over-24-h and exactly
24-h intervals plus untrimmed, lower-case and full-width genres.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tvpulse.functions.text import full_width
from tvpulse.functions.time import minute_floor
from tvpulse.schemas import (DATASET_VERSION, GENRES, MODEL_NAME, MODEL_VERSION, RAW_COLUMNS,
                             THRESHOLD)
from tvpulse.sources.readers import versioned

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Digest of the event files' names, sizes and times, from the listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{sf_dir.rstrip('/')}/events.parquet")
    listed = F.concat_ws(":", "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    return files.agg(F.md5(F.array_join(F.array_sort(F.collect_list(listed)), ";"))).first()[0]


def _genre_by_code(code: Column) -> Column:
    # position in GENRES is the code (0 = NEWS ... 7 = INFO)
    return F.element_at(F.array(*[F.lit(g) for g in GENRES]), (code + 1).cast("int"))


def _padded(number, width: int):
    """Zero-padded text; longer numbers keep all their digits."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def _device_id(user_id: Column) -> Column:
    return F.concat(F.lit("C"), _padded(user_id + 1, 6))


def viewing_log_from_events(events: DataFrame) -> DataFrame:
    """All five stations' raw logs in one DataFrame (NETWORK_ID column)."""
    eid, uid, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    dur_s = (eid * 7919) % 7200 + 1
    g = F.when((uid % 6 == 0) & (eid % 3 != 0), F.lit("DRAMA")).otherwise(_genre_by_code(eid % 8))
    plus_s = lambda n: F.timestamp_add("SECOND", n, ts)
    view_to = (F.when(eid % 101 == 7, F.timestamp_add("MINUTE", F.lit(-5), ts))
               .when(eid % 103 == 9, plus_s(F.lit(86401)))
               .when(eid % 499 == 3, F.timestamp_add("HOUR", F.lit(24), ts))
               .when(eid % 211 == 5, ts)
               .when(eid % 11 == 0, minute_floor(plus_s(dur_s)))
               .otherwise(plus_s(dur_s)))
    upper_letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    wide = F.translate(g, upper_letters, full_width(upper_letters))
    genre = (F.when(eid % 13 == 1, F.lower(g))
             .when(eid % 13 == 2, F.concat(F.lit(" "), g, F.lit("  ")))
             .when(eid % 13 == 3, wide)
             .when(eid % 13 == 4, F.lower(wide))
             .when(eid % 13 == 5, F.concat(F.lit("　"), g, F.lit("\t")))
             .otherwise(g))
    typed = events.select(
        F.concat(F.lit("E"), _padded(eid, 8)).alias("EVENT_ID"),
        F.concat(F.lit("NW0"), (eid % 5 + 1).cast("string")).alias("NETWORK_ID"),
        _device_id(uid).alias("DEVICE_ID"),
        ts.alias("VIEW_FROM"),
        view_to.alias("VIEW_TO"),
        genre.alias("GENRE"),
        (eid % 97 == 0).alias("dup"),
    )
    # planted exact copies: one scan, the flagged rows emitted twice
    copies = F.explode(F.when(F.col("dup"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return typed.select(*RAW_COLUMNS, copies.alias("_copy")).select(*RAW_COLUMNS)


def viewing_log(spark: SparkSession, sf_dir: str, station: str | None = None) -> DataFrame:
    """One station's raw log (or all stations when ``station`` is None)."""
    raw = viewing_log_from_events(table(spark, sf_dir, "events"))
    return raw if station is None else raw.filter(F.col("NETWORK_ID") == station)


def device_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: labels for every observed device; half labelled, unknown is NULL."""
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    uid = F.col("user_id")
    available = uid % 2 == 0
    return users.select(
        _device_id(uid).alias("DEVICE_ID"),
        available.alias("LABEL_AVAILABLE"),
        F.when(available, F.when(uid % 6 == 0, 1).otherwise(0)).cast("int").alias("TARGET_F1"),
    )


def prediction_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deterministic prediction table (probabilities 0.00..1.00 in 0.01 steps)."""
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    prob = ((F.col("user_id") * 37) % 101).cast("double") / 100
    return users.select(_device_id(F.col("user_id")).alias("DEVICE_ID"), prob.alias("PROB_F1")).select(
        "DEVICE_ID", "PROB_F1",
        F.when(F.col("PROB_F1") >= THRESHOLD, 1).otherwise(0).cast("int").alias("PREDICTED_HAS_F1"),
        F.lit(MODEL_NAME).alias("MODEL_NAME"),
        F.lit(MODEL_VERSION).alias("MODEL_VERSION"),
        F.lit("2024-02-01 00:00:00").cast("timestamp_ntz").alias("PREDICTED_AT"),
        F.lit(THRESHOLD).cast("double").alias("PREDICTION_THRESHOLD"),
        F.lit(DATASET_VERSION).alias("DATASET_VERSION"),
    )


def program_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A program per row of ``part``; keys repeat 60 kinds of programs."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), _padded(k, 4)).alias("PROGRAM_ID"),
        F.col("p_name").alias("PROGRAM_NAME"),
        F.concat(F.lit("NW0"), (k % 5 + 1).cast("string")).alias("NETWORK_ID"),
        _genre_by_code(k % 8).alias("GENRE"),
        F.when(k % 60 < 20, "MORNING").when(k % 60 < 40, "DAY").otherwise("PRIME").alias("TIME_SLOT"),
        ((k % 4 + 1) * 30).cast("decimal(4,0)").alias("DURATION_MIN"),
        F.col("p_type").alias("SYNOPSIS"),
    )


#: Rows of the program schedule that one task makes.
SCHEDULE_ROWS_PER_TASK = 1_000_000


def program_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every program aired on every observed day.

    The observed days (as many as the calendar has) become one array, which
    every program explodes. The programs are few bytes in one or two file
    splits, so they are first dealt out by how many rows they will become."""
    k = F.col("p_partkey")
    days = [r["d"] for r in table(spark, sf_dir, "events").filter("ts IS NOT NULL")
            .select(F.to_date("ts").alias("d")).distinct().orderBy("d").collect()]
    dates = F.array(*[F.lit(d) for d in days]).cast("array<date>")
    part = table(spark, sf_dir, "part").select("p_partkey")
    tasks = ceil(part.count() * len(days) / SCHEDULE_ROWS_PER_TASK)
    programs = (part.repartition(tasks, "p_partkey") if tasks > 1 else part).select("p_partkey", F.explode(dates).alias("d"))
    start_min = (k % 60 - k % 5) * 24
    day_start = F.col("d").cast("timestamp_ntz")
    return programs.select(
        F.concat(F.lit("P"), _padded(k, 4)).alias("PROGRAM_ID"),
        F.concat(F.lit("NW0"), (k % 5 + 1).cast("string")).alias("NETWORK_ID"),
        F.col("d").alias("AIR_DATE"),
        F.timestamp_add("MINUTE", start_min, day_start).alias("AIR_FROM"),
        F.timestamp_add("MINUTE", start_min + (k % 4 + 1) * 30, day_start).alias("AIR_TO"),
    )


def deploy(spark: SparkSession, sf_dir: str, root: str, dataset_version: str = DATASET_VERSION) -> str:
    """Write the derived tables as a deployed data set (S9): the five stations'
    logs as one dataset with a folder per station, labels and programs beside."""
    for name, df, by in (("VIEWING_LOG", viewing_log(spark, sf_dir), ["NETWORK_ID"]), ("DEVICE_LABELS", device_labels(spark, sf_dir), []),
                         ("PROGRAM_MASTER", program_master(spark, sf_dir), []),
                         ("PROGRAM_SCHEDULE", program_schedule(spark, sf_dir), [])):
        df.write.partitionBy(*by).parquet(versioned(root, dataset_version, name))
    return root
