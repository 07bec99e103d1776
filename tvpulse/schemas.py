"""Declared schemas, domain constants and column lists shared by every job."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must equal the reference's for the same results, in
# natural order: the five stations; the eight genre codes (this order is also
# the test-data rule's event_id % 8 code); the characters trimmed from raw
# genres (space, tab, CR, LF, ideographic space U+3000); the device id range;
# model and dataset identity; the decision threshold; the split seed; and the
# dashboard's prediction-group labels.
NETWORKS = ("NW01", "NW02", "NW03", "NW04", "NW05")
GENRES = ("NEWS", "DRAMA", "VARIETY", "ANIME", "SPORTS", "MUSIC", "MOVIE", "INFO")
GENRE_TRIM_CHARS = " \t\r\n\u3000"
DEVICE_ID_MIN = "C000001"
DEVICE_ID_MAX = "C020000"
DEVICE_NUMBER_MAX = 20000
MODEL_NAME = "TV_F1_PRESENCE_MODEL"
MODEL_VERSION = "V1"
MODEL_VERSION_PATTERN = r"V[1-9][0-9]*"
DATASET_VERSION = "F1_SIGNAL_V2"
THRESHOLD = 0.50
SPLIT_SEED = 20260918
EXPECTED_DEVICES = 20000
GROUP_POSITIVE = "F1在籍あり（予測1）"
GROUP_NEGATIVE = "F1在籍なし（予測0）"
GROUP_NONE = "予測なし"

MICROS_PER_MINUTE = 60_000_000
MAX_INTERVAL_MICROS = 86_400_000_000  # 24 h, inclusive

RAW_COLUMNS = ["EVENT_ID", "NETWORK_ID", "DEVICE_ID", "VIEW_FROM", "VIEW_TO", "GENRE"]
CLEAN_COLUMNS = RAW_COLUMNS + ["VIEW_MINUTES"]
DAILY_KEYS = ["NETWORK_ID", "DEVICE_ID", "VIEW_DATE", "GENRE"]
DAILY_COLUMNS = DAILY_KEYS + ["SESSION_COUNT", "VIEW_MINUTES"]
MINUTE_COLUMNS = ["EVENT_ID", "NETWORK_ID", "DEVICE_ID", "MINUTE_AT", "VIEW_DATE"]
AUDIENCE_KEYS = ["NETWORK_ID", "VIEW_DATE", "MINUTE_AT"]
AUDIENCE_COLUMNS = AUDIENCE_KEYS + ["VIEWING_DEVICES"]
FEATURE_COLUMNS = [g + "_SHARE" for g in GENRES] + [
    "TOTAL_MINUTES", "TOTAL_SESSIONS", "ACTIVE_DAYS", "MEAN_MINUTES"]

VIEWING_LOG = T.StructType([
    T.StructField("EVENT_ID", T.StringType()),
    T.StructField("NETWORK_ID", T.StringType()),
    T.StructField("DEVICE_ID", T.StringType()),
    T.StructField("VIEW_FROM", T.TimestampNTZType()),
    T.StructField("VIEW_TO", T.TimestampNTZType()),
    T.StructField("GENRE", T.StringType()),
])

DEVICE_LABELS = T.StructType([
    T.StructField("DEVICE_ID", T.StringType()),
    T.StructField("LABEL_AVAILABLE", T.BooleanType()),
    T.StructField("TARGET_F1", T.IntegerType()),
])

PROGRAM_MASTER = T.StructType([
    T.StructField("PROGRAM_ID", T.StringType()),
    T.StructField("PROGRAM_NAME", T.StringType()),
    T.StructField("NETWORK_ID", T.StringType()),
    T.StructField("GENRE", T.StringType()),
    T.StructField("TIME_SLOT", T.StringType()),
    T.StructField("DURATION_MIN", T.DecimalType(4, 0)),
    T.StructField("SYNOPSIS", T.StringType()),
])

PROGRAM_SCHEDULE = T.StructType([
    T.StructField("PROGRAM_ID", T.StringType()),
    T.StructField("NETWORK_ID", T.StringType()),
    T.StructField("AIR_DATE", T.DateType()),
    T.StructField("AIR_FROM", T.TimestampNTZType()),
    T.StructField("AIR_TO", T.TimestampNTZType()),
])

PREDICTIONS = T.StructType([
    T.StructField("DEVICE_ID", T.StringType()),
    T.StructField("PROB_F1", T.DoubleType()),
    T.StructField("PREDICTED_HAS_F1", T.IntegerType()),
    T.StructField("MODEL_NAME", T.StringType()),
    T.StructField("MODEL_VERSION", T.StringType()),
    T.StructField("PREDICTED_AT", T.TimestampNTZType()),
    T.StructField("PREDICTION_THRESHOLD", T.DoubleType()),
    T.StructField("DATASET_VERSION", T.StringType()),
])
