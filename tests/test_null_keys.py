"""Interval folding keeps NULL keys; totals and padded ids don't overflow or collide."""

import datetime as dt

from pyspark.sql import functions as F

from tvpulse.functions.time import minutes_sum
from tvpulse.operators.intervals import FOLD_KEYS, fold_intervals
from tvpulse.sources.testdata import _padded


def test_fold_keeps_null_keys(spark):
    schema = ", ".join(f"{k} string" for k in FOLD_KEYS) + ", VIEW_FROM timestamp_ntz, VIEW_TO timestamp_ntz, EVENT_ID string"
    at = dt.datetime(2024, 1, 1)
    rows = [(*["x"] * (len(FOLD_KEYS) - 1), g, at + dt.timedelta(minutes=m), at + dt.timedelta(minutes=m + 10), str(m))
            for g in ("A", None) for m in (0, 5, 200)]
    got = fold_intervals(spark.createDataFrame(rows, schema))
    assert got.count() == 4 and got.agg(F.sum("SOURCE_ROWS")).first()[0] == 6


def test_minutes_sum_beyond_bigint(spark):
    df = spark.range(20).select(F.lit(5e10).alias("VIEW_MINUTES"))
    assert df.agg(minutes_sum().alias("m")).first()["m"] == 1e12


def test_padding_never_truncates(spark):
    got = [r[0] for r in spark.sql("SELECT explode(array(7, 100000001, 100000002)) AS n").select(_padded(F.col("n"), 8)).collect()]
    assert got == ["00000007", "100000001", "100000002"]
