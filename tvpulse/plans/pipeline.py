"""Lazy stage-by-stage DataFrames for one data directory.

Nothing is cached or collected here; each property returns a logical plan so
Catalyst can prune columns and push filters into the source scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tvpulse.ml.features import device_features, features_labeled, stratified_split
from tvpulse.operators.clean import clean_viewing
from tvpulse.operators.marts import device_daily, minute_audience, viewing_minutes
from tvpulse.operators.sweep import minute_audience_sweep
from tvpulse.schemas import NETWORKS
from tvpulse.sources import testdata


class Pipeline:
    """Raw -> clean -> marts for every station at once (NETWORK_ID is a key
    of every mart, so one grouped pass equals the UNION ALL of the five
    station marts)."""

    def __init__(self, spark: SparkSession, sf_dir: str, raw: DataFrame | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self._raw = raw

    @classmethod
    def from_files(cls, spark: SparkSession, logs_path: str, labels_path: str | None = None) -> "Pipeline":
        """Deployed data: typed logs (ideally one dataset partitioned by
        NETWORK_ID, so station filters prune directories) and optional labels."""
        from tvpulse.sources import readers
        p = cls(spark, logs_path, raw=readers.viewing_log(spark, logs_path))
        if labels_path is not None:
            p.__dict__["labels"] = readers.device_labels(spark, labels_path)
        return p

    @cached_property
    def raw(self) -> DataFrame:
        return self._raw if self._raw is not None else testdata.viewing_log(self.spark, self.sf_dir)

    def station_raw(self, station: str) -> DataFrame:
        return self.raw.filter(F.col("NETWORK_ID") == station)

    @cached_property
    def clean(self) -> DataFrame:
        return clean_viewing(self.raw)

    @cached_property
    def daily(self) -> DataFrame:
        return device_daily(self.clean)

    @cached_property
    def minutes(self) -> DataFrame:
        return viewing_minutes(self.clean)

    @cached_property
    def audience(self) -> DataFrame:
        """Minute mart by the sweep (cost follows intervals, not minutes)."""
        return minute_audience_sweep(self.clean)

    @cached_property
    def audience_exploded(self) -> DataFrame:
        """Minute mart by the defining explode + distinct count."""
        return minute_audience(self.minutes)

    @cached_property
    def labels(self) -> DataFrame:
        return testdata.device_labels(self.spark, self.sf_dir)

    @cached_property
    def predictions(self) -> DataFrame:
        return testdata.prediction_snapshot(self.spark, self.sf_dir)

    @cached_property
    def features(self) -> DataFrame:
        return device_features(self.daily)

    @cached_property
    def labeled(self) -> DataFrame:
        return features_labeled(self.features, self.labels)

    @cached_property
    def split(self) -> DataFrame:
        return stratified_split(self.labeled)

    @cached_property
    def train(self) -> DataFrame:
        return self.split.filter(F.col("SPLIT") == "train").drop("SPLIT")

    @cached_property
    def test(self) -> DataFrame:
        return self.split.filter(F.col("SPLIT") == "test").drop("SPLIT")

    def stations(self) -> tuple[str, ...]:
        return NETWORKS
