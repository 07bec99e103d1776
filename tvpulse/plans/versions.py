"""Versions of a table set, switched by numbered pointer rows.

A writer fills a new run folder and only then appends one row (NAME, VERSION,
RUN) as one file. Readers take the highest version. Nothing is overwritten or
deleted, so a writer that dies at any point leaves the last version in place,
and an append that was not committed is not seen.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

POINTERS = "NAME string, VERSION long, RUN string"


class Versions:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _latest(self, name: str):
        try:
            rows = self.spark.read.schema(POINTERS).parquet(f"{self.folder}/versions")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        # two writers may take the same number: one order for all readers
        return rows.filter(F.col("NAME") == name).orderBy(F.desc("VERSION"), F.desc("RUN")).first()

    def current(self, name: str = "") -> str:
        """The run folder of the highest version; LookupError if there is none."""
        row = self._latest(name)
        if row is None:
            raise LookupError(f"nothing published in {self.folder} {name}".rstrip())
        return row.RUN

    def new_run(self) -> str:
        return f"{self.folder}/run={uuid.uuid4().hex}"

    def publish(self, run: str, *names: str) -> None:
        """Make ``run`` the current version of each name ("" if none is given)."""
        rows = []
        for name in names or ("",):
            row = self._latest(name)
            rows.append((name, 1 if row is None else row.VERSION + 1, run))
        self.spark.createDataFrame(rows, POINTERS).coalesce(1).write.mode("append").parquet(f"{self.folder}/versions")
