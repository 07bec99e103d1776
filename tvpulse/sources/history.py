"""Load history by file version.

The history is a small append-only table of (TABLE_NAME, DATASET_VERSION,
FILE_PATH, FILE_SIZE, MODIFIED_AT, LOAD_NO). Before a load the listed files are
anti-joined with it; only files that are new, or whose size or time changed,
are audited, read and written to a folder of their own; their history rows
come last. So a rerun adds nothing, a replaced file is loaded again in place of
what it held before, and a load that died in between left no trace: folders
without history rows are never read.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tvpulse.sources.readers import typed, versioned

HISTORY = ("TABLE_NAME string, DATASET_VERSION string, FILE_PATH string, FILE_SIZE long, MODIFIED_AT timestamp, "
           "LOAD_NO long, LOAD_FOLDER string")
_IDENTITY = ["TABLE_NAME", "DATASET_VERSION", "FILE_PATH"]
SOURCE_FILE = "_SOURCE_FILE"


class LoadHistory:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(HISTORY).parquet(f"{self.root}/history")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], HISTORY)  # nothing loaded yet

    def listed(self, source: str, table: str, version: str) -> DataFrame:
        """The files below the table's folder, from the listing alone."""
        found = (self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", "*.parquet").load(versioned(source, version, table)))
        return found.select(F.lit(table).alias("TABLE_NAME"), F.lit(version).alias("DATASET_VERSION"),
                            F.col("_metadata.file_path").alias("FILE_PATH"), F.col("_metadata.file_size").alias("FILE_SIZE"),
                            F.col("_metadata.file_modification_time").alias("MODIFIED_AT"), "path")

    def load(self, source: str, table: str, version: str, schema: T.StructType, partition_by: tuple[str, ...] = ()) -> int:
        """Load what is new below ``source/version/table``; returns the number
        of files. Only the list of new files comes to the driver, as in any
        file listing."""
        known = self.rows().select(*_IDENTITY, "FILE_SIZE", "MODIFIED_AT")
        new = self.listed(source, table, version).join(known, [*_IDENTITY, "FILE_SIZE", "MODIFIED_AT"], "left_anti").collect()
        if not new:
            return 0
        folder = f"{self.root}/{table}/load={uuid.uuid4().hex}"
        base = versioned(source, version, table)
        rows = typed(self.spark, [r.path for r in new], schema, base=base)
        writer = rows.withColumn(SOURCE_FILE, F.col("_metadata.file_path")).write
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(folder)
        number = (self.rows().agg(F.max("LOAD_NO")).first()[0] or 0) + 1
        entries = [(*(r[c] for c in (*_IDENTITY, "FILE_SIZE", "MODIFIED_AT")), number, folder) for r in new]
        # one file, so the entries appear together or not at all
        self.spark.createDataFrame(entries, HISTORY).coalesce(1).write.mode("append").parquet(f"{self.root}/history")
        return len(new)

    def table(self, name: str, schema: T.StructType, version: str | None = None) -> DataFrame:
        """What is loaded, each file once in its latest version (S9: of one
        dataset version, or of all)."""
        rows = self.rows().filter(F.col("TABLE_NAME") == name)
        if version is not None:
            rows = rows.filter(F.col("DATASET_VERSION") == version)
        latest = F.max("LOAD_NO").over(Window.partitionBy(*_IDENTITY))
        rows = rows.withColumn("_stale", F.col("LOAD_NO") < latest)
        folders = [r[0] for r in rows.filter(~F.col("_stale")).select("LOAD_FOLDER").distinct().orderBy("LOAD_FOLDER").collect()]
        if not folders:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField(SOURCE_FILE, T.StringType())])
        parts = []
        for folder in folders:
            part = self.spark.read.schema(stored).parquet(folder)
            stale = rows.filter(F.col("_stale") & (F.col("LOAD_FOLDER") == folder)).select(F.col("FILE_PATH").alias(SOURCE_FILE))
            if not stale.isEmpty():  # files replaced since: the join's small side
                part = part.join(stale, SOURCE_FILE, "left_anti")
            parts.append(part.select(*schema.names))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out
