"""Typed readers for deployed data (files laid out per table).

Schemas are declared, never inferred: files are opened with the declared types
(or the declared stored types, which are then converted), so a file that holds
another type aborts the read (S7) and columns match by name ignoring case (S6).
A column that one file lacks would load as NULL; the audit counts values per
file and names the file. With the logs written as one dataset partitioned by
NETWORK_ID, a station filter prunes to that station's files (S2).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tvpulse.schemas import DEVICE_LABELS, PREDICTIONS, PROGRAM_MASTER, PROGRAM_SCHEDULE, VIEWING_LOG

#: Faults that an error message lists.
NAMED_FAULTS = 20
#: May be NULL throughout a file: a file may hold unlabelled devices only.
OPTIONAL = {"TARGET_F1"}


def _opened(spark: SparkSession, paths: str | list[str], schema: T.StructType, base: str | None) -> DataFrame:
    reader = spark.read.schema(schema).option("ignoreCorruptFiles", "false").option("ignoreMissingFiles", "false")
    if base is not None:
        reader = reader.option("basePath", base)  # partition columns of single files
    return reader.parquet(*([paths] if isinstance(paths, str) else paths))


def _converted(name: str, source: T.DataType, target: T.DataType) -> Column:
    """The column in its declared type; a value that does not convert aborts the
    load, whatever the ANSI setting."""
    if source == target:
        return F.col(name)
    value = F.col(name).try_cast(target)
    bad = F.raise_error(F.concat(F.lit(f"bad value in column {name} of "), F.col("_metadata.file_path")))
    return F.when(F.col(name).isNotNull() & value.isNull(), bad).otherwise(value).alias(name)


def valueless_columns(spark: SparkSession, paths: str | list[str], schema: T.StructType, base: str | None = None) -> DataFrame:
    """(FILE_PATH, COLUMN_NAME, ROW_COUNT) of every required column that has no
    value in a file that has rows. One scan, counted per file map-side."""
    required = [f.name for f in schema.fields if f.name not in OPTIONAL]
    counted = _opened(spark, paths, schema, base).groupBy(F.col("_metadata.file_path").alias("FILE_PATH")).agg(
        F.count(F.lit(1)).alias("ROW_COUNT"), *[F.count(c).alias(c) for c in required])
    return (counted.unpivot(["FILE_PATH", "ROW_COUNT"], required, "COLUMN_NAME", "_values")
            .filter("ROW_COUNT > 0 AND _values = 0").select("FILE_PATH", "COLUMN_NAME", "ROW_COUNT"))


def absent_columns(spark: SparkSession, paths: str | list[str], schema: T.StructType, base: str | None = None) -> list[tuple[str, str]]:
    """(column, file) of required columns that a file lacks, the first
    NAMED_FAULTS. A column without a value is suspect; its file's own footer
    tells a missing column from one that holds NULLs only."""
    found, held = [], {}
    for row in valueless_columns(spark, paths, schema, base).orderBy("FILE_PATH", "COLUMN_NAME").toLocalIterator():
        if row.FILE_PATH not in held:
            held = {row.FILE_PATH: {c.lower() for c in spark.read.parquet(row.FILE_PATH).columns}}
        if row.COLUMN_NAME.lower() not in held[row.FILE_PATH]:
            found.append((row.COLUMN_NAME, row.FILE_PATH))
        if len(found) == NAMED_FAULTS:
            break
    return found


def typed(spark: SparkSession, paths: str | list[str], schema: T.StructType, audit: bool = True, base: str | None = None,
          stored: dict[str, T.DataType] | None = None) -> DataFrame:
    """The files in the declared schema; ``stored`` names columns whose files
    hold another type (text times, say). ``audit`` first scans for columns that
    a file lacks; leave it out for files that were audited when loaded."""
    opened = T.StructType([T.StructField(f.name, (stored or {}).get(f.name, f.dataType)) for f in schema.fields])
    if audit:
        faults = absent_columns(spark, paths, opened, base)
        if faults:
            raise ValueError("missing columns: " + "; ".join(f"{column} in {file}" for column, file in faults))
    df = _opened(spark, paths, opened, base)
    return df.select(*[_converted(f.name, opened[f.name].dataType, f.dataType) for f in schema.fields])


def viewing_log(spark: SparkSession, path: str, station: str | None = None, **options) -> DataFrame:
    """One station's log from a per-station folder or a NETWORK_ID-partitioned dataset."""
    df = typed(spark, path, VIEWING_LOG, **options)
    return df if station is None else df.filter(F.col("NETWORK_ID") == station)


def device_labels(spark: SparkSession, path: str, **options) -> DataFrame:
    return typed(spark, path, DEVICE_LABELS, **options)


def program_master(spark: SparkSession, path: str, **options) -> DataFrame:
    return typed(spark, path, PROGRAM_MASTER, **options)


def program_schedule(spark: SparkSession, path: str, **options) -> DataFrame:
    return typed(spark, path, PROGRAM_SCHEDULE, **options)


def predictions(spark: SparkSession, path: str, **options) -> DataFrame:
    """The published prediction table (M15), for the snapshot views (H1-H6)."""
    return typed(spark, path, PREDICTIONS, **options)


def versioned(root: str, dataset_version: str, table: str) -> str:
    """The dataset version is a folder level (root/VERSION/table)."""
    return f"{root.rstrip('/')}/{dataset_version}/{table}"


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the Parquet files by their footers alone.

    The count is pushed into the file metadata, so it is cheap at any size and
    owes nothing to a load. The pushdown needs Spark's newer file reader, which
    a session of its own turns on without touching the caller's settings."""
    own = spark.newSession()
    for key, value in (("spark.sql.sources.useV1SourceList", ""), ("spark.sql.parquet.aggregatePushdown", "true")):
        own.conf.set(key, value)
    return own.read.parquet(path).agg(F.count(F.lit(1)).alias("ROW_COUNT"))


def row_counts(tables: dict[str, DataFrame], expected: dict[str, int]) -> DataFrame:
    """Actual vs expected rows per table as (TABLE_NAME, ACTUAL_ROWS,
    EXPECTED_ROWS, MATCHES); a table nobody expects has no EXPECTED_ROWS."""
    parts = [df.agg(F.count(F.lit(1)).alias("ACTUAL_ROWS")).select(
        F.lit(name).alias("TABLE_NAME"), "ACTUAL_ROWS", F.lit(expected.get(name)).cast("bigint").alias("EXPECTED_ROWS"))
        for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).withColumn(
        "MATCHES", F.coalesce(F.col("ACTUAL_ROWS") == F.col("EXPECTED_ROWS"), F.lit(False)))
