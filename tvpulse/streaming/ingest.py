"""Load a file set exactly once with Structured Streaming.

A file-source stream remembers the files it has committed in its checkpoint,
so rerunning the same job (``availableNow`` trigger) appends nothing for
files already loaded and only picks up new ones — the warehouse's
"load history" behaviour, restartable after a failure at any point.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def load_once(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str,
              transform: Callable[[DataFrame], DataFrame] | None = None, fmt: str = "parquet",
              out_schema: T.StructType | None = None, partition_by: list[str] | None = None) -> DataFrame:
    """Append new source files to ``target`` once; returns the target table.

    ``partition_by`` lays the target out by column values (e.g. NETWORK_ID),
    so a later per-station read is pruned to that station's folder."""
    stream = spark.readStream.schema(schema).format(fmt).load(source)
    if transform is not None:
        stream = transform(stream)
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.start(target)
    query.awaitTermination()
    reader = spark.read
    if out_schema is not None:
        reader = reader.schema(out_schema)
    return reader.parquet(target)
