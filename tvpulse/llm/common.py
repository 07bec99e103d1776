"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tvpulse.session import checkpoint_dir

#: Rows that a Python stage turns into Python objects at a time.
SLICE = 256


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path under the session's ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    This cuts the lineage: an executor lost later costs a reread, never the
    work before. Each call takes a new folder; ``options`` are the writer's."""
    path = shared_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a stage holds few texts as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def row_key(doc_id: str, text: str) -> Column:
    """128-bit key of a row's id and text: never null, equal for repeated rows."""
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("-")),
                                     F.coalesce(F.col(text), F.lit("")))))


def within_bound(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows, so that it may be broadcast."""
    return df.limit(rows + 1).count() <= rows


def weighed(batches: Iterator[pa.RecordBatch], column: int, size: int = 1 << 20, rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of at most ``rows`` rows and about ``size``
    bytes of a string or binary column; a longer value has a slice of its own."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        at, held = 0, 0
        for i, n in enumerate(lengths.tolist()):
            if i > at and (held + n > size or i - at >= rows):
                yield batch.slice(at, i - at)
                at, held = i, 0
            held += n
        if batch.num_rows > at:
            yield batch.slice(at)
