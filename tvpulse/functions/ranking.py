"""Exact running counts over an ordering without a single-task window.

``cumulative_before`` computes, for every row, the total weight of the rows
that precede it in ``order_cols`` within ``partition_cols``. A keyless or
low-cardinality ordered window would sort everything in one task; instead the
ordering is cut into monotone buckets (``bucket`` must be non-decreasing in
the order), bucket totals are prefix-summed over at most a few thousand
bucket rows, and only rows of the same bucket are sorted together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tvpulse.functions.joins import join_null_safe


def cumulative_before(df: DataFrame, partition_cols: list[str], order_cols: list[str], bucket: Column,
                      weight: Column | None = None, out: str = "_before") -> DataFrame:
    weight = F.lit(1).cast("bigint") if weight is None else weight.cast("bigint")
    b = df.withColumn("_bucket", bucket).withColumn("_w", weight)
    keys = list(partition_cols) + ["_bucket"]
    totals = b.groupBy(*keys).agg(F.sum("_w").alias("_bw"))
    over_buckets = Window.partitionBy(*partition_cols).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, F.coalesce(F.sum("_bw").over(over_buckets), F.lit(0)).alias("_carry"))
    b = join_null_safe(b, totals, keys)
    inside = Window.partitionBy(*keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    return (b.withColumn(out, F.col("_carry") + F.coalesce(F.sum("_w").over(inside), F.lit(0)))
            .drop("_bucket", "_w", "_carry"))


def log_bucket(value: Column, per_octave: int = 16) -> Column:
    """Monotone bucket for non-negative values (0 gets its own lowest bucket)."""
    return F.when(value <= 0, F.lit(-100000)).otherwise(F.floor(F.log2(value) * per_octave)).cast("bigint")
