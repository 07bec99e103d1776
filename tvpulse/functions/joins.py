"""Equi-joins that keep NULL keys together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` where NULL equals NULL (a hash-partitioned join);
    the keys of ``left`` stay, then the other columns of both sides."""
    other = right.select(*[right[k].alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [left[k].eqNullSafe(other[f"_r_{k}"]) for k in keys])
    return left.join(other, on).drop(*[f"_r_{k}" for k in keys])
