"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tvpulse.llm.common import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: tie the neighbours of a node to the least node it knows."""
    if large:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = near.join(least, "a")
    if large:
        out = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(a, b) links between long ids -> (node, root), root the least reachable.

    Nodes without links don't appear. Every round is written to the shared
    folder; rounds grow with the logarithm of the longest chain."""
    def state(df):
        row = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return row["n"], row["h"]

    edges = staged(edges.select("a", "b").filter("a <> b").distinct(), "links")
    seen = state(edges)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        edges = staged(_star(_star(edges, True), False), "links")
        now = state(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    star = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return star.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
