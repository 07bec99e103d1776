"""Line dedup by distinct-site spread (operator 9).

Every line gets a HyperLogLog sketch of the sites that show it; sketches merge
by aggregation. Lines whose estimate lies well above the threshold are
boilerplate, lines well below are not, and lines within the sketch's error of
the threshold get an exact distinct count. Boilerplate lines are removed from
every document but the one with the smallest doc_id that has them.

Lines are the pieces between ``\\n``, compared after trimming spaces; lines
shorter than ``min_chars`` are never removed. Defined results: a null source
is no site; a null text counts as empty; a null doc_id is smallest only where
every holder's id is null; repeated rows are treated alike; input columns of
any name pass through untouched; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tvpulse.llm.common import row_key, staged

MIN_SITES = 10
MIN_CHARS = 20
LG_K = 8
#: Standard errors of a sketch within which a line is counted exactly.
SIGMAS = 4


def _lines(docs: DataFrame, site: str, min_chars: int) -> DataFrame:
    """(key, doc_id, site, pos, h1, h2): one row per line that could go."""
    line = F.trim(F.col("line"))
    rows = docs.select(row_key("doc_id", "text").alias("key"), F.col("doc_id"), F.col(site).cast("string").alias("site"),
                       F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return rows.filter(F.length(line) >= min_chars).select(
        "key", "doc_id", "site", "pos", F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"))


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """(h1, h2, first) of lines on at least ``min_sites`` distinct sites."""
    band = SIGMAS * 1.04 / math.sqrt(1 << lg_k) * min_sites + 1
    spread = lines.groupBy("h1", "h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites"), F.min("doc_id").alias("first"))
    likely = staged(spread.filter(F.col("sites") >= min_sites - band), "line-spread")
    near = likely.filter(F.col("sites") <= min_sites + band)
    exact = lines.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi").select("h1", "h2", "site").distinct() \
        .groupBy("h1", "h2").agg(F.count("site").alias("exact")).filter(F.col("exact") >= min_sites)
    return likely.filter(F.col("sites") > min_sites + band).select("h1", "h2", "first").unionByName(
        near.join(exact, ["h1", "h2"]).select("h1", "h2", "first"))


def remove_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES,
                       min_chars: int = MIN_CHARS, lg_k: int = LG_K) -> DataFrame:
    """(doc struct, text, n_lines, n_removed): ``doc`` holds every input column."""
    lines = _lines(docs, site, min_chars)
    found = staged(boilerplate(lines, min_sites, lg_k), "line-boilerplate")
    gone = lines.select("key", "doc_id", "pos", "h1", "h2").join(found, ["h1", "h2"]) \
        .filter(~F.col("doc_id").eqNullSafe(F.col("first"))) \
        .groupBy("key").agg(F.collect_set("pos").alias("gone"))
    whole = docs.select(row_key("doc_id", "text").alias("key"), F.struct("*").alias("doc"))
    pieces = F.split(F.coalesce("doc.text", F.lit("")), "\n")
    kept = F.array_join(F.filter(pieces, lambda x, i: ~F.array_contains(F.col("gone"), i)), "\n")
    return whole.join(gone, "key", "left").select(
        "doc", F.when(F.col("gone").isNull(), F.col("doc.text")).otherwise(kept).alias("text"),
        F.size(pieces).cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))


ORACLE = """
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
wide AS (
  SELECT trim(line, ' ') AS line, min(doc_id) AS first FROM lines WHERE length(trim(line, ' ')) >= 20
  GROUP BY 1 HAVING count(DISTINCT source) >= 10)
SELECT doc_id, count(*) AS n_lines, count(first) FILTER (WHERE first IS DISTINCT FROM doc_id) AS n_removed,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY pos)
         FILTER (WHERE first IS NULL OR first IS NOT DISTINCT FROM doc_id), '')) AS kept_sha256
FROM lines l LEFT JOIN wide w ON trim(l.line, ' ') = w.line GROUP BY doc_id
"""
