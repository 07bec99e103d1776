"""top-k similarity search over vectors and over whole texts.

Both score blocks of queries in each task, which keeps its best rows per query;
a per-query top-k follows. Scores are cosine similarities; ranking uses the score rounded
to 9 decimals, then the id, so exact copies tie deterministically.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tvpulse.session import checkpoint_dir


def _top_k(scored: DataFrame, query_col: str, id_col: str, k: int) -> DataFrame:
    w = Window.partitionBy(query_col).orderBy(F.col("SCORE").desc(), F.col(id_col).asc())
    return scored.withColumn("RANK", F.row_number().over(w)).filter(F.col("RANK") <= k)


def label_centroids(vectors: DataFrame, id_col="vec_id", vec_col="embedding", label_col="label") -> DataFrame:
    """Mean vector per label (element-wise), as query vectors keyed by label."""
    exploded = vectors.select(label_col, F.posexplode(F.col(vec_col).cast("array<double>")).alias("pos", "x"))
    per_pos = exploded.groupBy(label_col, "pos").agg(F.avg("x").alias("x"))
    return per_pos.groupBy(label_col).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("QUERY_VECTOR")
    ).select(F.col(label_col).alias("QUERY_ID"), "QUERY_VECTOR", F.col(label_col).alias("FILTER_VALUE"))


def vector_topk(corpus: DataFrame, queries: DataFrame, k: int = 3, id_col="vec_id", vec_col="embedding",
                filter_col: str | None = "label", returned: tuple[str, ...] = ()) -> DataFrame:
    """for each query (QUERY_ID, QUERY_VECTOR[, FILTER_VALUE]) the k most
    cosine-similar corpus rows, of all rows or of those whose ``filter_col``
    equals the query's FILTER_VALUE (the attribute filter), with the corpus
    columns that are asked for.

    Queries are dealt into blocks of at most BLOCK_CELLS cells, whose matrix is
    broadcast; a task multiplies its rows with it batch by batch and keeps its
    best ``k`` per query, so k rows a query leave a task and no vector is ever
    shuffled. The returned columns are joined to the found rows alone. Vectors
    that are null, zero, of another length or hold null or non-finite numbers
    are never found; ids must be unique and not null."""
    checkpoint_dir(corpus.sparkSession)
    wanted = ["QUERY_ID", "QUERY_VECTOR", *(["FILTER_VALUE"] if filter_col else [])]
    asked = queries.select(*wanted).checkpoint()
    columns = [id_col, *([filter_col] if filter_col else [])]
    source = corpus.select(*columns, F.col(vec_col).cast("array<double>").alias("_v")).filter("_v IS NOT NULL")
    out = f"QUERY_ID {asked.schema['QUERY_ID'].dataType.simpleString()}, `{id_col}` {corpus.schema[id_col].dataType.simpleString()}, SCORE double"
    found = [source.mapInPandas(_nearest(corpus.sparkSession, id_col, filter_col, block, k), out) for block in _vector_blocks(asked)]
    if not found:
        found = [corpus.sparkSession.createDataFrame([], out)]
    top = _top_k(reduce(DataFrame.unionByName, found), "QUERY_ID", id_col, k)
    if not returned:
        return top
    # k rows a query: small beside the corpus, which is read for these columns only
    return top.join(corpus.select(id_col, *returned), id_col)


def _vector_blocks(asked: DataFrame):
    """Lists of query rows with at most BLOCK_CELLS vector cells together."""
    block, cells = [], 0
    for row in asked.filter("QUERY_VECTOR IS NOT NULL").orderBy("QUERY_ID").toLocalIterator():
        if block and cells + len(row["QUERY_VECTOR"]) > BLOCK_CELLS:
            yield block
            block, cells = [], 0
        block.append(row)
        cells += len(row["QUERY_VECTOR"])
    if block:
        yield block


def _unit_rows(vectors, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The usable vectors as unit rows, and which they are."""
    rows = [v if v is not None and len(v) == size else None for v in vectors]
    matrix = np.array([np.full(size, np.nan) if v is None else np.asarray(v, dtype=np.float64) for v in rows]).reshape(len(rows), size)
    norms = np.sqrt((matrix * matrix).sum(axis=1))
    good = np.isfinite(norms) & (norms > 0)
    return matrix[good] / norms[good, None], np.flatnonzero(good)


def _nearest(spark, id_col: str, filter_col: str | None, block: list, k: int):
    """A task's best ``k`` rows for every query of a block, for ``mapInPandas``."""
    by_size: dict[int, list] = {}
    for row in block:
        by_size.setdefault(len(row["QUERY_VECTOR"]), []).append(row)
    groups = []
    for size, rows in by_size.items():
        matrix, good = _unit_rows([r["QUERY_VECTOR"] for r in rows], size)
        groups.append((size, matrix, [(rows[i]["QUERY_ID"], rows[i]["FILTER_VALUE"] if filter_col else None) for i in good]))
    shared = spark.sparkContext.broadcast(groups)

    def best(batches):
        kept = None
        for batch in batches:
            for size, matrix, asked in shared.value:
                units, at = _unit_rows(batch["_v"], size)
                if not len(at) or not asked:
                    continue
                scores = np.round(units @ matrix.T, 9)
                ids = batch[id_col].to_numpy()[at]
                values = batch[filter_col].to_numpy()[at] if filter_col else None
                found = [] if kept is None else [kept]
                for q, (query, value) in enumerate(asked):
                    rows = np.flatnonzero(values == value) if filter_col else np.arange(len(at))
                    if len(rows) > k:  # all that reach the k-th best here, ties included
                        rows = rows[scores[rows, q] >= np.partition(scores[rows, q], -k)[-k]]
                    if len(rows):
                        found.append(pd.DataFrame({"QUERY_ID": [query] * len(rows), id_col: ids[rows], "SCORE": scores[rows, q]}))
                if found:
                    kept = (pd.concat(found).sort_values(["QUERY_ID", "SCORE", id_col], ascending=[True, False, True])
                            .groupby("QUERY_ID").head(k))
        if kept is not None:
            yield kept

    return best


# ---- text --------------------------------------------------------------------------

def normalize_text(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"\s+", " ")


_CODE_BITS = 21  # every Unicode code point fits in 21 bits


def _codes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct bigram codes of a text and their counts."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    return np.unique((cp[:-1] << _CODE_BITS) | cp[1:], return_counts=True)


def _bigram_counter(id_col: str):
    def count(batches):
        for pdf in batches:
            ids, grams, tfs = [], [], []
            for doc, text in zip(pdf[id_col].to_numpy(), pdf["_t"].to_numpy()):
                if text is None or len(text) < 2:
                    continue
                codes, counts = _codes(text)
                ids.append(np.full(len(codes), doc))
                grams.append(codes)
                tfs.append(counts)
            if ids:
                yield pd.DataFrame({id_col: np.concatenate(ids), "GRAM": np.concatenate(grams),
                                    "TF": np.concatenate(tfs).astype(np.int64)})
    return count


def bigram_counts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, GRAM, TF) with GRAM a 42-bit code of the two code points.

    Normalisation stays a JVM expression; the per-text counting is numpy in
    Arrow batches (one ``np.unique`` per text), so each text yields one row
    per distinct bigram instead of one exploded row per character. Ids must
    be unique per text (one text per row)."""
    id_type = df.schema[id_col].dataType.simpleString()
    src = df.select(id_col, normalize_text(F.col(text_col)).alias("_t"))
    return src.mapInPandas(_bigram_counter(id_col), f"{id_col} {id_type}, GRAM bigint, TF bigint")


#: Weight cells (bigrams x queries) that one block of queries may broadcast (80 MB).
BLOCK_CELLS = 10_000_000
#: Texts that are scored together against a block.
SCORED_TOGETHER = 1024


def _query_blocks(q_tf: DataFrame):
    """Lists of query ids whose weight matrix stays within BLOCK_CELLS (one
    query is always a block of its own at least)."""
    block, grams = [], 0
    for row in q_tf.groupBy("QUERY_ID").agg(F.count(F.lit(1)).alias("n")).orderBy("QUERY_ID").toLocalIterator():
        if block and (grams + row["n"]) * (len(block) + 1) > BLOCK_CELLS:
            yield block
            block, grams = [], 0
        block.append(row["QUERY_ID"])
        grams += row["n"]
    if block:
        yield block


def text_topk(corpus: DataFrame, queries: DataFrame, k: int = 3, id_col: str = "doc_id", text_col: str = "text",
              query_id: str = "QUERY_ID", query_text: str = "QUERY_TEXT", filter_col: str | None = None,
              filter_value=None) -> DataFrame:
    """character-bigram TF-IDF cosine, top ``k`` corpus texts per query.

    A bigram is two neighbouring code points of the normalised text, and
    IDF = ln((1 + N) / (1 + df)) + 1 over the (filtered) corpus. One exact
    method at every size:

    1. document frequencies and the norm of every text are Spark aggregates
       (the IDF table is checkpointed and never collected);
    2. queries are dealt into blocks of at most BLOCK_CELLS weights, and each
       block's weights, already divided by the query's norm, are broadcast;
    3. each block scores every text in one vectorised pass in which a task
       keeps only its best ``k`` per query, so at most k x queries rows leave
       a task.

    Null texts and texts of one character share no bigram and are never found.
    Ids must be unique and not null."""
    if filter_col is not None:
        corpus = corpus.filter(F.col(filter_col) == F.lit(filter_value))
    checkpoint_dir(corpus.sparkSession)
    n_docs = corpus.count()
    q_tf = bigram_counts(queries.select(F.col(query_id).alias("QUERY_ID"), F.col(query_text).alias("_qt")),
                         "QUERY_ID", "_qt")
    doc_tf = bigram_counts(corpus, id_col, text_col)
    idf = (doc_tf.groupBy("GRAM").agg(F.count(F.lit(1)).alias("DF"))
           .select("GRAM", (F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("DF"))) + F.lit(1.0)).alias("IDF"))
           .checkpoint())
    weight = F.col("TF") * F.coalesce(F.col("IDF"), F.lit(math.log(1.0 + n_docs) + 1.0))
    norms = (doc_tf.join(idf, "GRAM").groupBy(id_col)
             .agg(F.sqrt(F.sum(weight * weight)).alias("_norm")))
    texts = (corpus.select(id_col, normalize_text(F.col(text_col)).alias("_t")).join(norms, id_col))
    # a text adds TF * IDF per bigram, so the IDF is folded into the query's side
    q_w = q_tf.join(idf, "GRAM", "left").select("QUERY_ID", "GRAM", weight.alias("WQ"), "IDF").checkpoint()
    q_norm = q_w.groupBy("QUERY_ID").agg(F.sqrt(F.sum(F.col("WQ") * F.col("WQ"))).alias("QN"))
    q_w = q_w.filter("IDF IS NOT NULL").join(q_norm, "QUERY_ID") \
        .select("QUERY_ID", "GRAM", (F.col("WQ") / F.col("QN") * F.col("IDF")).alias("W"))
    types = {"QUERY_ID": q_tf.schema["QUERY_ID"].dataType, id_col: corpus.schema[id_col].dataType}
    out = ", ".join(f"`{c}` {t.simpleString()}" for c, t in types.items()) + ", SCORE double"
    found = [texts.mapInPandas(_block_best(corpus.sparkSession, id_col,
                                           q_w.filter(F.col("QUERY_ID").isin(block)).toPandas(), k), out)
             for block in _query_blocks(q_tf)]
    if not found:
        found = [corpus.sparkSession.createDataFrame([], out)]
    return _top_k(reduce(DataFrame.unionByName, found), "QUERY_ID", id_col, k)


def _block_best(spark, id_col: str, weights: pd.DataFrame, k: int):
    """A task's best ``k`` texts for every query of one block, as a function
    for ``mapInPandas``; ``weights`` holds the block's (QUERY_ID, GRAM, W)."""
    query_ids, q_at = np.unique(weights["QUERY_ID"].to_numpy(), return_inverse=True)
    grams, g_at = np.unique(weights["GRAM"].to_numpy(np.int64), return_inverse=True)
    matrix = np.zeros((len(grams), len(query_ids)))
    matrix[g_at, q_at] = weights["W"].to_numpy(np.float64)
    shared = spark.sparkContext.broadcast((query_ids, grams, matrix))

    def cosines(texts, norms, grams, matrix):
        """(texts x queries) cosines to 9 decimals; 0 shared bigrams give -1."""
        out = np.full((len(texts), matrix.shape[1]), -1.0)
        for row, (text, norm) in enumerate(zip(texts, norms)):
            codes, counts = _codes(text)
            at = np.minimum(np.searchsorted(grams, codes), len(grams) - 1)
            hit = grams[at] == codes
            dots = counts[hit] @ matrix[at[hit]]
            out[row] = np.where(dots > 0, np.round(dots / norm, 9), -1.0)
        return out

    def best(batches):
        query_ids, grams, matrix = shared.value
        if not len(grams):
            return
        kept = []
        for batch in batches:
            for start in range(0, len(batch), SCORED_TOGETHER):
                part = batch.iloc[start:start + SCORED_TOGETHER]
                score = cosines(part["_t"], part["_norm"], grams, matrix)
                # all that reach a query's k-th best here, ties included
                cut = np.partition(score, -k, axis=0)[-k] if len(score) > k else np.full(score.shape[1], -1.0)
                row, query = np.nonzero((score >= cut) & (score >= 0))
                kept.append(pd.DataFrame({"QUERY_ID": query_ids[query], id_col: part[id_col].to_numpy()[row],
                                          "SCORE": score[row, query]}))
                kept = [pd.concat(kept).sort_values(["QUERY_ID", "SCORE", id_col], ascending=[True, False, True])
                        .groupby("QUERY_ID").head(k)]
        yield from kept

    return best
