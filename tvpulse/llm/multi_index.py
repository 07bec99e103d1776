"""Approximate nearest neighbours by an inverted multi-index (operator 5).

Vectors are cut in two halves and each half is quantised by its own codebook;
a cell is a pair of centroids. A query walks the cells in the order of summed
half scores with a heap until enough candidates are covered, and the entries
of those cells are reranked by the exact measure (inner product, doubles).

Codebooks are fitted on a bounded sample; every valid vector is indexed. Cells
larger than ``CHUNK`` rows are dealt in chunks, so that no task holds a hot
cell. Defined results: vectors that are null, zero, of another length than the
commonest, or hold null or non-finite parts take no part; rows without an id
neither; repeated ids are separate candidates, but a query never finds its own
id; repeated rows of a query ask once, and different vectors under one query id
ask each for itself, their results ranked together (a candidate takes a rank
for each that finds it); ties go to the smaller id; with fewer candidates than
``k`` all are found.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tvpulse.llm.common import staged

#: Rows that the codebooks are fitted on, taken by a hash of the id.
SAMPLE = 16_384
MAX_CENTROIDS = 256
#: Rows that a cell holds on average, until the codebooks reach MAX_CENTROIDS.
CELL_ROWS = 200
#: Share of the indexed rows that the cells a query visits must cover together.
#: Fitted to recall: unstructured vectors (as in the test tables) need over half.
SHARE = 0.75
#: Rows of a cell that one task ranks at a time.
CHUNK = 2048
#: Queries ranked against a chunk at a time.
QUERIES = 256
#: Partial results that a task holds at most, to combine them.
HOLD = 600_000


def valid_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v): usable vectors in their own precision."""
    v = F.col(embedding) if df.schema[embedding].dataType.simpleString() == "array<float>" else F.col(embedding).cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).filter(
        "vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0").filter(~bad).filter(F.exists("v", lambda x: x != 0.0))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (common["n"] if common else 0))


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(7)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centres))[:, None]
        centres = np.where(n > 0, sums / np.maximum(n, 1), centres)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres ** 2).sum(axis=1) / 2
    return np.concatenate([np.argmax(x[at:at + 4096] @ centres.T - half, axis=1) for at in range(0, len(x), 4096)])


class MultiIndex:
    """Two codebooks, and the size of every cell (at most MAX_CENTROIDS squared)."""

    def __init__(self, books: tuple[np.ndarray, np.ndarray], sizes: dict[int, int] | None = None):
        self.books, self.sizes = books, sizes or {}
        self.cut = books[0].shape[1]

    def cells(self, x: np.ndarray) -> np.ndarray:
        return nearest(x[:, :self.cut], self.books[0]) * len(self.books[1]) + nearest(x[:, self.cut:], self.books[1])

    def walk(self, q: np.ndarray, wanted: int) -> list[int]:
        """Filled cells by falling sum of half scores, until ``wanted`` rows are covered."""
        a, b = self.books[0] @ q[:self.cut], self.books[1] @ q[self.cut:]
        ia, ib = np.argsort(-a, kind="stable").tolist(), np.argsort(-b, kind="stable").tolist()
        a, b = a[ia].tolist(), b[ib].tolist()
        heap, out, covered = [(-a[0] - b[0], 0, 0)], [], 0
        while heap and covered < wanted:
            _, i, j = heapq.heappop(heap)
            n = self.sizes.get(cell := ia[i] * len(ib) + ib[j], 0)
            if n:
                out.append(cell)
                covered += n
            if j + 1 < len(b):
                heapq.heappush(heap, (-a[i] - b[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-a[i + 1] - b[0], i + 1, 0))
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def build(vectors: DataFrame, sample: int = SAMPLE, max_centroids: int = MAX_CENTROIDS) -> tuple[MultiIndex, DataFrame]:
    """Index of ``valid_vectors``: the codebooks with cell sizes, and (cell, vec_id, v)."""
    n = vectors.count()
    k = max(1, min(max_centroids, round(math.sqrt(n / CELL_ROWS))))
    rows = vectors.filter(F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 30)) < int(min(1.0, sample / max(1, n)) * (1 << 30))) \
        .select("vec_id", "v").collect()
    rows = sorted((r["vec_id"], r["v"]) for r in rows) or [(r["vec_id"], r["v"]) for r in vectors.limit(1).collect()]
    x = np.array([v for _, v in rows]) if rows else np.zeros((1, 2))
    cut = max(1, x.shape[1] // 2)
    index = MultiIndex((kmeans(x[:, :cut], k), kmeans(x[:, cut:], k)))
    shared, kind = vectors.sparkSession.sparkContext.broadcast(index), vectors.schema["v"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(shared.value.cells(_matrix(b.column(1))), pa.int64()),
                                                  b.column(0), b.column(1)], names=["cell", "vec_id", "v"])

    entries = staged(vectors.select("vec_id", "v").mapInArrow(assign, f"cell long, vec_id long, v {kind}"), "ann-entries")
    sizes = {r["cell"]: r["n"] for r in entries.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    return MultiIndex(index.books, sizes), entries


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best rows of every query: falling score, then rising id."""
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    first = np.concatenate(([True], query[1:] != query[:-1])) if len(query) else np.zeros(0, bool)
    place = np.arange(len(query)) - np.flatnonzero(first)[np.cumsum(first) - 1] if len(query) else query
    return query[place < k], ids[place < k], score[place < k]


def _combined(found, k: int):
    """Partial results of many cells, combined inside the task before they leave
    it: at most ``k`` rows a query, unless more than HOLD rows are held."""
    held, size = [], 0
    for rows in found:
        held.append(rows)
        size += len(rows[0])
        if size > HOLD:
            held = [_best(*(np.concatenate(x) for x in zip(*held)), k)]
            size = len(held[0][0])
            if size > HOLD // 2:
                yield held.pop()
                size = 0
    if size:
        yield _best(*(np.concatenate(x) for x in zip(*held)), k)


def _rank(batches: Iterator[pa.RecordBatch], k: int):
    """Rows sorted by (cell, chunk, side): entries first, then the queries that visit."""
    at, ids, rows, waiting = None, [], [], []

    def flush():
        if not waiting or not ids:
            waiting.clear()
            return None
        own = np.concatenate(ids)
        order = np.argsort(own, kind="stable")
        own, x = own[order], np.concatenate(rows)[order]
        out, longest = [], np.sqrt((x * x).sum(axis=1).max())
        for (q, v), near in zip(waiting, np.array([v for _, v in waiting]) @ x.T):
            free = np.flatnonzero(own != q)
            if len(free) > k:
                # a product's last bits vary with its batch: all rows that may be among the best stay
                slack = 1e-12 * longest * np.sqrt((v * v).sum())
                free = free[near[free] >= np.partition(near[free], len(free) - k)[len(free) - k] - slack]
            score = (x[free] * v).sum(axis=1)  # row by row in one fixed order
            best = np.argsort(-score, kind="stable")[:k]
            out.append((np.full(len(best), q), own[free[best]], score[best]))
        waiting.clear()
        return tuple(np.concatenate(c) for c in zip(*out))

    for b in batches:
        key = np.stack([b.column(i).to_numpy() for i in range(3)], axis=1)
        cuts = [0, *(np.flatnonzero(np.any(key[1:] != key[:-1], axis=1)) + 1).tolist(), len(key)]
        vec, x = b.column(3).to_numpy(), _matrix(b.column(4)) if len(key) else None
        for s, e in zip(cuts[:-1], cuts[1:]):
            if s == e:
                continue
            if at != (group := tuple(key[s, :2].tolist())):
                if (done := flush()) is not None:
                    yield done
                at, ids, rows = group, [], []
            if key[s, 2] == 0:
                ids.append(vec[s:e])
                rows.append(x[s:e])
                continue
            for i in range(s, e):
                waiting.append((int(vec[i]), x[i]))
                if len(waiting) >= QUERIES and (done := flush()) is not None:
                    yield done
    if (done := flush()) is not None:
        yield done


def search(queries: DataFrame, index: MultiIndex, entries: DataFrame, k: int = 20, share: float = SHARE,
           chunk: int = CHUNK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of each query's candidates.

    ``queries`` holds (vec_id, v); the cells a query visits cover ``share`` of
    the index, and ``k + 1`` rows at least."""
    shared, kind = queries.sparkSession.sparkContext.broadcast(index), queries.schema["v"].dataType.simpleString()
    wanted = max(k + 1, math.ceil(share * sum(index.sizes.values())))

    def visit(batches: Iterator[pa.RecordBatch]):
        ix = shared.value
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                cells = [ix.walk(q, wanted) for q in _matrix(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(
                    [[(c, -(-ix.sizes[c] // chunk)) for c in own] for own in cells],
                    pa.list_(pa.struct([("cell", pa.int64()), ("chunks", pa.int64())])))], names=["vec_id", "v", "cells"])

    visits = queries.select("vec_id", "v").distinct().repartition(queries.sparkSession.sparkContext.defaultParallelism).mapInArrow(
        visit, f"vec_id long, v {kind}, cells array<struct<cell:bigint,chunks:bigint>>")
    visits = visits.select("vec_id", "v", F.inline("cells")).select(
        "cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.lit(1).cast("long").alias("side"),
        "vec_id", "v")
    large = [(c, -(-n // chunk)) for c, n in index.sizes.items() if n > chunk]
    split = entries.withColumn("chunk", F.lit(0).cast("long"))
    if large:
        table = F.broadcast(queries.sparkSession.createDataFrame(large, "cell long, parts long"))
        split = entries.join(table, "cell", "left").withColumn("chunk", F.when(F.col("parts").isNull(), 0).otherwise(
            F.pmod(F.xxhash64("vec_id"), F.col("parts"))).cast("long"))
    both = split.select("cell", "chunk", F.lit(0).cast("long").alias("side"), "vec_id", "v").unionByName(visits)
    found = both.repartition("cell", "chunk").sortWithinPartitions("cell", "chunk", "side").mapInArrow(
        lambda it: (pa.RecordBatch.from_arrays([pa.array(c) for c in rows], names=["query_id", "vec_id", "score"])
                    for rows in _combined(_rank(it, k), k)), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
