"""Periodic runs of words over scale tiles (operator 12).

A run is a stretch of words with smallest period q that spans at least
``power`` periods and ``least`` words and that no neighbour extends. Periods
are cut into octaves [P, 2P). For each octave a document is exploded into
overlapping tiles that hold a boundary every P words; a tile goes on only if
the 2P words at one of its boundaries may recur an octave's period later
(equal 64-bit window hashes, so no run is missed). Tiles are dealt over the
cluster and solved alone: forward and backward Z-functions at a boundary give
the extent of every primitive period there, clipped to the tile. The fragments
are shuffled by document and period and stitched where they share a period's
length, which is exact: two stretches of period q with q words in common are
one stretch. A long document is thus many small tasks, not one.

Why nothing is missed: a run of 4q words holds boundaries no more than P apart
from its first P words on up to its last q + 3P, each of which sees 2P equal
words; a tile reaches P words before its boundaries and 5P after, so that
neighbouring fragments share at least 2q words and the outer ones reach both
ends.

Defined results: a null, empty or blank text has no words, no run and the
digest of the empty string; repeated rows each get a row; a null id is an id;
texts are read whole, whatever their length; equal runs cannot occur (one per
start and period); other columns of the input are ignored, so their names
never clash; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tvpulse.llm.common import staged, weighed

#: Words over which a tile's boundaries spread, or 8 P in higher octaves.
TILE = 4096
#: Window pairs that are compared at a time.
CELLS = 1 << 20

Rewrite = Callable[[object, list[bytes]], list[bytes]]


def window_hashes(level: np.ndarray, size: int) -> np.ndarray:
    """Hashes of twice as many words from hashes of ``size`` words."""
    later = np.zeros_like(level)
    later[:-size] = level[size:]
    mixed = (level * np.uint64(0x9E3779B97F4A7C15) + later) * np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(31))


def candidates(docs: list[np.ndarray]) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
    """(document, octave, first word, end, boundaries) of the tiles worth solving."""
    counts = np.array([len(d) for d in docs], np.int64)
    starts = np.concatenate(([0], np.cumsum(counts + 1)[:-1]))
    flat = np.concatenate([x for i, d in enumerate(docs) for x in (d, np.array([-1 - i], np.int64))]).astype(np.uint64)
    hashes, octave = window_hashes(flat, 1), 0
    while (long := np.flatnonzero(counts >= 4 << octave)).size:
        period = 1 << octave
        n = (counts[long] - 3 * period) // period + 1
        doc = np.repeat(long, n)
        at = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * period
        base, step = starts[doc] + at, max(1, CELLS // period)
        hit = np.concatenate([
            (hashes[b[:, None] + np.arange(period, 2 * period)] == hashes[b][:, None]).any(axis=1)
            for b in (base[i:i + step] for i in range(0, len(base), step))])
        span = max(8 * period, TILE)
        doc, at = doc[hit], at[hit]
        tile = at // span
        cuts = np.flatnonzero(np.diff(doc) | np.diff(tile)) + 1
        for d, t, bounds in zip(doc[np.concatenate(([0], cuts))].tolist() if len(doc) else [],
                                tile[np.concatenate(([0], cuts))].tolist() if len(doc) else [], np.split(at, cuts)):
            yield d, octave, max(0, t * span - period), min(int(counts[d]), (t + 1) * span + 4 * period), bounds
        octave += 1
        hashes = window_hashes(hashes, period * 2)


def z_function(s: list[int]) -> list[int]:
    """z[i]: how many items from i on equal those from the start."""
    n = len(s)
    z, left, right = [0] * n, 0, 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def solve(octave: int, low: int, words: list[int], bounds: list[int]) -> Iterator[tuple[int, int, int]]:
    """(period, start, end) of the stretches that the tile's boundaries see."""
    period, found = 1 << octave, {}
    for c in bounds:
        c -= low
        ahead = z_function(words[c:c + 5 * period])
        top = min(2 * period, len(ahead))
        z, q = np.array(ahead[:top]), np.arange(top)
        z[0] = 0
        # a root is a power if a smaller period covers two of it
        seen = np.maximum.accumulate(q + z)
        roots = np.flatnonzero((z[period:] >= q[period:]) & (seen[period - 1:top - 1] < 2 * q[period:])) + period
        if not len(roots):
            continue
        back = min(period, c)
        end = min(c + 2 * period, len(words))
        behind = z_function(words[c - back:c][::-1] + [-1] + words[c - back:end][::-1])
        for p in roots.tolist():
            start, stop = c - behind[back + 1 + end - c - p], c + p + ahead[p]
            parts = found.setdefault(p, [])
            if parts and parts[-1][1] - start >= p:
                parts[-1][1] = max(parts[-1][1], stop)
            else:
                parts.append([start, stop])
    for p, parts in found.items():
        for start, stop in parts:
            yield p, low + start, low + stop


def _explode(docs: DataFrame, rewrite: Rewrite | None, texts: bool) -> DataFrame:
    """One row per document (octave null) and one per tile worth solving.

    Only documents with such a tile, or all if ``texts``, carry their words on."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["row", "doc_id", "words", "collapsed_sha256", "octave", "low", "codes", "bounds"]
    types = [pa.int64(), None, pa.binary(), pa.string(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]):
        for b in weighed(batches, 2, rows=64):
            rows, ids = b.column(0).to_pylist(), b.column(1).to_pylist()
            words = [(t or b"").split() for t in b.column(2).to_pylist()]
            if rewrite:
                words = [rewrite(d, w) for d, w in zip(ids, words)]
            numbers: dict[bytes, int] = {}
            codes = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in ws), np.int64, len(ws)) for ws in words]
            out, held, marked = [], 0, set()
            schema = [b.schema.field(1).type if t is None else t for t in types]

            def flush(out):
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema)], names=names)
            for d, octave, low, high, bounds in candidates(codes):
                marked.add(d)
                out.append((rows[d], None, None, None, octave, low, codes[d][low:high], bounds))
                held += high - low
                if held > 1 << 20:
                    yield flush(out)
                    out, held = [], 0
            for i, ws in enumerate(words):
                joined = b" ".join(ws)
                out.append((rows[i], ids[i], joined if texts or i in marked else None,
                            None if i in marked else hashlib.sha256(joined).hexdigest(), None, None, None, None))
            yield flush(out)

    source = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(run, f"row long, doc_id {kind}, words binary, collapsed_sha256 string, octave int, low long, "
                                  "codes array<int>, bounds array<long>")


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            row, octave, low, codes, bounds = (b.column(k)[i].as_py() for k in range(5))
            found = list(solve(octave, low, codes, bounds))
            if found:
                period, start, stop = (np.array(x, np.int64) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), row)), *map(pa.array, (period, start, stop))],
                                                 names=["row", "period", "start", "stop"])


def stitch(fragments: DataFrame) -> DataFrame:
    """Join the fragments (row, period, start, stop) that share a period's length."""
    order = Window.partitionBy("row", "period").orderBy("start", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = fragments.withColumn("first", F.coalesce(before - F.col("start") < F.col("period"), F.lit(True)).cast("int"))
    parts = opened.withColumn("part", F.sum("first").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return (parts.groupBy("row", "period", "part").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
            .select("row", "period", "start", (F.col("stop") - F.col("start")).alias("length")))


def _collapse(batches: Iterator[pa.RecordBatch], texts: bool) -> Iterator[pa.RecordBatch]:
    """Drop every word that a run holds after the run's first period."""
    for b in weighed(batches, 2, rows=64):
        kept = []
        for text, runs in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
            words = (text or b"").split()
            change = np.zeros(len(words) + 1, np.int64)
            for r in runs or []:
                change[r["start"] + r["period"]] += 1
                change[r["start"] + r["length"]] -= 1
            keep = np.cumsum(change[:-1]) == 0
            kept.append(b" ".join(words if keep.all() else [words[i] for i in np.flatnonzero(keep).tolist()]))
        digest = pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())
        yield pa.RecordBatch.from_arrays([b.column(1), b.column(3), digest, pa.array(kept if texts else [None] * len(kept), pa.binary())],
                                         names=["doc_id", "runs", "collapsed_sha256", "text"])


def collapse(docs: DataFrame, least: int = 6, power: int = 4, rewrite: Rewrite | None = None, texts: bool = False) -> DataFrame:
    """(doc_id, runs, collapsed_sha256, text) for every row of ``docs``.

    ``runs`` lists (start, period, length) by start, then period. The digest
    and ``text`` (null unless ``texts``) are those of the kept words, joined by
    one space. ``rewrite`` may change a document's words before the search."""
    if power < 4:
        raise ValueError("tiles find runs of at least four periods")
    spread = staged(_explode(docs, rewrite, texts), "period-tiles", compression="zstd")
    kind = spread.schema["doc_id"].dataType.simpleString()
    tiles = (spread.filter("octave IS NOT NULL").select("row", "octave", "low", "codes", "bounds")
             .repartition("row", "octave", "low"))
    fragments = tiles.mapInArrow(_solve, "row long, period long, start long, stop long")
    runs = stitch(fragments).filter(F.col("length") >= F.greatest(F.lit(least), power * F.col("period")))
    listed = runs.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    of_runs = "array<struct<start:bigint,period:bigint,length:bigint>>"
    plain = spread.filter("octave IS NULL AND collapsed_sha256 IS NOT NULL").select(
        "doc_id", F.lit(None).cast(of_runs).alias("runs"), "collapsed_sha256", F.col("words").alias("text"))
    marked = spread.filter("octave IS NULL AND collapsed_sha256 IS NULL").join(listed, "row", "left")
    solved = marked.select("row", "doc_id", "words", "runs").mapInArrow(
        lambda batches: _collapse(batches, texts), f"doc_id {kind}, runs {of_runs}, collapsed_sha256 string, text binary")
    return plain.unionByName(solved).select("doc_id", F.coalesce("runs", F.array().cast(of_runs)).alias("runs"),
                                            "collapsed_sha256", F.col("text").cast("string").alias("text"))
