"""SimHash near-dedup with bit-sliced distance counting (operator 7).

Documents become 64-bit fingerprints; equal fingerprints collapse to one row.
Fingerprints within ``radius`` bits agree on two of ``radius + 2`` bit blocks,
so rows meet in the buckets of every pair of blocks. Inside a bucket the bits
are stored as vertical planes, distances of many lanes are counted at once by
carry-save steps, and a block of lanes is abandoned once all are too far. A
bucket gives a spanning forest of its links, never all its pairs.

Defined results: a null or empty text, or one of white space only, has
fingerprint 0 and links like any other; a null doc_id never names a component
(component_id is null if no member has an id); repeated rows each get a row;
other columns of the input are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tvpulse.llm.common import slices, staged
from tvpulse.llm.components import components

BITS = 64
#: Lanes that are counted and abandoned together.
LANES = 4096
#: Rows of a bucket that one task compares; larger buckets are dealt in chunk pairs.
CHUNK = 4096
#: Buckets at least this large keep their planes and are scanned row by row.
SCAN = 128


def fingerprint(text: bytes | None, shingle: int = 4, seed: int = 42) -> int:
    """SimHash of UTF-8 text: a bit is set if over half of the hashes set it."""
    words = (text or b"").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[:len(words) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, total = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), 1 << 15):
        pairs = zip(starts[at:at + (1 << 15)].tolist(), ends[at:at + (1 << 15)].tolist())
        hashes = np.array([digest(joined[s:e], seed) for s, e in pairs], dtype=">u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(starts)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp) and ``keep`` for every row; fp holds the 64 bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in slices(batches):
            fps = [fingerprint(t, shingle, seed) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64()), *b.columns[2:]], names=["doc_id", "fp", *keep])

    src = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"), *keep)
    return src.mapInArrow(run, ", ".join(["doc_id long, fp long", *(f"{c} {src.schema[c].dataType.simpleString()}" for c in keep)]))


def planes(fps: np.ndarray) -> np.ndarray:
    """Vertical form: row b holds bit b of every fingerprint, 64 lanes a word."""
    bits = np.unpackbits(fps.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    lanes = np.zeros((BITS, -(-len(fps) // BITS) * BITS), np.uint8)
    lanes[:, :len(fps)] = bits.T
    return np.packbits(lanes, axis=1, bitorder="little").view(np.uint64)


def within(diff: Iterator[np.ndarray], words: int, radius: int) -> np.ndarray | None:
    """Lanes whose set bits over all difference planes are at most ``radius``.

    Counters are bit-sliced: counter i holds bit i of every lane's distance,
    the last one sticks. Returns packed lanes, or None if the block is
    abandoned because every lane has exceeded the radius."""
    counters = [np.zeros(words, np.uint64) for _ in range(radius.bit_length())]
    over = np.zeros(words, np.uint64)

    def exceeded():
        more, equal = over.copy(), ~over
        for i in reversed(range(len(counters))):
            if not radius >> i & 1:
                more |= equal & counters[i]
            equal &= counters[i] if radius >> i & 1 else ~counters[i]
        return more

    for k, carry in enumerate(diff):
        for i in range(len(counters)):
            carry, counters[i] = counters[i] & carry, counters[i] ^ carry
        over |= carry
        if k % 8 == 7 and (~exceeded()).max() == 0:
            return None
    return ~exceeded()


def _lanes(mask: np.ndarray | None, n: int) -> np.ndarray:
    if mask is None:
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.unpackbits(mask.view(np.uint8), bitorder="little", count=n))


def near_pairs(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Indexes i with a[i] and b[i] within the radius."""
    found = []
    for at in range(0, len(a), LANES):
        diff = planes(a[at:at + LANES] ^ b[at:at + LANES])
        found.append(at + _lanes(within(iter(diff), diff.shape[1], radius), min(LANES, len(a) - at)))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def bucket_links(fps: np.ndarray, side: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning forest of a large bucket's links; side 0 and 1: only links across."""
    label, out = np.arange(len(fps)), []
    cross = side.min() != side.max()
    left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if cross else (np.arange(len(fps)),) * 2
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    blocks = [(right[at:at + LANES], planes(fps[right[at:at + LANES]])) for at in range(0, len(right), LANES)]
    for i in left.tolist():
        q = int(fps[i])
        for lanes, p in blocks:
            diff = (p[k] ^ ones if q >> (BITS - 1 - k) & 1 else p[k] for k in range(BITS))
            hit = lanes[_lanes(within(diff, p.shape[1], radius), len(lanes))]
            roots = np.unique(label[np.append(hit, i)])
            for r in roots[1:].tolist():
                out.append((roots[0], r))
            if len(roots) > 1:
                label[np.isin(label, roots[1:])] = roots[0]
    return [(int(fps[x]), int(fps[y])) for x, y in out]


def _links_of(batches: Iterator[pa.RecordBatch], radius: int):
    """Rows sorted by bucket -> links; a bucket has at most 2 * CHUNK-ish rows."""
    kind = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def work(key, fps, side):
        cuts = np.flatnonzero(np.any(key[1:] != key[:-1], axis=1)) + 1
        starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(fps)]))
        size, out = ends - starts, []
        for s, e in zip(starts[size >= SCAN].tolist(), ends[size >= SCAN].tolist()):
            out += bucket_links(fps[s:e], side[s:e], radius)
        small = np.repeat(size < SCAN, size)
        group = np.repeat(np.arange(len(size)), size)
        for shift in range(1, int(size[size < SCAN].max(initial=1))):
            i = np.flatnonzero(small[:-shift] & (group[:-shift] == group[shift:]))
            if not len(i):
                break
            a, b = fps[i], fps[i + shift]
            hit = near_pairs(a, b, radius)
            out += zip(a[hit].tolist(), b[hit].tolist())
        return out

    held = None
    for batch in batches:
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(6)]
        rows = [np.stack(cols[:4], axis=1), cols[4].view(np.uint64), cols[5]]
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows)]
        last = np.any(rows[0] != rows[0][-1], axis=1)
        cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
        held = [x[cut:] for x in rows]
        if cut:
            yield _arrow(work(*[x[:cut] for x in rows]), kind)
    if held is not None:
        yield _arrow(work(*held), kind)


def _arrow(links, kind):
    ends = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], schema=kind)


def fingerprint_links(distinct: DataFrame, radius: int = 4, chunk: int = CHUNK) -> DataFrame:
    """Distinct ``fp`` -> links (a, b) that connect all within ``radius`` bits."""
    n = radius + 2
    cuts = [BITS * k // n for k in range(n + 1)]
    block = [F.shiftrightunsigned("fp", cuts[k]).bitwiseAND((1 << cuts[k + 1] - cuts[k]) - 1) for k in range(n)]
    keys = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).alias("combo"), F.shiftleft(block[x], cuts[y + 1] - cuts[y]).bitwiseOR(block[y]).alias("value"))
        for k, (x, y) in enumerate(combinations(range(n), 2))])).alias("key")).select("fp", "key.*")
    sizes = keys.groupBy("combo", "value").agg(F.count("*").alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / chunk).cast("long")
    mine = F.pmod(F.xxhash64("fp"), parts)
    dealt = keys.join(sizes, ["combo", "value"]).select("combo", "value", "fp", mine.alias("mine"), F.explode(
        F.sequence(F.lit(0).cast("long"), parts - 1)).alias("other"))
    dealt = dealt.select(F.col("combo").cast("long"), "value", F.least("mine", "other").alias("lo"),
                         F.greatest("mine", "other").alias("hi"), "fp",
                         F.when(F.col("mine") <= F.col("other"), 0).otherwise(1).cast("long").alias("side"))
    bucket = ["combo", "value", "lo", "hi"]
    return dealt.repartition(*bucket).sortWithinPartitions(*bucket).mapInArrow(
        lambda it: _links_of(it, radius), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, seed: int = 42) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id."""
    return grouped(docs, shingle, radius, seed).select("doc_id", "fingerprint", "component_id")


def grouped(docs: DataFrame, shingle: int = 4, radius: int = 4, seed: int = 42, keep: tuple[str, ...] = ()) -> DataFrame:
    """``near_duplicates`` with the columns ``keep`` of the rows and each
    component's root, since components that share an id share its name."""
    fps = staged(fingerprints(docs, shingle, seed, keep), "simhash")
    distinct = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(fingerprint_links(distinct, radius))
    node = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = node.groupBy("root").agg(F.min("first").alias("component_id"))
    named = node.join(least, "root").select("fp", "component_id", "root")
    return fps.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                        "component_id", "root", *keep)


def fingerprint_column(text: str, shingle: int = 4, seed: int = 42) -> Column:
    """The hex fingerprint of a text column."""
    @F.udf("string")
    def hexed(raw):
        return f"{fingerprint(None if raw is None else bytes(raw), shingle, seed) & (1 << BITS) - 1:016x}"
    return hexed(F.col(text).cast("binary"))
