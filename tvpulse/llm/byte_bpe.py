"""Byte-level BPE with a two-tier lookup (operator 3).

Tier one: a minimal perfect hash (hash and displace) resolves pre-tokens that
are vocabulary entries as a whole. Tier two: every other pre-token is merged
by rank with a heap over linked bytes. The distinct pre-tokens of a slice of
documents are looked up together; two bounded tables remember recent ones.
Encoding and decoding run in one pass, so ids never leave the task as rows.

Defined results: a null or empty text has no ids and decodes to no bytes;
repeated rows each get a row; other columns of the input are ignored; an empty
table gives no rows. Texts are encoded whole, whatever their length.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tvpulse.llm.common import slices, weighed

#: Pre-tokens that a Python worker remembers in each of two tables (some 75 MB
#: each): when the newer is full it becomes the older, and the older goes.
REMEMBER = 300_000
#: Characters of the longest one that is remembered beyond its slice.
LONGEST = 64
#: Texts of these characters only (Latin letters, digits, marks, ASCII white
#: space) are split by a pattern with the classes written out, which is faster.
LATIN = re.compile("[\t-\r\x20-\x7e¡-ɏ‐-‧‰-⁞]*").fullmatch
_CLASSES = {r"\p{L}": "A-Za-zªµºÀ-ÖØ-öø-ɏ", r"\p{N}": "0-9²³¹¼-¾"}
_SHIFT = 40  # a heap entry is one number: the rank, then the place
_PLACE = (1 << _SHIFT) - 1
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def latin(pattern: str) -> str:
    """The pattern with its classes of letters and numbers as their Latin members."""
    for name, members in _CLASSES.items():
        pattern = re.sub(r"\[[^\]]*\]", lambda m: m[0].replace(name, members), pattern).replace(name, f"[{members}]")
    return pattern


class PerfectHash:
    """Minimal perfect hash of byte strings: n keys, n slots."""

    def __init__(self, keys: list[bytes]):
        self.n = max(1, len(keys))
        self.buckets = self.n // 4 + 1
        self.shift = np.zeros(self.buckets, np.uint64)
        mixed = self._mix(keys)
        bucket = (mixed % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        free = np.ones(self.n, bool)
        for b in np.argsort(cuts[:-1] - cuts[1:], kind="stable").tolist():
            own = mixed[order[cuts[b]:cuts[b + 1]]]
            if not len(own):
                break
            for at in (0, *(1 << k for k in range(4, 26))):
                shift = np.arange(at, max(16, 2 * at), dtype=np.uint64)
                slot = self._slot(own[None, :], shift[:, None])
                fits = np.flatnonzero(free[slot].all(axis=1))
                fits = [k for k in fits.tolist() if len(set(slot[k].tolist())) == len(own)][:1]
                if fits:
                    free[slot[fits[0]]] = False
                    self.shift[b] = shift[fits[0]]
                    break
            else:
                raise ValueError("no displacement found: are the keys distinct?")

    @staticmethod
    def _mix(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))

    def _slot(self, mixed: np.ndarray, d) -> np.ndarray:
        x = (mixed ^ (d * _PRIME)) * np.uint64(0xD6E8FEB86659FD93)
        return ((x ^ (x >> np.uint64(32))) % np.uint64(self.n)).astype(np.int64)

    def slots(self, keys: list[bytes]) -> np.ndarray:
        """A slot for every key; only that of a stored key means anything."""
        mixed = self._mix(keys)
        return self._slot(mixed, self.shift[(mixed % np.uint64(self.buckets)).astype(np.int64)])


class ByteBPE:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        self.hash = PerfectHash(list(ranks))
        self.keys: list[bytes | None] = [None] * self.hash.n
        self.ids = [0] * self.hash.n
        for slot, (key, rank) in zip(self.hash.slots(list(ranks)).tolist(), ranks.items()):
            self.keys[slot], self.ids[slot] = key, rank
        self.tokens = {rank: key for key, rank in ranks.items()}
        self.single = [ranks.get(bytes([b]), -1) for b in range(256)]
        # left token -> right token -> the token they join to
        self.joins: dict[int, dict[int, int]] = {rank: {} for rank in ranks.values()}
        for key, rank in ranks.items():
            for i in range(1, len(key)):
                if key[:i] in ranks and key[i:] in ranks:
                    self.joins[ranks[key[:i]]][ranks[key[i:]]] = rank
        self.known: dict[str, bytes] = {}  # pre-token -> its ids, four bytes each
        self.older: dict[str, bytes] = {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("known", "older", "split", "split_latin")}

    def __setstate__(self, state):
        self.__dict__ |= state | {"known": {}, "older": {}}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Merge the lowest-ranked neighbours first: a heap over linked tokens.

        An entry is stale if its place is gone or the pair there has another
        rank by now; ties go to the leftmost place."""
        part, joins, heap = [self.single[b] for b in piece], self.joins, []
        if len(part) > 1 and -1 in part:
            raise ValueError("the vocabulary lacks a single byte")
        for i, (left, right) in enumerate(zip(part, part[1:])):
            if (rank := joins[left].get(right)) is not None:
                heap.append(rank << _SHIFT | i)
        heapq.heapify(heap)
        pop, push, n = heapq.heappop, heapq.heappush, len(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            entry = pop(heap)
            rank, i = entry >> _SHIFT, entry & _PLACE
            j, left = after[i], part[i]
            if j >= n or left < 0 or joins[left].get(part[j]) != rank:
                continue
            part[i], part[j] = rank, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (found := joins[rank].get(part[k])) is not None:
                    push(heap, found << _SHIFT | i)
            h = before[i]
            if h >= 0 and (found := joins[part[h]].get(rank)) is not None:
                push(heap, found << _SHIFT | h)
        return tuple([p for p in part if p >= 0])

    def learn(self, pieces: list[str]) -> None:
        """Look up distinct pre-tokens: the perfect hash first, then merges."""
        raw = [p.encode() for p in pieces]
        for piece, key, slot in zip(pieces, raw, self.hash.slots(raw).tolist()):
            ids = (self.ids[slot],) if self.keys[slot] == key else self.merge(key)
            self.known[piece] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> list[list[int]]:
        if not hasattr(self, "split"):
            self.split, plain = regex.compile(self.pattern).findall, latin(self.pattern)
            self.split_latin = self.split if r"\p" in plain else re.compile(plain).findall
        pieces = [(self.split_latin if LATIN(t) else self.split)(t) for t in texts]
        if len(self.known) > REMEMBER:
            self.known, self.older = {}, self.known
        new = set(chain.from_iterable(pieces)).difference(self.known)
        again = [p for p in new if p in self.older]  # an intersection would walk the whole table
        self.known.update(zip(again, map(self.older.__getitem__, again)))
        self.learn(list(new.difference(again)))
        ids = [np.frombuffer(b"".join(map(self.known.__getitem__, p)), "<u4").tolist() for p in pieces]
        for piece in [p for p in new if len(p) > LONGEST]:
            del self.known[piece]
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def encode(docs: DataFrame, bpe: ByteBPE) -> DataFrame:
    """(doc_id, ids) for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(bpe)

    def run(batches: Iterator[pa.RecordBatch]):
        coder = shared.value
        for b in slices(batches, 64):
            ids = coder.encode([t or "" for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, bpe: ByteBPE) -> DataFrame:
    """(doc_id, ids, bytes): the bytes that the ids stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast(bpe)

    def run(batches: Iterator[pa.RecordBatch]):
        coder = shared.value
        for b in slices(batches, 64):
            at = b.column(1).offsets.to_pylist()
            ids = b.column(1).values.slice(at[0], at[-1] - at[0]).to_numpy().tolist()
            raw = [coder.decode(ids[i - at[0]:j - at[0]]) for i, j in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(raw, pa.binary())], names=["doc_id", "ids", "bytes"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, bytes binary")


def round_trip(docs: DataFrame, bpe: ByteBPE) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the decoded bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(bpe)

    def run(batches: Iterator[pa.RecordBatch]):
        coder = shared.value
        shown = {i: str(i).encode() for i in coder.tokens}
        for b in weighed(batches, 1):
            ids = coder.encode([t or "" for t in b.column(1).to_pylist()])
            listed = [hashlib.sha256(b" ".join(map(shown.__getitem__, i))).hexdigest() for i in ids]
            decoded = [hashlib.sha256(coder.decode(i)).hexdigest() for i in ids]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(len, ids), pa.int64()), pa.array(listed), pa.array(decoded)],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
