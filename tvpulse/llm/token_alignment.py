"""Alignment of two tokenizers over exact distinct texts (operator 11).

Rows are shuffled by their full text, counted map-side first, so that a text
is tokenised and aligned once however often it occurs. Byte offsets where both
sequences have an end cut them into groups; a pair of tokens whose byte ranges
overlap is a link. The texts' distinct id pairs, weighted by the copies of the
text, give the pairs' document counts; the counts come back to the texts and
the measures to all rows.

Joins are safe from hot keys by one rule: keys with more than 1/n of the total
weight are fewer than n, whatever the data, and are broadcast; every other key
has at most 1/n of the rows and is joined by shuffle. This holds for id pairs
(a frequent pair is in most texts) and for texts (one may have a third of all
rows as copies).

Inside a task a text is cut at single spaces between visible characters, and
before a full stop or comma that ends a word. Both tokenizers always end a token
there (checked for the piece model's vocabulary when it is opened), so the parts
are aligned alone and remembered; the text's result is their concatenation.

Defined results: a null or empty text, or one whose joined token bytes differ
from a space and the text under either tokenizer (it holds U+2581, say), has no
tokens, zero measures and '' for its groups; it counts for no pair. Each row
is a document, also when its id is null or repeated; texts are encoded whole;
other columns of the input are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tvpulse.llm.common import staged, weighed
from tvpulse.llm.recent import Recent, byte_alphabet, byte_level

#: Bounds of the broadcast tables: fewer pairs, fewer texts than this.
HOT_PAIRS = 1 << 18
HOT_TEXTS = 1 << 14
#: Wide dictionaries: ids repeat, so their numbers need few bits.
DENSE = {"parquet.dictionary.page.size": str(8 << 20), "compression": "zstd"}
#: Marks a part that has no space before it: no text can hold half a surrogate pair.
STOP = "\ud800"
SPACE = byte_level(" ")
MEASURES = ("n_a", "n_b", "n_groups", "n_links")


class Aligner:
    """Tokenises and aligns texts; ``byte_file`` is a byte-level tokenizer of the
    tokenizers library, ``piece_file`` a sentencepiece model that adds a space."""

    def __init__(self, byte_file: str, piece_file: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(byte_file)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        alphabet = byte_alphabet()
        with open(byte_file, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        self.lengths_a, self.lengths_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.bytes_a, self.bytes_b))
        self.size_a, self.size_b = len(self.bytes_a), len(pieces)
        self.shown = [f"{i}{end}".encode() for n, ends in ((self.size_a, ",|"), (self.size_b, ",;")) for end in ends for i in range(n)]
        # a token never holds a space after something else, nor a stop after a letter
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.stops = self.cuts and not any(re.search("[A-Za-z][.,]", p) for p in pieces)
        self.rough = re.compile(r" (?:(?<![\w!-~] )|(?![\w!-~]))").search
        self.split = re.compile(r"(?<=[\w!-~]) (?=[\w!-~])").split
        self.odd = re.compile(r"(?<![A-Za-z])[.,] ").search
        # runs of Latin letters and of others; a contraction is left whole
        self.runs = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+|[^A-Za-zÀ-ÖØ-öø-ɏ]+").findall
        self.marks = re.compile("[!-&(-/:-@\\[-`{-~]+").fullmatch
        self.tails = Recent(lambda marks: self.a.encode(marks, add_special_tokens=False).ids, limit=1 << 20)
        self.known = Recent(overhead=350, weigh=lambda v: len(v[1]) + len(v[2]) if v else 0)

    def parts(self, text: str) -> list[str]:
        if not self.cuts:
            return [text]
        if self.rough(text):
            return self.split(text)
        if self.stops and not self.odd(text):
            text = text.replace(". ", f" {STOP}. ").replace(", ", f" {STOP}, ")
        return text.split(" ")

    def ids_a(self, part: str) -> list[int]:
        """A run of letters is one pre-token and goes to the library's model; so
        is a run of marks after it. Other parts go through the tokenizer."""
        runs = self.runs(part)
        if part[:1] == STOP:
            return self.tails[part[1:]]
        if len(runs) <= 2 and runs[0].isalpha() and (len(runs) == 1 or self.marks(runs[1])):
            ids = [t.id for t in self.a.model.tokenize(SPACE + byte_level(runs[0]))]
            return ids if len(runs) == 1 else ids + self.tails[runs[1]]
        return self.a.encode(" " + part, add_special_tokens=False).ids

    def align(self, parts: list[str]) -> list[tuple | None]:
        """(n_a, groups, pairs) of each part, None where the tokens don't spell
        a space and the part. ``pairs`` holds one 8-byte id pair per link."""
        out: list[tuple | None] = []
        for at in range(0, len(parts), 4096):
            some = parts[at:at + 4096]
            a = list(map(self.ids_a, some))
            b = self.b.encode([p.removeprefix(STOP) for p in some], num_threads=1)
            good = []
            for i, part in enumerate(some):
                if part[:1] == STOP:
                    raw, b[i] = part[1:].encode(), [self.b.piece_to_id(part[1:])]
                else:
                    raw = b" " + part.encode()
                good.append(b"".join(map(self.bytes_b.__getitem__, b[i])) == raw == b"".join(map(self.bytes_a.__getitem__, a[i])))
            found = iter(self._aligned([x for x, g in zip(a, good) if g], [y for y, g in zip(b, good) if g]))
            out += [next(found) if g else None for g in good]
        return out

    def _aligned(self, a: list[list[int]], b: list[list[int]]) -> Iterator[tuple]:
        """The parts side by side as one sequence of bytes: all end where both
        sequences have an end. ``upto_x[i]``: tokens of x that end by byte i."""
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(x), np.int64, int(n.sum())) for x, n in ((a, n_a), (b, n_b)))
        if not len(ids_a):
            return
        ends_a, ends_b = np.cumsum(self.lengths_a[ids_a]), np.cumsum(self.lengths_b[ids_b])
        upto_a, upto_b = np.zeros(ends_a[-1] + 1, np.int64), np.zeros(ends_a[-1] + 1, np.int64)
        upto_a[ends_a] = upto_b[ends_b] = 1
        both, either = upto_a & upto_b, np.flatnonzero(upto_a | upto_b)
        upto_a, upto_b, groups = np.cumsum(upto_a), np.cumsum(upto_b), np.cumsum(both)
        # every stretch between ends, of whichever sequence, is one overlapping pair
        pairs = ids_a[upto_a[either - 1]] * self.size_b + ids_b[upto_b[either - 1]]
        # a group's A tokens stand before its B tokens
        cuts = np.flatnonzero(both)
        order_a = np.arange(len(ids_a)) + np.concatenate(([0], upto_b[cuts]))[groups[ends_a - 1]]
        order_b = np.arange(len(ids_b)) + upto_a[cuts][groups[ends_b - 1]]
        codes = np.empty(len(ids_a) + len(ids_b), np.int64)
        codes[order_a] = ids_a + both[ends_a] * self.size_a
        codes[order_b] = 2 * self.size_a + ids_b + both[ends_b] * self.size_b
        shown = list(map(self.shown.__getitem__, codes.tolist()))
        raw, stops = pairs.tobytes(), ends_a[np.cumsum(n_a) - 1]
        cut_pairs, cut_shown = 8 * np.searchsorted(either, stops, "right"), np.cumsum(n_a + n_b)
        p0 = s0 = 0
        for x, p, s in zip(n_a.tolist(), cut_pairs.tolist(), cut_shown.tolist()):
            yield x, b"".join(shown[s0:s]), raw[p0:p]
            p0, s0 = p, s

    def texts(self, texts: list[str]) -> Iterator[tuple | None]:
        """(n_a, n_b, n_groups, n_links, groups, pairs) of whole texts; the
        listing ``groups`` ends in a semicolon."""
        cut = [self.parts(t) for t in texts]
        self.known.fill(set(chain.from_iterable(cut)), self.align)
        for parts in cut:
            found = list(map(self.known.__getitem__, parts))
            if None in found:
                yield None
                continue
            counts, groups, pairs = zip(*found)
            n_a, groups, pairs = sum(counts), b"".join(groups), b"".join(pairs)
            n_groups, n_links = groups.count(b";"), len(pairs) // 8
            # every end of either sequence closes one link, every common end one group
            yield n_a, n_links + n_groups - n_a, n_groups, n_links, groups, pairs
        self.known.rest()
        self.tails.rest()


@cache
def _aligner(byte_file: str, piece_file: str) -> Aligner:
    """One per Python worker, so that it remembers from task to task."""
    return Aligner(byte_file, piece_file)


def _texts(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """One row per distinct text: copies, measures, distinct pairs and how often each."""
    def run(batches: Iterator[pa.RecordBatch]):
        aligner = _aligner(byte_file, piece_file)
        for b in weighed(batches, 1):
            rows = []
            for found in aligner.texts(b.column(1).to_pylist()):
                if found is None:
                    rows.append((0, 0, 0, 0, "", [], []))
                else:
                    *numbers, groups, pairs = found
                    ids, times = np.unique(np.frombuffer(pairs, np.int64), return_counts=True)
                    rows.append((*numbers, hashlib.sha256(groups[:-1]).hexdigest(), ids, times))
            types = [*[pa.int64()] * 4, pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), *(pa.array(c, t) for c, t in zip(zip(*rows), types))],
                                             names=["text_id", "copies", "digest", *MEASURES, "groups_sha256", "pairs", "times"])

    texts = docs.filter("text <> ''").groupBy(F.col("text").cast("string").alias("text")).agg(F.count(F.lit(1)).alias("copies"))
    return texts.select(F.monotonically_increasing_id().alias("text_id"), "text", "copies", F.unhex(F.sha2("text", 256)).alias("digest")).mapInArrow(
        run, f"text_id long, copies long, digest binary, {', '.join(f'{m} long' for m in MEASURES)}, groups_sha256 string, "
             "pairs array<long>, times array<int>")


def _heavy(table: DataFrame, weight: str, bound: int) -> tuple[DataFrame, DataFrame]:
    """Rows above 1/bound of the whole weight (fewer than ``bound``), and the rest."""
    least = (table.agg(F.sum(weight)).first()[0] or 0) / bound
    return table.filter(F.col(weight) > least), table.filter(F.col(weight) <= least)


def pair_counts(texts: DataFrame, size_b: int) -> DataFrame:
    """(pair, a, count, best): documents that link the pair, and whether no pair
    of the same A id has more. The maxima are one row per A id at most."""
    counts = staged(texts.select("copies", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("copies").alias("count")), "pair-counts")
    counts = counts.withColumn("a", F.expr(f"pair div {size_b}"))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("pair", "a", "count", (F.col("count") == F.col("most")).alias("best"))


def align(docs: DataFrame, byte_file: str, piece_file: str) -> DataFrame:
    """Per row of ``docs``: doc_id, the measures, n_best, count_sum and groups_sha256."""
    import sentencepiece
    size_b = sentencepiece.SentencePieceProcessor(model_file=piece_file).get_piece_size()
    texts = staged(_texts(docs, byte_file, piece_file), "aligned-texts", **DENSE)
    counts = staged(pair_counts(texts, size_b).select("pair", "count", "best"), "pair-best")
    hot, cold = _heavy(counts, "count", HOT_PAIRS)
    linked = texts.select("text_id", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("text_id", F.col("l.pairs").alias("pair"), "l.times")
    sums = (F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    scored = linked.join(F.broadcast(hot), "pair").groupBy("text_id").agg(*sums)
    if not cold.isEmpty():
        rare = linked.join(F.broadcast(hot.select("pair")), "pair", "left_anti").join(cold, "pair").groupBy("text_id").agg(*sums)
        scored = scored.unionByName(rare).groupBy("text_id").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    names = [*MEASURES, "n_best", "count_sum", "groups_sha256"]
    measured = staged(texts.drop("pairs", "times").join(scored, "text_id", "left").select(
        "digest", "copies", F.struct(*(F.coalesce(c, F.lit("" if c == "groups_sha256" else 0)).alias(c) for c in names)).alias("m")), "aligned-measures")
    many, few = _heavy(measured, "copies", HOT_TEXTS)
    rows = docs.select("doc_id", F.when(F.col("text") != "", F.unhex(F.sha2("text", 256))).alias("digest"), F.monotonically_increasing_id().alias("row"))
    rows = rows.join(F.broadcast(many.select("digest", F.col("m").alias("hot"))), "digest", "left")
    # rows that need no partner any more are dealt evenly, not to one task
    key = F.when(F.col("hot").isNull() & F.col("digest").isNotNull(), F.col("digest")).otherwise(F.unhex(F.hex("row")))
    rows = rows.select("doc_id", "hot", key.alias("digest")).join(few.select("digest", "m"), "digest", "left")
    m = F.coalesce("hot", "m")
    return rows.select("doc_id", *(F.coalesce(m[c], F.lit("" if c == "groups_sha256" else 0)).alias(c) for c in names))
