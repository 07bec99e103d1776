"""Length-delimited binary records with an offset index (operator 13).

A record file is a sequence of frames: the payload's length (8 bytes), the
masked CRC-32C of that length (4), the payload, and the masked CRC-32C of the
payload (4), all little-endian, so any reader of this public framing can walk
it. A payload is one document: a byte of flags (element width, null id), the
id (8 bytes) and its token ids with 2 bytes each where the vocabulary allows
it, else 4.

``write`` deals documents by ranges of (id, text digest, row), so files follow
each other in ascending id order and neither a repeated id nor a repeated row
makes a range large; every task encodes its range and rolls files of about
``ROLL`` bytes. The index (id, part, shard, file, offset, size) is a Parquet
table beside the files and the only list of them: what a failed or repeated
attempt wrote is never referred to. ``read`` takes any rows of the index, in
any order, checks both checksums of each frame and gives the ids back.

Files are opened through ``pyarrow.fs``, by the folder's own URI.

Defined results: a null or empty text is a record with the end id alone; a
null doc_id sorts first and is kept as null; rows of one id follow each other
by the digest of the text, equal rows in any order; texts are encoded whole;
other columns of the input are ignored; an empty table gives an empty index
and no file. A damaged frame raises ValueError with its file and offset.
"""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterator
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tvpulse.functions.ranking import cumulative_before
from tvpulse.llm.common import shared_folder, staged, weighed
from tvpulse.llm.recent import Recent, byte_level

#: Bytes after which a task starts a new file.
ROLL = 64 << 20
#: Bytes that a reader fetches at a time.
FETCH = 4 << 20
INDEX = "doc_id long, part int, shard int, file string, offset long, size long"
_POLYNOMIAL = 0x82F63B78  # CRC-32C (Castagnoli), reflected
_MASK = 0xA282EAD8
_WIDTH = 64
_HEAD, _PAYLOAD = struct.Struct("<QI"), struct.Struct("<Bq")


def _byte_step() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1)
    return table


class Crc32c:
    """CRC-32C of many buffers at once.

    The checksum is linear, so the 64 bytes of a row are looked up by place and
    combined, and neighbouring rows are combined in a tree."""

    def __init__(self):
        step = _byte_step()
        self.advance = [np.stack([step if k == 0 else np.arange(256, dtype=np.uint32) << (8 * k - 8) for k in range(4)])]
        rows = [step]
        for _ in range(_WIDTH - 1):
            rows.append(self._zeros(rows[-1], 0))
        self.places = np.stack(rows[::-1]).ravel()
        self.columns = np.arange(_WIDTH) * 256

    def _zeros(self, crc: np.ndarray, power: int) -> np.ndarray:
        """The state after 2 ** power zero bytes."""
        while len(self.advance) <= power:
            last, unit = len(self.advance) - 1, np.arange(256, dtype=np.uint32)
            self.advance.append(np.stack([self._zeros(self._zeros(unit << (8 * k), last), last) for k in range(4)]))
        t = self.advance[power]
        return t[0][crc & 255] ^ t[1][crc >> 8 & 255] ^ t[2][crc >> 16 & 255] ^ t[3][crc >> 24]

    def __call__(self, buffers: list[bytes]) -> np.ndarray:
        sizes = np.fromiter(map(len, buffers), np.int64, len(buffers))
        counts = np.maximum(-(-sizes // _WIDTH), 1)
        ends = np.cumsum(counts * _WIDTH)
        flat = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
        for buffer, size, end in zip(buffers, sizes.tolist(), ends.tolist()):
            flat[end - size:end] = np.frombuffer(buffer, np.uint8)  # leading zeros change nothing
        rows = flat.reshape(-1, _WIDTH)
        crc = np.concatenate([np.zeros(0, np.uint32), *(
            np.bitwise_xor.reduce(self.places[rows[i:i + 4096] + self.columns], axis=1) for i in range(0, len(rows), 4096))])
        power = _WIDTH.bit_length() - 1
        while len(crc) > len(buffers):
            odd = counts & 1
            starts = np.cumsum(counts + odd) - counts - odd
            even = np.zeros(int((counts + odd).sum()), np.uint32)
            real = np.ones(len(even), bool)
            real[starts[odd == 1]] = False
            even[real] = crc
            crc, counts, power = self._zeros(even[0::2], power) ^ even[1::2], (counts + odd) // 2, power + 1
        state = np.full(len(buffers), 0xFFFFFFFF, np.uint32)
        for bit in range(int(sizes.max(initial=0)).bit_length()):
            state = np.where(sizes >> bit & 1, self._zeros(state, bit), state)
        return crc ^ state ^ np.uint32(0xFFFFFFFF)

    def masked(self, buffers: list[bytes]) -> np.ndarray:
        crc = self(buffers)
        return (crc >> 15 | crc << 17) + np.uint32(_MASK)


class WordEncoder:
    """Ids by the tokenizers library for vocabularies whose pre-tokens hold no
    white space: words that the library would treat alone are encoded once and
    remembered.

    A plain text (no combining marks, no special token's string in whatever
    case) is lower-cased as a whole if the tokenizer does that itself, and cut
    at white space and before a full stop or comma that ends a word. A plain
    word without apostrophe (contractions) is the sequence of its runs of
    letters and of others; a run of letters is one pre-token, unchanged by
    normalisation, and goes straight to the library's model. Everything else
    goes through the whole tokenizer."""

    #: Letters, digits and marks that stand alone under NFC and lower-case to one
    #: character each; white space among them is ASCII only.
    PLAIN = re.compile("[\t-\r\x20-\x7e¡-įĲ-ňŊ-ž‐-‧‰-⁞]*")
    #: A stop or comma after a mark belongs to a run of marks.
    ODD = re.compile(r"[.,](?<=[\W_].)[ \n]")
    RUNS = re.compile(r"[^\W\d_²³¹¼-¾]+|(?:[\W\d_]|[²³¹¼-¾])+")

    def __init__(self, file: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(file)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added)) or r"\Z.", re.IGNORECASE).search
        self.opening = sorted({c for t in added for c in (t[0].lower(), t[0].upper())})
        try:
            lowers = self.tokenizer.normalizer.normalize_str("AZ") == "az"
        except AttributeError:
            lowers = False
        self.fold = str.lower if lowers else str
        self.words = re.compile(r"[^\x20\x09-\x0D]+").findall
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.plain, self.whole = Recent(self.make_plain), Recent(self.make, limit=16 << 20)

    def make(self, word: str) -> bytes:
        return self.pack(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def make_plain(self, word: str) -> bytes:
        runs = [word] if "'" in word else self.RUNS.findall(word)
        if len(runs) > 1:
            return b"".join(map(self.plain.__getitem__, runs))
        if word.isalpha():
            return self.pack([t.id for t in self.tokenizer.model.tokenize(byte_level(word))])
        return self.make(word)

    def pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.width == 2 else 'I'}", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text."""
        out = []
        for text in texts:
            if any(c in text for c in self.opening) and self.special(text):
                out.append(self.make(text))
            elif not self.PLAIN.fullmatch(text):
                out.append(b"".join(map(self.whole.__getitem__, self.words(text))))
            else:
                text = self.fold(text)
                if not self.ODD.search(text):
                    text = text.replace(". ", " . ").replace(", ", " , ").replace(".\n", " .\n")
                out.append(b"".join(map(self.plain.__getitem__, text.split())))
        self.plain.rest()
        self.whole.rest()
        return out


@cache
def _encoder(file: str) -> WordEncoder:
    """One per Python worker, so that it remembers from task to task."""
    return WordEncoder(file)


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", folder))


@cache
def _encoder(file: str) -> WordEncoder:
    """One per Python worker, so that it remembers from task to task."""
    return WordEncoder(file)


def _write_part(batches: Iterator[pa.RecordBatch], file: str, end: int, folder: str) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(file)
    crc, part, shard, out, at = Crc32c(), TaskContext.get().partitionId(), -1, None, ROLL
    target, base = _place(f"{folder}/data")
    closing = np.array([end], encoder.kind).tobytes()
    try:
        for b in weighed(batches, 1):
            ids = b.column(0).to_pylist()
            payloads = [_PAYLOAD.pack(encoder.width | (d is None) << 7, d or 0) + packed + closing
                        for d, packed in zip(ids, encoder.encode([t or "" for t in b.column(1).to_pylist()]))]
            sizes = np.fromiter(map(len, payloads), "<u8", len(payloads))
            lengths = [x.tobytes() for x in sizes]
            rows = []
            for d, n, p, a, c in zip(ids, sizes.tolist(), payloads, crc.masked(lengths).tolist(), crc.masked(payloads).tolist()):
                if at >= ROLL:
                    if out:
                        out.close()
                    shard, at = shard + 1, 0
                    name = f"part-{part:06d}-{shard:05d}-{uuid.uuid4().hex}.rec"
                    target.create_dir(base, recursive=True)
                    out = target.open_output_stream(f"{base}/{name}")
                out.write(_HEAD.pack(n, a) + p + struct.pack("<I", c))
                rows.append((d, part, shard, name, at, n))
                at += n + _HEAD.size + 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                names=["doc_id", "part", "shard", "file", "offset", "size"])
    finally:
        if out:
            out.close()


def write(docs: DataFrame, file: str, end: int, folder: str | None = None) -> DataFrame:
    """Write ``docs`` as record files and return their offset index.

    ``file`` is the tokenizer's; ``end`` closes every document. ``folder`` is a
    new folder that all executors share, by default one under the session's
    ``spark.checkpoint.dir``; data is in ``data``, the index in ``index``."""
    spark = docs.sparkSession
    folder = folder or shared_folder(spark, "records")

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.md5("text").alias("digest"), F.monotonically_increasing_id().alias("row"))
    order = ["doc_id", "digest", "row"]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    ranged.mapInArrow(lambda batches: _write_part(batches, file, end, folder), INDEX).write.parquet(f"{folder}/index")
    return opened(spark, folder)


def opened(spark: SparkSession, folder: str) -> DataFrame:
    """The index of a written folder; ``file`` becomes the whole path."""
    return spark.read.schema(INDEX).parquet(f"{folder}/index").withColumn("file", F.concat(F.lit(f"{folder}/data/"), "file"))


def _check(good: np.ndarray, what: str, files: list[str], offsets: list[int]) -> None:
    if not good.all():
        at = int(np.flatnonzero(~good)[0])
        raise ValueError(f"damaged {what} in {files[at]} at offset {offsets[at]}")


def _frames(source: fs.FileSystem, path: str, offsets: list[int], sizes: list[int]) -> Iterator[bytes]:
    """The frames at ``offsets``; neighbours are fetched in one piece."""
    with source.open_input_file(path) as f:
        i = 0
        while i < len(offsets):
            j, stop = i, offsets[i]
            while j < len(offsets) and offsets[j] == stop and (j == i or stop - offsets[i] < FETCH):
                stop, j = stop + sizes[j] + _HEAD.size + 4, j + 1
            held = f.read_at(stop - offsets[i], offsets[i])
            for k in range(i, j):
                yield held[offsets[k] - offsets[i]:offsets[k] - offsets[i] + sizes[k] + _HEAD.size + 4]
            i = j


def _read_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    crc = Crc32c()
    for batch in batches:
        cuts, held = [0], 0
        for i, n in enumerate(batch.column(4).to_pylist()):
            if held + n > FETCH and i > cuts[-1]:
                cuts.append(i)
                held = 0
            held += n
        for lo, hi in pairwise([*cuts, batch.num_rows]):
            b = batch.slice(lo, hi - lo)
            files, offsets, sizes = (b.column(k).to_pylist() for k in (2, 3, 4))
            change = [k for k in range(len(files)) if k == 0 or files[k] != files[k - 1]]
            frames = []
            for i, j in pairwise([*change, len(files)]):
                frames += _frames(*_place(files[i]), offsets[i:j], sizes[i:j])
            _check(np.array([len(f) == n + _HEAD.size + 4 for f, n in zip(frames, sizes)], bool), "end", files, offsets)
            heads = [_HEAD.unpack_from(f) for f in frames]
            _check(np.array([h[1] for h in heads]) == crc.masked([f[:8] for f in frames]), "length", files, offsets)
            _check(np.array([h[0] for h in heads]) == np.array(sizes), "length", files, offsets)
            payloads = [f[_HEAD.size:-4] for f in frames]
            _check(np.array([struct.unpack_from("<I", f, len(f) - 4)[0] for f in frames]) == crc.masked(payloads), "payload", files, offsets)
            keys = [_PAYLOAD.unpack_from(p) for p in payloads]
            ids = [np.frombuffer(p, f"<u{flags & 7}", offset=_PAYLOAD.size).astype("<u4").tobytes() for (flags, _), p in zip(keys, payloads)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([None if flags >> 7 else d for flags, d in keys], pa.int64()), b.column(0), b.column(1), b.column(3),
                 pa.array(ids, pa.binary())], names=["doc_id", "part", "shard", "offset", "ids"])


def read(index: DataFrame, seed: int | None = None) -> DataFrame:
    """(doc_id, part, shard, offset, ids) of the indexed records; ``ids`` is
    binary, four little-endian bytes an id.

    In file order, or, with a ``seed``, in a pseudo-random order that is the
    same for the same seed and partition count."""
    files = max(1, index.select("part", "shard").distinct().count())
    rows = index.select("part", "shard", "file", "offset", "size")
    if seed is None:
        dealt = rows.repartition(files, "part", "shard").sortWithinPartitions("part", "shard", "offset")
    else:
        lot = F.xxhash64(F.lit(seed), "part", "shard", "offset")
        dealt = rows.repartition(files, lot).sortWithinPartitions(lot)
    return dealt.mapInArrow(_read_part, "doc_id long, part int, shard int, offset long, ids binary")


def positions(counted: DataFrame) -> DataFrame:
    """Add ``start``, the sum of ``n_tokens`` of all records before each.

    Totals of the parts are summed up first, then each part's own records, so
    the rows (part, shard, offset, n_tokens, ...) are written once and read twice."""
    return cumulative_before(staged(counted, "record-counts"), [], ["shard", "offset"], F.col("part"), F.col("n_tokens"), "start")
