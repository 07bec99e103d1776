"""Record files: checksums, the library's own ids, round trip, order, damage, edges."""

import os
import random
import struct
import zlib

import numpy as np
import pytest

from tvpulse.llm import queries, records
from tvpulse.llm.common import read, shared_folder

SF = "/root/testdata/sf0.001"
public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def file():
    return public.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library(file):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(file)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def bitwise(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = crc >> 1 ^ 0x82F63B78 * (crc & 1)
    return crc ^ 0xFFFFFFFF


def test_crc32c_equals_the_definition():
    crc, rng = records.Crc32c(), np.random.default_rng(3)
    sizes = [0, 1, 8, 63, 64, 65, 127, 128, 129, 191, 1000, 4097, 0, 70]
    buffers = [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in sizes] + [b"123456789", b"\0" * 300]
    assert crc(buffers).tolist() == [bitwise(b) for b in buffers]
    assert crc([b"123456789"]).tolist() == [0xE3069283] and crc([]).tolist() == []


def test_parts_encode_as_the_whole_text(spark, file, library):
    encoder, rng = records.WordEncoder(file), random.Random(5)
    atoms = ["don't", "DON'T", "we'll", "'s", "x's.", "a,b", "Ünï", "ßÉ", "H̱h", "é", "́", "12", "½", "\x1c", "\x1f'", "<|endoftext|>",
             "<|EndOfText|>", "<|", "|>", "İI", "ΣΑΣ", "K", "…", "—", "漢字かな", "👩‍👩‍👧", "'", "''s", "(", ")'re", "œuvre.", "fin. ", "a.. ", "x, y", "½. ", "'. ", "_. ", "“q.” ", "q.”", "ſ", "ŉ", "ı", "Ÿ", "\u2028", "\u2029", "†", "É.", "5, ", ",\n", ".\n", "ŒÆ", "ÅÅ", " ", "　", "​", "\x85", "the", "The"]
    texts = ["".join(rng.choice(atoms) + rng.choice(["", "", " ", "  ", "\n", "\t", "\r\n"]) for _ in range(rng.randrange(1, 30))) for _ in range(3000)]
    texts += [r["text"] or "" for r in read(spark, SF, "documents").collect()]
    got = encoder.encode(texts)
    for text, packed in zip(texts, got):
        assert np.frombuffer(packed, encoder.kind).tolist() == library(text), text


def test_query_equals_the_library(spark, library):
    docs = sorted((r["doc_id"], r["text"]) for r in read(spark, SF, "documents").collect())
    got = {r["doc_id"]: r for r in queries.QUERIES["op13_token_records"](spark, SF).collect()}
    start = 0
    assert len(got) == len(docs)
    for d, text in docs:
        ids = library(text) + [2]
        assert tuple(got[d])[1:] == (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)


def test_files_follow_the_public_framing(spark, file, library):
    folder = shared_folder(spark, "records-test").replace("file:", "")
    docs = read(spark, SF, "documents")
    index = records.write(docs, file, 2, folder).collect()
    mask = lambda data: (((c := bitwise(data)) >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    listed, order = {}, []
    for r in sorted(index, key=lambda r: (r["part"], r["shard"], r["offset"])):
        listed.setdefault(r["file"], []).append(r)
        order.append(r["doc_id"])
    assert order == sorted(order)
    for path, rows in listed.items():
        data, at = open(path.replace("file:", ""), "rb").read(), 0
        for r in rows[:20]:
            n, = struct.unpack_from("<Q", data, at)
            payload = data[at + 12:at + 12 + n]
            assert (at, n) == (r["offset"], r["size"])
            assert struct.unpack_from("<I", data, at + 8)[0] == mask(data[at:at + 8])
            assert struct.unpack_from("<I", data, at + 12 + n)[0] == mask(payload)
            flags, d = struct.unpack_from("<Bq", payload)
            assert flags == 2 and d == r["doc_id"]
            assert np.frombuffer(payload, "<u2", offset=9).tolist() == library(texts[d]) + [2]
            at += n + 16


def test_shuffled_and_partial_reads(spark, file):
    index = records.write(read(spark, SF, "documents"), file, 2)
    whole = {r["doc_id"]: r["ids"] for r in records.read(index).collect()}
    one, two, other = ([r["doc_id"] for r in records.read(index, seed=s).collect()] for s in (1, 1, 2))
    assert one == two != other and sorted(one) == sorted(whole) == sorted(other)
    assert {r["doc_id"]: r["ids"] for r in records.read(index.filter("doc_id % 7 = 3"), seed=1).collect()} == \
        {d: ids for d, ids in whole.items() if d % 7 == 3}


@pytest.mark.parametrize("shift", [3, 10, 14, 200, -2])
def test_damage_is_found(spark, file, shift):
    folder = shared_folder(spark, "records-damage").replace("file:", "")
    index = records.write(spark.createDataFrame([(1, "one two three " * 50), (2, "four")], "doc_id long, text string").coalesce(1), file, 2, folder)
    path = index.filter("doc_id = 1").first()["file"]
    size = os.path.getsize(path)
    with open(path, "r+b") as f:
        f.seek(shift % size)
        byte = f.read(1)
        f.seek(shift % size)
        f.write(bytes([byte[0] ^ 1]))
    with pytest.raises(Exception, match="damaged"):
        records.read(index).collect()


def test_edges(spark, file, library):
    long = "loooong " * 30_000 + "x" * 5000
    rows = [(3, "b"), (1, None), (2, ""), (None, "no id"), (3, "a"), (3, "a"), (3, None), (-4, " \t\n"), (5, long)]
    docs = spark.createDataFrame([(*r, 1, 2, "f") for r in rows], "doc_id long, text string, part int, offset int, file string")
    index = records.write(docs, file, 2)
    found = records.read(index).selectExpr("doc_id", "part", "shard", "offset", "ids", "octet_length(ids) div 4 AS n_tokens")
    got = sorted(records.positions(found).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, -4, 1, 2, 3, 3, 3, 3, 5]
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()
    ids = sorted((r["doc_id"] or 0, np.frombuffer(r["ids"], "<u4").tolist()) for r in got)
    assert ids == sorted((d or 0, library(t) + [2]) for d, t in rows)
    empty = records.write(docs.limit(0), file, 2)
    assert empty.count() == 0 and records.read(empty).count() == 0
