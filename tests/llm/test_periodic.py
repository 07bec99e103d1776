"""Periodic runs against brute force, on planted and random words, and edges."""

import hashlib
import random

import numpy as np
import pytest

from tvpulse.llm import periodic, queries
from tvpulse.llm.common import read

SF = "/root/testdata/sf0.001"


def brute(words, least=6, power=4):
    n, found = len(words), {}
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, power * q):
                found.setdefault((i, j + q), q)  # the smallest period comes first
            i = j + 1
    return sorted((s, q, e - s) for (s, e), q in found.items())


def kept(words, runs):
    gone = {i for s, q, m in runs for i in range(s + q, s + m)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def made(seed):
    r = random.Random(seed)
    words = [r.choice("abcdefgh") for _ in range(r.randrange(0, 60))]
    for _ in range(r.randrange(0, 4)):
        root = [r.choice("ab") for _ in range(r.choice([1, 1, 2, 3, 5, 7, 8, 16, 31, 33, 64]))]
        stretch = root * r.randrange(2, 9)
        words += stretch[:len(stretch) - r.randrange(0, len(root))] + [r.choice("abcx") for _ in range(r.randrange(0, 9))]
    return " ".join(words)


@pytest.mark.parametrize("tile", [periodic.TILE, 8])
def test_runs_equal_brute_force(spark, tile, monkeypatch):
    monkeypatch.setattr(periodic, "TILE", tile)
    rows = [(i, made(i)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    # tiles are cut and joined in this process too, where the small span holds
    for d, text in rows:
        numbers = {}
        codes = [numbers.setdefault(w, len(numbers)) for w in text.split()]
        parts = {}
        for _, octave, low, high, bounds in periodic.candidates([np.array(codes, np.int64)]):
            for p, s, e in periodic.solve(octave, low, codes[low:high], bounds.tolist()):
                parts.setdefault(p, []).append([s, e])
        runs = []
        for p, spans in parts.items():
            joined = []
            for s, e in sorted(spans):
                if joined and joined[-1][1] - s >= p:
                    joined[-1][1] = max(joined[-1][1], e)
                else:
                    joined.append([s, e])
            runs += [(s, p, e - s) for s, e in joined if e - s >= max(6, 4 * p)]
        assert sorted(runs) == brute(codes), text
    if tile == periodic.TILE:
        for r in periodic.collapse(docs, texts=True).collect():
            words = rows[r["doc_id"]][1].encode().split()
            want = brute(words)
            assert [tuple(x) for x in r["runs"]] == want
            assert r["text"].encode() == kept(words, want)
            assert r["collapsed_sha256"] == hashlib.sha256(kept(words, want)).hexdigest()


def test_fragments_of_a_long_run_are_stitched(spark):
    """One run over many tiles, a run of one word, and a power of a shorter root."""
    block = [f"w{i}" for i in range(700)]
    texts = [" ".join(["a", "b"] + block * 40 + ["c"]), "x " * 50_000, " ".join((["p", "q"] * 3 + ["r"]) * 2000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in periodic.collapse(docs).collect()}
    assert got[0] == [(2, 700, 28_000)] and got[1] == [(0, 1, 50_000)]
    assert got[2] == [(0, 7, 14_000)]


def test_query_equals_brute_force(spark):
    docs = {r["doc_id"]: r["text"] for r in read(spark, SF, "documents").collect()}
    rows = queries.QUERIES["op12_periodic_runs"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    hits = 0
    for r in rows:
        words = queries._with_period(r["doc_id"], (docs[r["doc_id"]] or "").encode().split())
        numbers = {}
        want = brute([numbers.setdefault(w, len(numbers)) for w in words])
        hits += len(want)
        listing = "".join(f"{s},{m},{q}\n" for s, q, m in want)
        s, q, m = max(want, key=lambda x: (x[2], -x[0], -x[1])) if want else (None, None, None)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(want), s, m, q)
        assert r["exponent_milli"] == (1000 * m // q if want else None)
        assert r["runs_sha256"] == hashlib.sha256(listing.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(kept(words, want)).hexdigest()
    assert hits > 3


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n "), (None, "a b a b a b a b"), (5, "a b"), (5, "a a a a a a"), (5, "a a a a a a"),
            (6, "a a a a a"), (7, "ü ü\tü\nü ü ü")]
    docs = spark.createDataFrame([(*r, "k", "w", 1, 2) for r in rows],
                                 "doc_id long, text string, runs string, words string, row int, period int")
    got = sorted((r["doc_id"] or 0, [tuple(x) for x in r["runs"]], r["text"]) for r in periodic.collapse(docs, texts=True).collect())
    assert got == sorted([(1, [], ""), (2, [], ""), (3, [], ""), (0, [(0, 2, 8)], "a b"), (5, [], "a b"), (5, [(0, 1, 6)], "a"),
                          (5, [(0, 1, 6)], "a"), (6, [], "a a a a a"), (7, [(0, 1, 6)], "ü")])
    assert periodic.collapse(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.collapse(docs, power=2)
