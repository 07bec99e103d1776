"""Operators of the training-data subpackage: brute force, round trips, edges."""

import hashlib
import html
import pickle
import re

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tvpulse.llm import (byte_bpe, decontaminate, html_blocks, langid, line_spread, multi_index, queries, secrets, simhash,
                         suffix_dedup, toxicity)
from tvpulse.llm.common import read, shared_folder
from tvpulse.llm.components import components

SF = "/root/testdata/sf0.001"
#: Null and empty texts, a tie, a repeated row, a null id, a very long text, and columns of clashing names.
EDGES = [(1, "Der the idiot %s is here now, you." % ("word " * 40), "en", "s1"), (2, None, None, None), (3, "", "en", "s1"),
         (None, "the text without an id " * 5, "en", "s2"), (5, "the same old text, ünï ☂ " * 9, "de", "s1"),
         (5, "the same old text, ünï ☂ " * 9, "de", "s1"), (6, "the same old text, ünï ☂ " * 9, "fr", None),
         (7, "loooong " * 30000 + "password = hunter2hunter2", "en", "s3"), (8, " \t\n ", "es", "s1"), (9, "12 34", "es", "s1")]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, key string, spans string, "
          "fp string, w string, pos string, doc string")


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(*r, len(r[1] or ""), None, "k", "s", "f", "w", "p", "d") for r in EDGES], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "the same old text"), (2, None), (3, ""), (None, "loooong loooong"), (4, " ".join("abc") * 9)],
                                 "item_id long, text string")


@pytest.fixture(scope="module")
def docs():
    return duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def removed_by_brute_force(docs, length=50):
    first, out = {}, {}
    for d, text in sorted((d, (t or "").encode()) for d, t in docs):
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if first.setdefault(text[i:i + length], d) < d:
                gone[i:i + length] = b"\1" * length
        kept = bytes(a for a, g in zip(text, gone) if not g)
        out[d] = (len(text), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 3])
def test_suffix_dedup_equals_brute_force(spark, docs, hot):
    got = by_id(suffix_dedup.remove_repeats(read(spark, SF, "documents"), hot))
    want = removed_by_brute_force(docs)
    assert {d: tuple(r)[1:] for d, r in got.items()} == want
    assert sum(w[1] for w in want.values())


def test_suffix_dedup_edges(edges, empty):
    rows = suffix_dedup.remove_repeats(edges).collect()
    assert len(rows) == len(EDGES) and suffix_dedup.remove_repeats(empty).count() == 0
    for r in rows:
        assert (r["n_removed"] > 0) == (r["doc_id"] == 6)
    six = next(r for r in rows if r["doc_id"] == 6)
    assert (six["n_removed"], six["n_spans"]) == (six["n_bytes"], 1)


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 1])
def test_suffix_dedup_of_an_id_with_several_texts(spark, hot):
    rng = np.random.default_rng(7)

    def noise(n):
        return "".join(map(chr, rng.integers(97, 123, n)))
    w, u = noise(80), noise(200)
    rows = [(1, "0" + noise(90) + "1" + w + "2" + noise(90)), (2, "3" + noise(40) + "4" + w + "5" + noise(60)), (2, noise(300)), (2, None),
            (2, noise(10) + "6" + w + "7"), (3, "8" + u), (3, "9" + u), (3, ""), (4, noise(70) + "0" + u + "1" + noise(70))]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), hot).collect()
    want = [(d, len(t or ""), 80 if d == 2 and w in (t or "") else 200 if d == 4 else 0,
             hashlib.sha256((t or "").replace(w, "" if d == 2 else w).replace(u, "" if d == 4 else u).encode()).hexdigest()) for d, t in rows]
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in got) == sorted(want)


def test_near_duplicates_judge_every_text_of_an_id(spark):
    import corpus_pipeline as P
    rng = np.random.default_rng(8)
    a, b, c = (" ".join(f"w{i}" for i in rng.integers(0, 10_000, 300)) for _ in range(3))
    rows = [(3, a), (7, a), (7, b), (7, b), (7, c), (7, c.upper()), (9, b), (8, None), (8, a)]
    for n in (1, 4):
        docs = spark.createDataFrame(rows if n > 1 else rows[::-1], "doc_id long, text string").repartition(n)
        got = P.drop_near_duplicates(spark, docs, SF).collect()
        kept = sorted((r["doc_id"], (r["text"] or "").lower()) for r in got)
        assert kept == sorted([(3, a), (7, b), (7, c), (8, "")])
        assert n == 1 or {r["text"] for r in got} == first
        first = {r["text"] for r in got}


def test_merged_transforms_find_every_repeat():
    rng = np.random.default_rng(1)
    base = bytes(rng.integers(97, 100, 3000, dtype=np.uint8))
    strings = [base[i:i + 80] for i in rng.integers(0, 2900, 300)]
    docs, starts = rng.integers(0, 40, 300), np.zeros(300, np.int64)
    old = suffix_dedup.SHARD
    suffix_dedup.SHARD = 2000
    try:
        got = {tuple(x) for x in suffix_dedup.repeated(docs, np.arange(300) * 1000, strings).tolist()}
    finally:
        suffix_dedup.SHARD = old
    least = {}
    for d, s in zip(docs.tolist(), strings):
        for i in range(31):
            least[s[i:i + 50]] = min(d, least.get(s[i:i + 50], d))
    want = {(d, k * 1000 + i, k * 1000 + i + 50) for k, (d, s) in enumerate(zip(docs.tolist(), strings))
            for i in range(31) if least[s[i:i + 50]] < d}
    assert got == want and starts is not None


def test_bpe_equals_tiktoken(spark, docs, edges, empty):
    tiktoken, tokenizers = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    bpe = queries.public_bpe()
    own = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    got = by_id(byte_bpe.encode(read(spark, SF, "documents"), bpe))
    assert all(got[d]["ids"] == own.encode_ordinary(t) for d, t in docs)
    for r, (_, t, *_) in zip(byte_bpe.decode(byte_bpe.encode(edges, bpe), bpe).collect(), EDGES):
        assert bytes(r["bytes"]) == (t or "").encode() and r["ids"] == own.encode_ordinary(t or "")
    assert byte_bpe.round_trip(empty, bpe).count() == 0
    assert sorted(bpe.hash.slots(list(bpe.ranks)).tolist()) == list(range(len(bpe.ranks)))


def test_bpe_forgets_and_remembers(monkeypatch, docs):
    tiktoken, tokenizers = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    bpe = pickle.loads(pickle.dumps(queries.public_bpe()))
    own = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    monkeypatch.setattr(byte_bpe, "REMEMBER", 100)
    asked = []
    learn = bpe.learn
    bpe.learn = lambda pieces: (asked.extend(pieces), learn(pieces))
    texts = ["the first words", "w" + " x".join(map(str, range(200))), "the first words", "the first words"]
    for text in texts:
        assert bpe.encode([text]) == [own.encode_ordinary(text)]
    assert asked.count(" first") == 1 and " first" in bpe.known and " first" in bpe.older  # carried over, not merged again
    for _, text in docs:
        assert bpe.encode([text or ""]) == [own.encode_ordinary(text or "")]


def test_simhash_equals_brute_force(spark, docs, edges, empty):
    got = by_id(simhash.near_duplicates(read(spark, SF, "documents")))
    want = {}
    for d, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        shingles = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
        want[d] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert {d: r["fingerprint"] for d, r in got.items()} == {d: f"{f:016x}" for d, f in want.items()}
    root = {d: d for d in want}
    for _ in range(10):
        for a, fa in want.items():
            for b, fb in want.items():
                if (fa ^ fb).bit_count() <= 4:
                    root[a] = min(root[a], root[b])
    assert {d: r["component_id"] for d, r in got.items()} == root
    rows = simhash.near_duplicates(edges).collect()
    assert len(rows) == len(EDGES) and simhash.near_duplicates(empty).count() == 0
    assert {r["component_id"] for r in rows if r["doc_id"] in (2, 3, 8)} == {2}
    assert {r["component_id"] for r in rows if r["doc_id"] in (5, 6)} == {5}


def test_large_bucket_links_connect_what_pairs_connect():
    rng = np.random.default_rng(2)
    fps = np.unique(np.uint64(1 << 40) ^ (np.uint64(1) << rng.integers(0, 64, (600, 3)).astype(np.uint64)).sum(axis=1, dtype=np.uint64))
    links = simhash.bucket_links(fps, np.zeros(len(fps), np.int64), 4)
    assert len(links) < len(fps)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    label = np.arange(len(fps))
    for _ in range(len(fps)):
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            break
        label = new
    parent = {int(f): int(f) for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        parent[find(a)] = find(b)
    assert len({find(int(f)) for f in fps}) == len(set(label.tolist()))


def test_components_of_a_chain(spark):
    got = components(spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99)], "a long, b long"))
    assert {(r["node"], r["root"]) for r in got.collect()} == {(i, 0) for i in range(41)} | {(99, 99), (100, 99)}


def test_decontamination_edges(edges, empty, bench):
    for rows in (decontaminate.BROADCAST_ROWS, 0):  # broadcast prefix, and the way beyond the bound
        got = [r for r in decontaminate.contamination(edges, bench, broadcast_rows=rows).collect()]
        assert len(got) == len(EDGES)
        for r in got:
            same = r["doc"]["doc_id"] in (5, 6)
            assert r["items"] == (["1"] if same else []) and (r["n_hit"] == 36) == same and r["contaminated"] == same
            assert r["n_words"] > 0 or not (r["doc"]["text"] or "").strip()
    assert decontaminate.contamination(empty, bench).count() == 0
    assert not decontaminate.contamination(edges, bench.limit(0)).filter("contaminated").count()


def test_line_spread_edges(spark, edges, empty):
    line = "a line that every site shows, always"
    rows = [(i, f"{line}\nown line of the document number {i}", f"s{i}") for i in range(12)] + [
        (None, line, "s1"), (20, None, "s2"), (21, "short\nshort", None), (22, line, None)]
    got = line_spread.remove_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == len(rows)
    for r in got:
        d = r["doc"]["doc_id"]
        assert r["n_removed"] == int(d is None or 0 < d < 12 or d == 22)
    assert line_spread.remove_boilerplate(edges).count() == len(EDGES) and line_spread.remove_boilerplate(empty).count() == 0


def test_ledger_scans_a_blob_once(spark, edges, empty):
    ledger = secrets.Ledger(spark, shared_folder(spark, "test-ledger"))
    blobs = len({t or "" for _, t, *_ in EDGES})
    assert secrets.update(edges, ledger, rules=secrets.BASE) == 3 * blobs
    assert secrets.update(edges, ledger, rules=secrets.BASE) == 0
    newer = secrets.BASE[:2] + (secrets.BASE[2]._replace(version=2),)
    assert secrets.update(edges, ledger, rules=newer) == blobs
    assert secrets.update(empty, ledger, rules=newer) == 0
    found = {r["doc"]["doc_id"]: r["spans"] for r in secrets.findings_of(edges, ledger, rules=newer).collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in found[7]] == [("assign", 240000, 240025)]
    assert not any(s for d, s in found.items() if d != 7)


def test_secret_positions_count_code_points(spark):
    text = "☂𝒳 token=abcdef1 " + "f" * 24 + " AKIA" + "A" * 15 + " AKIA" + "B" * 16 + ' secret=token:abcdef12 API_KEY" : "q+/=._-x'
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    ledger = secrets.Ledger(spark, shared_folder(spark, "test-ledger"))
    secrets.update(df, ledger)
    spans = secrets.findings_of(df, ledger).first()["spans"]
    assert [text[s["start"]:s["end"]] for s in spans] == ["token=abcdef1", "f" * 24, "AKIA" + "B" * 16, 'API_KEY" : "q+/=._-x']


def test_toxicity_learns_and_handles_edges(spark, edges, empty):
    docs, labels = read(spark, "/root/testdata/sf0.01", "documents"), read(spark, "/root/testdata/sf0.01", "labels")
    scored = toxicity.score(docs, toxicity.train(docs, labels)).select("doc.doc_id", "score")
    held = scored.join(labels, "doc_id").filter(toxicity.held_out()).collect()
    assert sum((r["score"] >= 0.5) == r["toxic"] for r in held) / len(held) >= 0.95
    untrained = toxicity.train(empty, labels.limit(0))
    assert toxicity.score(empty, untrained).count() == 0
    for r in toxicity.score(edges, untrained).collect():
        assert 0 <= r["score"] <= 1 and (r["score"] >= 0.5) == (r["doc"]["doc_id"] == 1)


def test_toxicity_grammar_reads_context():
    model = toxicity.ToxicityModel({"idiot": 2.0})
    plain, negated, reported, aimed = (float(model.score(model.features(t)[None])[0]) for t in (
        "What an idiot came in.", "He is not an idiot.".replace("He", "That"), "The paper said the idiot left.", "You are an idiot."))
    assert negated < plain and reported < plain < aimed


@pytest.mark.parametrize("mark", ["'", "’", "ʼ"])
def test_toxicity_reads_elided_words(mark):
    model = toxicity.ToxicityModel({"idiot": 2.0})

    def score(text):
        return float(model.score(model.features(text.replace("'", mark))[None])[0])

    assert score("C'est l'idiot.") == score("C'est le idiot.") >= 0.5
    assert score("Pas d'idiot ici.") == score("Pas de idiot ici.") < score("d'idiot") == score("idiot")
    assert score("You're an idiot.") == score("You an idiot.") > score("Here's an idiot.")
    assert score("That isn't an idiot.") == score("That never an idiot.") < score("That is an idiot.")
    assert score("It's the idiot's car.") == score("It the idiot car.")


def test_language_id(spark, edges, empty):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    model = langid.train(docs)
    got = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) >= 0.97
    for r in langid.predict(edges, model).collect():
        assert (r["lang_pred"] == "und") == (r["doc_id"] in (2, 3, 8, 9)) and 0 <= r["score"] <= 1
    assert langid.predict(edges, langid.train(empty)).filter("lang_pred <> 'und'").count() == 0


def test_language_id_learns_every_language(spark):
    words = [f"{a}{b}{c}" for a in "bdfglmnprs" for b in "aeiou" for c in "xyz"][:140]
    rows = [(i, f"{words[i % 70]} {words[70 + i % 70]} " * 3, f"q{i % 70:02d}") for i in range(700)] + [
        (701, f"{words[0]} {words[70]} " * 3, "q00")] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, per_language=4)
    assert len(model.langs) == 70
    got = langid.predict(docs, model).join(docs.distinct(), "doc_id").collect()
    assert all(r["lang"] == r["lang_pred"] for r in got) and len(got) == len(rows)
    assert langid.train(docs.filter("lang IS NULL")).langs == []


def test_multi_index(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 16)).astype(np.float32)
    x[300:420] = x[300]  # a hot cell of equal vectors: ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(None, x[0].tolist()), (900, None), (901, [0.0] * 16), (902, [float("nan")] * 16),
                                                         (903, [None] * 16), (904, [1.0]), (905, [])]
    vectors = multi_index.valid_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert vectors.count() == 600
    index, entries = multi_index.build(vectors)
    got = {}
    for r in multi_index.search(vectors.filter("vec_id % 20 = 0"), index, entries, share=1.0, chunk=50).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    x = x.astype(np.float64)
    for q in range(0, 600, 20):
        s = x @ x[q]
        want = [i for i in np.lexsort((np.arange(600), -np.round(s, 9))).tolist() if i != q][:20]
        assert np.allclose(np.sort(s[[got[q][k] for k in range(1, 21)]]), np.sort(s[want]))
    none = multi_index.valid_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    index, entries = multi_index.build(none)
    assert multi_index.search(none, index, entries).count() == 0


def test_multi_index_asks_a_repeated_query_once(spark):
    x = np.random.default_rng(5).normal(size=(60, 8)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    vectors = multi_index.valid_vectors(spark.createDataFrame(rows + [rows[20]] * 2, "vec_id long, embedding array<float>"))
    index, entries = multi_index.build(vectors)
    got = multi_index.search(vectors.filter("vec_id = 20"), index, entries, share=1.0).collect()
    s = x.astype(np.float64) @ x[20].astype(np.float64)
    want = [i for i in np.argsort(-s).tolist() if i != 20][:20]
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"])] == want


def test_multi_index_ties_and_scores_do_not_depend_on_batches(spark):
    """Equal vectors rank by id; a score is the same however the rows are dealt."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 24)).astype(np.float32)
    x[100:180] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found = set()
    for parts, chunk in ((1, 1 << 14), (5, 37)):
        vectors = multi_index.valid_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(parts))
        index, entries = multi_index.build(vectors)
        got = multi_index.search(vectors.filter("vec_id % 20 = 0"), index, entries, share=1.0, chunk=chunk).collect()
        found.add(tuple(sorted(map(tuple, got))))
    assert len(found) == 1
    x = x.astype(np.float64)
    for q in range(0, 400, 20):
        s = (x * x[q]).sum(axis=1)
        want = [i for i in np.lexsort((np.arange(400), -s)).tolist() if i != q][:20]
        own = sorted((r, v, e) for a, r, v, e in next(iter(found)) if a == q)
        assert [v for _, v, _ in own] == want and [e for *_, e in own] == s[want].tolist()


def test_multi_index_recall_at_the_shipped_share(spark):
    vectors = multi_index.valid_vectors(read(spark, "/root/testdata/sf0.01", "embeddings"))
    index, entries = multi_index.build(vectors)
    got = {}
    for r in multi_index.search(vectors.filter("vec_id % 20 = 0"), index, entries).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    rows = vectors.select("vec_id", "v").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["v"] for r in rows], dtype=np.float64)
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        best = [i for i in np.lexsort((ids, -(x @ x[q]))).tolist() if i != q][:20]
        hits += len(got[ids[q]] & set(ids[best].tolist()))
        total += len(best)
    assert hits / total >= 0.9


def test_merge_keeps_only_what_several_owners_share():
    from tvpulse.llm import suffix_merge
    strings = [b"abcdefgh" * 2, b"xxabcdefghyy", b"abcdefgh", b"only one owner", b"only one owner"]
    shards = [suffix_merge.Shard(strings[:2]), suffix_merge.Shard(strings[2:])]
    block, which, string, offset = suffix_merge.merge(shards, 8, np.array([0, 1, 2, 3, 3]))
    found = sorted((int(b), strings[[0, 2][w] + s][o:o + 8]) for b, w, s, o in zip(block, which, string, offset))
    assert found == [(found[0][0], b"abcdefgh")] * 4
    assert not any(len(x) for x in suffix_merge.merge(shards, 8, np.zeros(5, int)))


@pytest.mark.parametrize("page, count", [
    ('<p>start</p>' + '<a "' * 250_000, 2), ('<a x="' * 100_000 + '>', 0), ("<div>" * 100_000 + "deep", 1),
    ("<div>x" * 50_000, 50_000), ("<b>" + "<div></b>" * 50_000 + "x", 1), ("<" * 300_000, 1), ("<p>one <b>two</b></p>" * 200_000, 200_000)])
def test_html_blocks_read_any_page_in_linear_time(page, count):
    import time
    started = time.process_time()
    found = html_blocks.blocks(page)
    assert len(found) == count and time.process_time() - started < 20
    assert all(len(path) <= html_blocks.DEPTH + 2 for path, _, _ in found)


def test_html_labels_of_a_long_page_do_not_depend_on_stretches(monkeypatch):
    labeller = html_blocks.BlockLabeller()
    page = html_blocks.blocks("<p>some words here.</p><div class=menu>home</div><article><p>text</p></article>" * 400)
    whole = labeller.label([page, page[:7], []])
    monkeypatch.setattr(html_blocks, "CELLS", 100)
    cut = labeller.label([page, page[:7], []])
    assert [w.tolist() for w in whole] == [c.tolist() for c in cut] and len(whole[0]) == 1200


def test_html_training_sees_whole_pages_and_null_ids(spark):
    page = [((("p",),), f"block {i}", 0) for i in range(5000)]
    seen = html_blocks.spans(5000)
    assert seen[0].start == 0 and seen[-1].stop == 5000 and len(seen) == html_blocks.SPANS
    assert len(html_blocks.lessons([page])) == 3 * html_blocks.SPANS and html_blocks.spans(3) == [slice(0, 3)]
    pages = read(spark, "/root/testdata/sf0.001", "pages")
    nameless = pages.withColumn("page_id", F.lit(None).cast("long")).unionByName(pages.limit(1).withColumn("html", F.lit(None).cast("string")))
    got = html_blocks.extract(nameless, html_blocks.train(nameless)).collect()
    want = {r["url"]: r["text"] for r in html_blocks.extract(pages, html_blocks.train(pages)).collect()}
    assert len(got) == nameless.count() and all(r["text"] in (want[r["url"]], "") for r in got) and sum(r["text"] == "" for r in got) == 1
    # a repeated id brings one page to the driver, however often it occurs; clashing names don't matter
    many = pages.limit(1).select("page_id", "url", "html", F.explode(F.sequence(F.lit(1), F.lit(300))).alias("text"), F.lit(1).alias("n_chars"))
    assert html_blocks.extract(many, html_blocks.train(many)).count() == 300


@pytest.mark.parametrize("text", ["½", "²³", "①", "½ 12 _ ²", "Ⅷ"])
def test_numbers_of_all_kinds_are_no_letters(spark, text):
    docs = read(spark, SF, "documents")
    odd = spark.createDataFrame([(1, text), (2, f"{text} the")], "doc_id long, text string")
    got = by_id(langid.predict(odd, langid.train(docs)))
    assert got[1]["lang_pred"] == "und" and got[2]["lang_pred"] != "und"


def test_html_extraction(spark):
    pages = read(spark, "/root/testdata/sf0.01", "pages")
    got = by_id(html_blocks.extract(pages, html_blocks.train(pages)), "page_id")
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", s))).split())
                 for s in re.split(r"</?(?:p|h\d)\b[^>]*>", inner))
        want = "\n".join(p for p in parts if p)
        assert (got[r["page_id"]]["text"], got[r["page_id"]]["n_chars"]) == (want, len(want))
    odd = spark.createDataFrame([(1, "u", None), (2, None, ""), (None, "u", "<p>a<p>b</div></p><script>x"), (4, "u", "<" * 5000 + "a &lt; b"),
                                 (4, "u", "plain &amp; text")], "page_id long, url string, html string")
    labeller = html_blocks.train(odd)
    assert html_blocks.extract(odd, labeller).count() == 5 and html_blocks.extract(odd.limit(0), labeller).count() == 0
    assert all(r["text"] == "" for r in html_blocks.extract(odd.filter("html IS NULL OR html = ''"), labeller).collect())


@pytest.mark.parametrize("page, want", [
    ("<html><head><title>T</title><meta charset=x><style>s</style><body><p>one</p>", ["one"]),
    ("<html><head><title>T</title><article><p>one</article>", ["one"]),
    ("<html><HEAD><title>T</title>loose<script>x</script></HEAD><body><p>one</p>", ["one"]),
    ("<head><title>T</title><b>one</b> two", ["one two"]),
    ("<p>one <svg class='i'/> two</p><p>three", ["one two", "three"]),
    ("<p>one <svg><title/><path d='1'> two</p><p>three</p>", ["one two", "three"]),
    ("<p>a <math><mi>x</mi><mo>=</mo></math> b</p>", ["a x= b"]),
    ("<p>one<math> two<p>three", ["one two", "three"]),
    ("<object data=f><p>one</p></object><noscript><p>two</p></noscript><p>three</p>", ["one", "two", "three"]),
    ("<p>one</p><canvas><video src=v><audio src=a><object><p>two</p>", ["one", "two"]),
    ("<p>one</p><select><option>o<p>two</p>", ["one", "o", "two"]),
    ("<p>one</p><script>x</script><template><p>no</p></template><iframe>no</iframe><textarea>no</textarea><p>two", ["one", "two"]),
])
def test_html_blocks_lose_no_text(page, want):
    found = html_blocks.blocks(page)
    assert [t for _, t, _ in found] == want
    assert not any(html_blocks.furniture(path) for path, t, _ in found if t != "o")


def test_html_extraction_of_odd_articles(spark):
    pages = read(spark, "/root/testdata/sf0.01", "pages")
    labeller = html_blocks.train(pages)
    some = pages.filter("html LIKE '%</head>%' AND html LIKE '%<article>%'").limit(20)
    plain = by_id(html_blocks.extract(some, labeller), "page_id")
    icon = "regexp_replace(regexp_replace(html, '</head>', ''), '<article>', '<article><svg class=icon><canvas><video src=v><object data=o>')"
    odd = by_id(html_blocks.extract(some.selectExpr("page_id", "url", f"{icon} AS html"), labeller), "page_id")
    assert odd == plain and all(r["n_chars"] for r in odd.values())


def test_pipeline_keeps_columns_and_handles_edges(spark, edges):
    import corpus_pipeline as P
    docs = edges.unionByName(edges.limit(0))
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == edges.columns, name
    rows = docs.collect()
    ids = [r["doc_id"] for r in rows]
    assert sorted(i for i in ids if i is not None) == [2, 5, 7, 9] and ids.count(None) == 1
    assert [s for s, _ in P.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "byte_bpe"]
