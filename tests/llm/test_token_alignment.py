"""Tokenizer alignment against a plain reading of its definition."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from tvpulse.llm import queries, token_alignment
from tvpulse.llm.common import read
from tvpulse.llm.recent import byte_alphabet

SF = "/root/testdata/sf0.001"
public = pytest.importorskip("public_tokenizers")
ZERO = (0, 0, 0, 0, 0, 0, "")


@pytest.fixture(scope="module")
def files():
    return public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries(files):
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(files[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=files[1])


def brute(rows, libraries):
    """The seven columns of every (id, text), from the definition alone."""
    a, b = libraries
    inverse = {c: bytes([n]) for c, n in byte_alphabet().items()}
    names = {i: t for t, i in a.get_vocab().items()}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes.fromhex(p[3:5]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()

    def spans(parts):
        at = 0
        for p in parts:
            yield at, at + len(p)
            at += len(p)

    kept = []
    for _, text in rows:
        kept.append(None)
        if not text:
            continue
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        p, q = [b"".join(inverse[c] for c in names[i]) for i in x], [piece(i) for i in y]
        if not b"".join(p) == b"".join(q) == (" " + text).encode():
            continue
        sa, sb = list(spans(p)), list(spans(q))
        links, j = [], 0
        for i, (s, e) in enumerate(sa):
            while sb[j][1] <= s:
                j += 1
            k = j
            while k < len(sb) and sb[k][0] < e:
                links.append((x[i], y[k]))
                k += 1
        both = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, low = [], 0
        ia = ib = 0
        for end in both:
            ja, jb = ia, ib
            while ja < len(sa) and sa[ja][1] <= end:
                ja += 1
            while jb < len(sb) and sb[jb][1] <= end:
                jb += 1
            groups.append(",".join(map(str, x[ia:ja])) + "|" + ",".join(map(str, y[ib:jb])))
            ia, ib = ja, jb
        assert low == 0 and ia == len(sa) and ib == len(sb)
        kept[-1] = (len(x), len(y), links, groups)
    count, best = Counter(pair for k in kept if k for pair in set(k[2])), defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    return [(d, *((k[0], k[1], len(k[3]), len(k[2]), sum(count[p] == best[p[0]] for p in k[2]), sum(count[p] for p in k[2]),
                   hashlib.sha256(";".join(k[3]).encode()).hexdigest()) if k else ZERO)) for (d, _), k in zip(rows, kept)]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r))


def want(rows, libraries):
    return sorted(brute(rows, libraries), key=lambda r: (r[0] is None, r))


def test_query_equals_brute_force(spark, libraries):
    rows = [(r["doc_id"], r["text"]) for r in read(spark, SF, "documents").collect()]
    found = queries.QUERIES["op11_token_alignment"](spark, SF)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert got(found) == want(rows, libraries)


@pytest.mark.parametrize("bounds", [(token_alignment.HOT_PAIRS, token_alignment.HOT_TEXTS), (40, 3), (1, 1)])
def test_edges_and_rare_keys(spark, files, libraries, bounds, monkeypatch):
    """Odd spaces, scripts and special strings; copies; the same by either join."""
    monkeypatch.setattr(token_alignment, "HOT_PAIRS", bounds[0])
    monkeypatch.setattr(token_alignment, "HOT_TEXTS", bounds[1])
    rng = random.Random(11)
    atoms = ["word", "Wörter", "don't", "a▁b", "<|endoftext|>", "</s>", "<0x41>", "<unk>", "漢字", "👩‍👩‍👧", "...", "—", "é", "\x1c", "\x00", "12", "½", "\xa0",
             "　", "​", "́", "“q”", "end.", "a,", "é.", "5.", "Ünï!!", "x$$$", "\x01.", "\x01", "it's,", "(b)", "ɏɐ", "ªº", "a.b.", "..."]
    rows = [(i, "".join(rng.choice(atoms) + rng.choice(["", " ", " ", "  ", "\n", " \n", "\t"]) for _ in range(rng.randrange(1, 25)))) for i in range(300)]
    rows += [(400 + i % 7, "the same text, again and again") for i in range(150)]
    rows += [(600, None), (601, ""), (602, " "), (603, "\n\n"), (604, " lead"), (605, "trail "), (None, "no id"), (None, None), (1, "other text of an id")]
    rows += [(700, "loooong " * 3000 + "x" * 20_000)]
    docs = spark.createDataFrame([(*r, "c", 1, "d") for r in rows], "doc_id long, text string, digest string, row int, pair string").repartition(5)
    assert got(token_alignment.align(docs, *files)) == want(rows, libraries)


def test_empty_table(spark, files):
    assert token_alignment.align(spark.createDataFrame([], "doc_id long, text string"), *files).count() == 0
