"""Toxicity by a weighted finite-state pattern grammar (operator 4).

Words become symbols: insult, threat, target, negation, report or other. Three
small transducers are composed into one machine that rewrites insults and
threats with the context they stand in (aimed at a target, negated, reported).
A clause is scored by the patterns the machine emits for it, a document by the
sum over its matched clauses; isolated words without a clause match count for
nothing. Pattern weights and the insult lexicon (words and word stems) are
learned from labelled training rows, starting from general priors, so the
grammar also works on tables without labels.

Only clauses that hold an insult or a threat are run; an Aho-Corasick scan of
the whole text finds them. Defined results: null and empty texts, and texts
without a match, get the score of no evidence; a null doc_id is not held out
and never trained on; rows of a repeated id count once in training; other
columns are ignored or passed through; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import product

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tvpulse.llm.common import slices

#: Bounds of the training sample: labelled rows of each class, least hash first.
MAX_TOXIC, MAX_CLEAN = 2000, 4000
#: Fixed seed vocabulary of the grammar.
INSULTS = ("idiot moron stupid loser scum pathetic worthless disgusting imbecile dumbass fool bastard bitch asshole "
           "idiota estúpido imbécil basura cabrón crétin connard salope débile dummkopf arschloch abschaum trottel").split()
THREATS = ("kill murder hurt destroy shoot stab strangle beat töten umbringen schlagen matar destruir golpear tuer "
           "frapper détruire").split()
TARGETS = ("you your yours yourself u ur he she they them him her du dich dir ihr euch sie tu te toi vous tú ti usted "
           "ustedes él ella ellos").split()
NEGATIONS = "not no never n't don't isn't aren't nicht kein keine nie pas jamais ni nunca jamás".split()
REPORTS = ("said says say called calls reported claimed quote quoted wrote according sagte sagt schrieb nannte dit "
           "disait écrit dijo dice llamó escribió").split()
#: Words that a negation or a report reaches, and that link a target.
NEAR = {"negated": 3, "reported": 8, "aimed": 3}
CLAUSE_END = re.compile(r"[.!?;:\n]")
#: Other apostrophes, read as '.
APOSTROPHES = "’ʼ＇"
TOKEN = re.compile(r"[^\W_]+(?:'[^\W_]+)?|[\"“”«»]")
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)
FLAGS = ("aimed", "negated", "reported")
#: An emitted pattern: insult or threat, with each flag off or on; then "target follows".
PATTERNS = [(kind, *on) for kind in (INSULT, THREAT) for on in product((0, 1), repeat=3)]


class Transducer:
    """Deterministic: step(state, symbol) -> (state, symbol out)."""

    def __init__(self, states: int, step):
        self.states, self.step = states, step

    def compose(self, other: Transducer) -> Transducer:
        """The machine that feeds this one's output to ``other``."""
        def step(state, symbol):
            a, b = divmod(state, other.states)
            a, middle = self.step(a, symbol)
            b, out = other.step(b, middle)
            return a * other.states + b, out
        return Transducer(self.states * other.states, step)

    def table(self, symbols) -> dict:
        """Arcs of every reachable state: (state, symbol) -> (state, out)."""
        arcs, todo, seen = {}, [0], {0}
        while todo:
            s = todo.pop()
            for x in symbols:
                arcs[s, x] = t, _ = self.step(s, x)
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return arcs


def scope(trigger: int, flag: int, reach: int) -> Transducer:
    """Marks insults and threats that stand within ``reach`` words after ``trigger``."""
    def step(left, symbol):
        kind, marks = symbol if isinstance(symbol, tuple) else (symbol, (0, 0, 0))
        if kind == trigger:
            return reach, symbol
        if left and kind in (INSULT, THREAT):
            return left - 1, (kind, tuple(m | (i == flag) for i, m in enumerate(marks)))
        return max(0, left - 1), symbol
    return Transducer(reach + 1, step)


def grammar() -> dict:
    """report o negation o target, as one table of arcs."""
    machine = scope(REPORT, 2, NEAR["reported"]).compose(scope(NEGATION, 1, NEAR["negated"])).compose(
        scope(TARGET, 0, NEAR["aimed"]))
    return machine.table(range(6))


class ToxicityModel:
    """Lexicon, grammar and weights; ``score`` is a probability."""

    def __init__(self, lexicon: dict[str, float], weights: np.ndarray | None = None):
        #: stem -> log-odds; a trailing * marks a stem that any word may continue
        self.lexicon = lexicon
        self.weights = prior_weights() if weights is None else weights
        self._build()

    def _build(self):
        self.arcs = grammar()
        self.column = {p: i for i, p in enumerate(PATTERNS)}
        self.words = {w: NEGATION for w in NEGATIONS} | {w: REPORT for w in REPORTS} | {w: TARGET for w in TARGETS}
        self.words |= {q: REPORT for q in '"“”«»'}
        self.scan = ahocorasick.Automaton()
        for stem in self.lexicon:
            self.scan.add_word(stem.rstrip("*"), (len(stem.rstrip("*")), INSULT, stem.endswith("*"), self.lexicon[stem]))
        for stem in set(THREATS) - {s.rstrip("*") for s in self.lexicon}:
            self.scan.add_word(stem, (len(stem), THREAT, False, 1.0))
        self.scan.make_automaton()

    def __getstate__(self):
        return {"lexicon": self.lexicon, "weights": self.weights}

    def __setstate__(self, state):
        self.__dict__ |= state
        self._build()

    def matches(self, text: str) -> list[tuple[int, int, float]]:
        """(start, symbol, log-odds) of insult and threat words, in text order."""
        found = {}
        for last, (size, kind, stem, odds) in self.scan.iter(text):
            at, end = last - size + 1, last + 1
            if at and text[at - 1].isalnum() or not stem and end < len(text) and text[end].isalnum():
                continue
            if at not in found or odds > found[at][1]:
                found[at] = (kind, odds)
        return [(at, *found[at]) for at in sorted(found)]

    def features(self, text: str | None) -> np.ndarray:
        """Pattern counts (log scale), targets that follow an insult, evidence."""
        x = np.zeros(len(PATTERNS) + 2)
        text = (text or "").lower()
        for c in APOSTROPHES:
            text = text.replace(c, "'")
        hits, i = self.matches(text), 0
        while i < len(hits):
            start = max((text.rfind(c, 0, hits[i][0]) for c in ".!?;:\n"), default=-1) + 1
            stop = m.start() if (m := CLAUSE_END.search(text, hits[i][0])) else len(text)
            own = {}
            while i < len(hits) and hits[i][0] < stop:
                own[hits[i][0]] = hits[i][1]
                x[-1] += hits[i][2]
                i += 1
            state, since = 0, 9
            for t in TOKEN.finditer(text, start, stop):
                for symbol in self._symbols(t, own):
                    state, out = self.arcs[state, symbol]
                    since += 1
                    if symbol in (INSULT, THREAT):
                        kind, marks = out if isinstance(out, tuple) else (out, (0, 0, 0))
                        x[self.column[kind, *marks]] += 1
                        since = 0
                    elif symbol == TARGET and since <= 2:
                        x[-2] += 1
        return np.log1p(x)

    def _symbols(self, token: re.Match, hits: dict[int, int]) -> list[int]:
        """A word's symbol; of a word with an apostrophe (you're, l'idiot) those
        of its parts that have one, unless the whole word does (isn't)."""
        start, word = token.start(), token[0]
        if "'" not in word:
            return [hits.get(start) or self.words.get(word, OTHER)]
        if word in self.words and not any(start <= h < token.end() for h in hits):
            return [self.words[word]]
        rest = start + word.index("'") + 1
        both = (hits.get(start) or self.words.get(word[:rest - start - 1], OTHER),
                hits.get(rest) or self.words.get(word[rest - start:], OTHER))
        return [s for s in both if s != OTHER] or [OTHER]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)
        return 1 / (1 + np.exp(-z))


def prior_weights() -> np.ndarray:
    """Before any label: a clause counts less if negated or reported, more if aimed."""
    w = [(4.0 if kind == INSULT else 3.0) + aimed - 1.5 * negated - 1.0 * reported for kind, aimed, negated, reported in PATTERNS]
    return np.array([*w, 0.5, 0.2, -2.5])


def stems(text: str) -> set[str]:
    words = {w for w in re.findall(r"[^\W\d_]+", text.lower()) if len(w) > 2}
    return words | {w[:n] + "*" for w in words for n in (4, 5, 6) if len(w) >= n}


def induce(texts: list[str], toxic: np.ndarray) -> dict[str, float]:
    """Words and stems that mark toxic training texts, with their log-odds.

    A candidate is kept if its share of toxic texts couldn't be chance for as
    many candidates; then toxic texts without a kept stem are covered greedily
    by stems that no clean text has and at least three of them share. Of stems
    with the same support the longest stands."""
    own = [stems(t) for t, y in zip(texts, toxic) if y]
    clean = Counter(s for t, y in zip(texts, toxic) if not y for s in stems(t))
    found, n1, n0 = Counter(s for x in own for s in x), len(own), len(texts) - len(own)
    if not n1 or not n0:
        return {}
    strict, share = math.log(len(found) + 1), math.log(n1 / (n1 + n0))
    kept: dict[str, float] = {}

    def odds(stem):
        return math.log((found[stem] + 0.5) / (n1 + 1)) - math.log((clean[stem] + 0.5) / (n0 + 1))

    def covered(stem):
        body = stem.rstrip("*")
        return any(body[:n] + "*" in kept for n in range(4, len(body) + 1))

    def keep(stem, pool):
        longer = [s for s in pool if len(s.rstrip("*")) > len(stem.rstrip("*")) and s.startswith(stem.rstrip("*"))
                  and pool[s] >= 0.98 * pool[stem]]
        best = max([stem, *longer], key=lambda s: (len(s.rstrip("*")), s))
        kept[best] = odds(best)

    strong = [s for s in found if odds(s) >= 3 and -found[s] * share - clean[s] * 4 >= strict]
    for stem in sorted(strong, key=lambda s: (len(s.rstrip("*")), s)):
        if not covered(stem):
            keep(stem, {s: found[s] for s in strong})
    while True:
        left = [x for x in own if not any(s in kept for s in x)]
        pool = Counter(s for x in left for s in x if not clean[s])
        if not pool or max(pool.values()) < 3:
            return kept
        keep(min(pool, key=lambda s: (-pool[s], s)), pool)


def fit(texts: list[str], toxic: np.ndarray, ridge: float = 0.05, steps: int = 30) -> ToxicityModel:
    """Lexicon, then pattern weights: logistic regression around the priors."""
    learned = induce(texts, toxic)
    bodies = [s.rstrip("*") for s in learned]
    seeds = {w: 2.0 for w in INSULTS if not any(w.startswith(b) for b in bodies)}
    model = ToxicityModel(seeds | learned)
    if not len(texts):
        return model
    x = np.array([model.features(t) for t in texts])
    x1, w, prior = np.hstack([x, np.ones((len(x), 1))]), model.weights.copy(), model.weights
    each = np.where(toxic == 1, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (1 - toxic).sum())) * len(x)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        grad = x1.T @ (each * (p - toxic)) + ridge * len(x) * 0.1 * (w - prior)
        hess = (x1 * (each * p * (1 - p))[:, None]).T @ x1 + ridge * len(x) * 0.1 * np.eye(len(w))
        w = w - np.linalg.solve(hess, grad)
    return ToxicityModel(model.lexicon, w)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> ToxicityModel:
    """Fit on a bounded sample of labelled rows that are not held out.

    The sample takes at most ``max_toxic`` and ``max_clean`` ids, least hash
    first; their whole texts come to the driver (the bound is in rows)."""
    own = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~held_out()) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id"), F.col("doc_id")
    ids = own.filter("toxic = 1").orderBy(*order).limit(max_toxic).unionByName(
        own.filter("toxic = 0").orderBy(*order).limit(max_clean))
    rows = documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"]) \
        .select("doc_id", "text", "toxic").collect()
    rows.sort(key=lambda r: r["doc_id"])
    return fit([r["text"] or "" for r in rows], np.array([r["toxic"] for r in rows], dtype=float))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc struct, score): ``doc`` holds every input column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]):
        m = shared.value
        for b in slices(batches):
            x = np.array([m.features(t) for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(m.score(x), pa.float64())], names=["doc", "score"])

    src = docs.select(F.struct("*").alias("doc"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, f"doc {src.schema['doc'].dataType.simpleString()}, score double")
