"""Hierarchical language identification (operator 8).

A linear model predicts the language family first; one-versus-one linear
support vector machines then separate the languages of that family. Features
are hashed character bigrams and trigrams of the whole lower-cased text,
square-rooted and scaled to length one.

Defined results: ``und`` with score 0 for a null text, a text without a
letter, and where nothing could be learned; a single learned language is
predicted for every text; a null doc_id counts as not held out but is never
trained on; repeated rows each get a row; other columns of the input are
ignored; ties of votes go to the larger summed margin, then the smaller name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tvpulse.llm.common import slices

DIM = 4096
#: Training rows of a language (all, if it has fewer), least hash of the id first.
PER_LANGUAGE = 1000
#: A language's rows are thinned by hash to about this many times PER_LANGUAGE
#: before they are ranked, so that no task ranks all rows of a common language.
SPARE = 2
#: The family of well-known languages; any other is its own family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi".split(),
    "romance": "fr es it pt ro ca gl oc la".split(),
    "slavic": "ru uk be bg sr hr bs sl mk pl cs sk".split(),
}
UNKNOWN = "und"


def family_of(lang: str) -> str:
    return next((f for f, own in FAMILIES.items() if lang.split("-")[0].lower() in own), lang)


def features(text: str) -> np.ndarray:
    """Hashed bigram and trigram profile; ASCII other than letters counts as a space."""
    profile = np.zeros(DIM)
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32)
    for at in range(0, len(codes), 1 << 18):
        c = codes[max(0, at - 2):at + (1 << 18)]
        c = np.where((c < 128) & ((c < 97) | (c > 122)), np.uint32(32), c)
        two = c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA77)
        three = two[:-1] * np.uint32(0xC2B2AE3D) + c[2:] * np.uint32(0x27D4EB2F)
        for h in (two, three):
            profile += np.bincount((h ^ h >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> np.uint32(20), minlength=DIM)
    profile = np.sqrt(profile)
    return profile / max(1e-12, np.linalg.norm(profile))


def linear_svm(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4, steps: int = 150) -> tuple[np.ndarray, float]:
    """Squared hinge loss, classes weighted alike; accelerated gradient steps."""
    each = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w, v, b, vb, rate = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 0.0, 0.0, 0.25
    for k in range(steps):
        slack = np.maximum(0, 1 - y * (x @ v + vb)) * y * each
        new, newb = v + rate * (2 * (slack @ x) - ridge * v), vb + rate * 2 * slack.sum()
        v, vb = new + k / (k + 3) * (new - w), newb + k / (k + 3) * (newb - b)
        w, b = new, newb
    return w, b


class LanguageModel:
    def __init__(self, langs: list[str], x: np.ndarray, y: np.ndarray):
        """``y`` indexes ``langs``, the learned languages."""
        self.langs = langs
        family = np.array([family_of(v) for v in langs], dtype=object)
        self.families = sorted(set(family))
        self.members = [np.flatnonzero(family == f).tolist() for f in self.families]
        of_row = family[y] if len(langs) else np.zeros(0, dtype=object)
        several = len(self.families) > 1
        top = [linear_svm(x, np.where(of_row == f, 1.0, -1.0)) for f in self.families] if several else []
        self.top = np.array([w for w, _ in top]).reshape(len(top), DIM), np.array([b for _, b in top])
        self.pairs = {}
        for own in self.members:
            for i, j in combinations(own, 2):
                rows = (y == i) | (y == j)
                self.pairs[i, j] = linear_svm(x[rows], np.where(y[rows] == i, 1.0, -1.0))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        x, sure, own = features(text), 1.0, self.members[0]
        if len(self.families) > 1:
            z = self.top[0] @ x + self.top[1]
            best = int(np.argmax(z))
            e = np.exp(np.clip(2 * z, -30, 30))
            sure, own = float(e[best] / e.sum()), self.members[best]
        votes = {i: [0, 0.0] for i in own}
        for i, j in combinations(own, 2):
            w, b = self.pairs[i, j]
            z = float(w @ x + b)
            votes[i if z >= 0 else j][0] += 1
            votes[i][1] += z
            votes[j][1] -= z
        best = min(own, key=lambda i: (-votes[i][0], -votes[i][1], self.langs[i]))
        rivals = max(1, len(own) - 1)
        if len(own) > 1:
            sure *= 1 / (1 + float(np.exp(-np.clip(2 * votes[best][1] / rivals, -30, 30))))
        return self.langs[best], sure


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(documents: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Fit on a sample of every language that a training row names: at most
    ``per_language`` rows of each, those with the least hash of the id."""
    own = documents.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).filter(
        "doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").filter(~held_out())
    draw = F.pmod(F.xxhash64("doc_id"), F.lit((1 << 31) - 1)) / ((1 << 31) - 1)
    # the least draw stays in, so that no language is thinned to nothing
    sizes = own.groupBy("lang").agg(F.greatest(F.lit(SPARE * per_language) / F.count("*"), F.min(draw)).alias("reach"))
    order = Window.partitionBy("lang").orderBy("draw", "doc_id", F.xxhash64("text"))
    rows = own.withColumn("draw", draw).join(F.broadcast(sizes), "lang").filter("draw <= reach") \
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_language).select("doc_id", "text", "lang")

    def run(batches: Iterator[pa.RecordBatch]):
        for b in slices(batches):
            x = [features(t).astype(np.float32).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.binary()), b.column(2)], names=["doc_id", "x", "lang"])

    got = rows.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, x binary, lang string").collect()
    got.sort(key=lambda r: (r["doc_id"], r["lang"], r["x"]))
    langs = sorted({r["lang"] for r in got})
    at = {lang: i for i, lang in enumerate(langs)}
    x = np.frombuffer(b"".join(r["x"] for r in got), np.float32).reshape(-1, DIM)
    return LanguageModel(langs, x, np.array([at[r["lang"]] for r in got], np.int64))


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]):
        m = shared.value
        for b in slices(batches):
            out = [m.predict(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in out], pa.string()),
                                              pa.array([s for _, s in out], pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double").select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
