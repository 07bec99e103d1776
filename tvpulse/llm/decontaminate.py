"""Benchmark decontamination by a prefix-filtered set join (operator 10).

Benchmark items become windows of ``window`` consecutive words (an item with
fewer words is one window). Since a window must be contained whole, its rarest
word by corpus frequency is the only prefix token it needs. Document words
join that prefix; the position of the token fixes where the window would
start, which bounds and lengths must allow, and the words there are compared
exactly. DataFrame functions only.

Defined results: null and empty texts have no words and hit nothing; items
without words or without an id take no part; ties of rarity go to the smaller
word; repeated items count once; repeated documents each get a row; other
columns of the input are ignored; an empty table on either side gives no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tvpulse.llm.common import row_key, staged, within_bound

WINDOW = 13
#: What separates words, in lower-cased and in any text.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN_ANY = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Most prefix rows (a window each, some 200 bytes) that are broadcast.
BROADCAST_ROWS = 200_000


def words(text: str, lower: bool = True) -> Column:
    """The words in order. Splitting between them costs about a third of
    extracting them; only the ends can give an empty string."""
    parts = F.split(F.translate(F.col(text), UPPER, LOWER), BETWEEN) if lower else F.split(F.col(text), BETWEEN_ANY)
    return F.coalesce(F.array_remove(parts, ""), F.array().cast("array<string>"))


def windows(bench: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, win, len): the distinct windows of every item."""
    items = bench.filter("item_id IS NOT NULL").select("item_id", words("text").alias("w")).filter(F.size("w") > 0)
    start = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - size + 1)))
    return items.select("item_id", "w", start.alias("s")).select("item_id", F.slice("w", F.col("s"), size).alias("win")) \
        .distinct().withColumn("len", F.size("win"))


def prefixes(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """(word, offset, len, win, items): the rarest word of every window.

    Windows with a word that no document has are left out: they can't occur."""
    vocabulary = wins.select(F.explode("win").alias("word")).distinct()
    if within_bound(vocabulary, BROADCAST_ROWS):
        vocabulary = F.broadcast(vocabulary)
    rarity = docs.select(F.explode(words("text")).alias("word")).join(vocabulary, "word", "left_semi") \
        .groupBy("word").agg(F.count("*").alias("n"))
    items = wins.groupBy("win", "len").agg(F.collect_set("item_id").alias("items"))
    ranked = items.select("win", "len", "items", F.posexplode("win").alias("offset", "word")).join(rarity, "word") \
        .groupBy("win", "len", "items").agg(F.count("*").alias("known"), F.min(F.struct("n", "word", "offset")).alias("rarest"))
    return ranked.filter("known = len").select("rarest.word", "rarest.offset", "len", "win", "items")


def hits(docs: DataFrame, bench: DataFrame, size: int = WINDOW, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(key, start, len, items): every occurrence of a window, start from 0."""
    prefix = staged(prefixes(docs, windows(bench, size)), "bench-prefix")
    texts = docs.select(row_key("doc_id", "text").alias("key"), words("text").alias("w"))
    start = F.col("pos") - F.col("offset")
    fits = (start >= 0) & (start + F.col("len") <= F.size("w"))
    same = F.slice("w", start + 1, F.col("len")) == F.col("win")
    if within_bound(prefix, broadcast_rows):
        at = texts.select("key", "w", F.posexplode("w").alias("pos", "word")).join(F.broadcast(prefix), "word")
        return at.filter(fits).filter(same).select("key", start.alias("start"), "len", "items")
    at = texts.select("key", F.size("w").alias("n"), F.posexplode("w").alias("pos", "word")).join(prefix, "word") \
        .filter((start >= 0) & (start + F.col("len") <= F.col("n"))).select("key", "pos", "offset", "len", "win", "items")
    return at.join(texts.dropDuplicates(["key"]), "key").filter(fits & same).select("key", start.alias("start"), "len", "items")


def contamination(docs: DataFrame, bench: DataFrame, size: int = WINDOW, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc struct, n_words, n_hit, items, contaminated) for every document.

    ``doc`` holds every input column; a document is contaminated if at least
    a twentieth of its words lie inside occurrences of windows."""
    spans = hits(docs, bench, size, broadcast_rows).groupBy("key", "start").agg(
        F.max("len").alias("len"), F.flatten(F.collect_set("items")).alias("items")) \
        .groupBy("key").agg(F.collect_list(F.struct("start", "len")).alias("spans"),
                            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        "spans", lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1)))))
    found = staged(spans.select("key", covered.cast("long").alias("n_hit"), F.array_sort(
        F.col("items").cast("array<string>")).alias("items")), "bench-hits")
    whole = docs.select(row_key("doc_id", "text").alias("key"), F.size(words("text", lower=False)).cast("long").alias("n_words"),
                        F.struct("*").alias("doc"))
    out = whole.join(found, "key", "left").select(
        "doc", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + 12], ' ') AS win
  FROM b, unnest(generate_series(1, greatest(1, len(w) - 12))) AS s(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT rid, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM d, sizes, unnest(generate_series(1, len(w) - n + 1)) AS s(i)),
hit AS (SELECT DISTINCT rid, i, n, item_id FROM grams JOIN win USING (n, win)),
words AS (SELECT rid, count(DISTINCT i + o) AS n_hit FROM hit, unnest(generate_series(0, n - 1)) AS s(o) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT rid, item_id::VARCHAR AS id FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""
