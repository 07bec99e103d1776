"""Registered queries and oracles of this subpackage."""

from __future__ import annotations

import zlib
from functools import cache, partial

from pyspark.sql import functions as F

from tvpulse.llm import byte_bpe, decontaminate, html_blocks, langid, line_spread, multi_index, periodic, records, secrets, simhash, suffix_dedup, token_alignment, toxicity
from tvpulse.llm.common import read, shared_folder

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@cache
def public_bpe(name: str = "byte_bpe_50k.tiktoken") -> byte_bpe.ByteBPE:
    import public_tokenizers
    return byte_bpe.ByteBPE(byte_bpe.load_ranks(public_tokenizers.path(name)), public_tokenizers.PATTERN)


@query
def op1_html_blocks(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    return html_blocks.extract(pages, html_blocks.train(pages))


@query
def op2_suffix_merge(spark, sf_dir):
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op3_byte_bpe(spark, sf_dir):
    return byte_bpe.round_trip(read(spark, sf_dir, "documents"), public_bpe())


@query
def op4_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc.doc_id", toxicity.held_out("doc.doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op5_multi_index(spark, sf_dir):
    vectors = multi_index.valid_vectors(read(spark, sf_dir, "embeddings"))
    index, entries = multi_index.build(vectors)
    return multi_index.search(vectors.filter("vec_id % 20 = 0"), index, entries)


def _of_kind(kind, span):
    return span["kind"] == kind


@query
def op6_secret_ledger(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = secrets.Ledger(spark, shared_folder(spark, "secret-ledger"))
    secrets.update(docs, ledger)
    spans, base = F.col("spans"), F.filter("spans", lambda s: s["order"] < len(secrets.BASE))
    count = [F.size(F.filter("spans", partial(_of_kind, r.kind))).cast("long").alias(f"n_{r.kind}") for r in secrets.BASE]
    return secrets.findings_of(docs, ledger, keep=["doc_id"]).select(
        "doc.doc_id", *count, F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(spans).alias("spans"))


@query
def op7_simhash(spark, sf_dir):
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


@query
def op8_langid(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs))


@query
def op9_line_spread(spark, sf_dir):
    kept = line_spread.remove_boilerplate(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return kept.select("doc.doc_id", "n_lines", "n_removed",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query
def op10_decontaminate(spark, sf_dir):
    found = decontaminate.contamination(read(spark, sf_dir, "documents").select("doc_id", "text"),
                                        read(spark, sf_dir, "benchmark"))
    return found.select("doc.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query
def op11_token_alignment(spark, sf_dir):
    import public_tokenizers
    return token_alignment.align(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                 public_tokenizers.path("piece_bpe_32k.model"))


def _with_period(doc_id, words):
    """Every tenth document, by the checksum of its id, gets a periodic tail."""
    part, one_in_ten = divmod(zlib.crc32(str(doc_id).encode()), 10) if doc_id is not None else (0, 1)
    if one_in_ten or not words:
        return words
    at = part % len(words)
    size = len(words) - at
    period = 1 + size // (3 + part % 8)
    return words[:at] + (words[at:at + period] * -(-size // period))[:size]


@query
def op12_periodic_runs(spark, sf_dir):
    found = periodic.collapse(read(spark, sf_dir, "documents"), rewrite=_with_period)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    longest = longest.cast("struct<length:bigint,start:bigint,period:bigint>")
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(line, lambda s: F.concat(s, F.lit("\n"))), ""), 256).alias("runs_sha256"), "collapsed_sha256")


@query
def op13_token_records(spark, sf_dir):
    import public_tokenizers
    index = records.write(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=2)
    counted = records.read(index).select("doc_id", "part", "shard", "offset", F.expr("octet_length(ids) div 4").alias("n_tokens"),
                                         F.crc32("ids").alias("ids_crc32"))
    return records.positions(counted).select("doc_id", "start", "n_tokens", "ids_crc32")


ORACLES = {"op6_secret_ledger": secrets.ORACLE, "op9_line_spread": line_spread.ORACLE, "op10_decontaminate": decontaminate.ORACLE}
