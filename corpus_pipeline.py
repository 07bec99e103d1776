"""Corpus pipeline: documents -> clean, deduplicated, decontaminated token ids.

``STAGES`` lists (name, function) in order. A function takes (spark, docs,
sf_dir); its result is written as Parquet and reread as the next one's docs.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tvpulse.llm import byte_bpe, decontaminate, line_spread, simhash, toxicity
from tvpulse.llm.common import read, row_key, staged
from tvpulse.llm.queries import public_bpe


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4, trained on the labelled documents of ``sf_dir``: rejects go."""
    model = toxicity.train(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter("score < 0.5").select("doc.*")


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: every document stays, without cross-site boilerplate lines.

    ``n_chars`` follows the text; documents that lose no line are untouched."""
    kept, changed = line_spread.remove_boilerplate(docs), F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("text")).otherwise(F.col("doc.text")),
           "n_chars": F.when(changed, F.length("text").cast("long")).otherwise(F.col("doc.n_chars"))}
    return kept.select(*[new.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: the document with the smallest id of each component stays.

    Rows that repeat an id and its text count as one document. Of an id with
    several texts each is judged by its own component; in one component the
    text with the least key stays. Rows without an id stay only where no member
    of their component has one, one row per fingerprint."""
    keyed = docs.withColumn("__row", row_key("doc_id", "text"))
    found = simhash.grouped(keyed, keep=("__row",))
    named = found.filter("doc_id = component_id").groupBy("root").agg(F.min("__row").alias("__kept"))
    kept = keyed.join(named, F.col("__row") == F.col("__kept"), "left_semi").dropDuplicates(["__row"]).drop("__row")
    nameless = docs.filter("doc_id IS NULL")
    if nameless.isEmpty():
        return kept
    alone = found.filter("doc_id IS NULL AND component_id IS NULL").select("fingerprint").distinct()
    marked = nameless.withColumn("__fp", simhash.fingerprint_column("text"))
    return kept.unionByName(marked.join(alone, F.col("__fp") == F.col("fingerprint"), "left_semi")
                            .dropDuplicates(["__fp"]).drop("__fp"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that quote the benchmark go."""
    found = decontaminate.contamination(docs, read(spark, sf_dir, "benchmark"))
    return found.filter(~F.col("contaminated")).select("doc.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: token count and digests of ids and of the decoded bytes."""
    return byte_bpe.round_trip(docs, public_bpe())


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_boilerplate_lines), ("near_dedup", drop_near_duplicates),
          ("decontamination", drop_contaminated), ("byte_bpe", tokenize)]

#: The first stage's classifier is learned, so SQL can't express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
