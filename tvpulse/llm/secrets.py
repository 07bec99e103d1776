"""Secret scans over an incremental blob ledger (operator 6).

Every version of a text is addressed by its SHA-256. The ledger records which
(blob, rule, rule version) pairs have been scanned and what they gave; a run
scans only pairs it lacks, each distinct blob once, and joins the findings
back to every row that holds the blob. DataFrame functions only.

Match positions come from the pieces between matches: a match starts after all
earlier pieces and matches, counted in code points.

Defined results: a null text is the empty blob, which has no findings;
repeated rows share one scan and each get a row; other columns of the input
pass through; an empty table scans nothing.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


class Rule(NamedTuple):
    """A pattern; matches whose ``group`` has fewer than ``least`` code points fall."""
    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1


#: The base rules, in the order of their listing.
BASE = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
EXTRA = (
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("private_key", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
RULES = BASE + EXTRA
FINDINGS = "blob string, kind string, version int, start long, end long"
SCANS = "blob string, kind string, version int"


class Ledger:
    """Two tables in a shared folder: pairs scanned, and their findings."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, table: str, schema: str) -> DataFrame:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
        if not at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{table}")

    def scans(self) -> DataFrame:
        return self._read("scans", SCANS)

    def findings(self) -> DataFrame:
        """Distinct: a run that died before it recorded its scans is repeated."""
        return self._read("findings", FINDINGS).distinct()

    def record(self, pending: DataFrame, found: DataFrame) -> None:
        found.write.mode("append").parquet(f"{self.path}/findings")
        pending.write.mode("append").parquet(f"{self.path}/scans")


def blob_id(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def _cells(rule: Rule) -> Column:
    """array<(gap, len, ok)>: a cell for every match of the rule in ``text``."""
    found = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    gaps = F.split("text", rule.pattern, -1)
    judged = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group))
    zipped = F.arrays_zip(found.alias("m"), judged.alias("g"), gaps.alias("p"))
    cells = F.transform(zipped, lambda c: F.struct(F.length(c["p"]).alias("gap"), F.length(c["m"]).alias("len"),
                                                   (F.length(c["g"]) >= rule.least).alias("ok")))
    return F.when(F.col("text").rlike(rule.pattern) & F.array_contains("todo", rule.kind), cells)


def scan(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, text, todo) -> findings of the rules named in ``todo``."""
    cells = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), _cells(r).alias("cells"))
                      for r in rules])
    rows = texts.select("blob", F.explode(F.filter(cells, lambda c: c["cells"].isNotNull())).alias("r")) \
        .select("blob", "r.kind", "r.version", F.posexplode("r.cells").alias("at", "c")).filter("c.len IS NOT NULL")
    through = Window.partitionBy("blob", "kind", "version").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum((F.col("c.gap") + F.col("c.len")).cast("long")).over(through)
    return rows.select("blob", "kind", "version", "c", end.alias("end")).filter("c.ok").select(
        "blob", "kind", "version", (F.col("end") - F.col("c.len")).alias("start"), "end")


def update(docs: DataFrame, ledger: Ledger, text: str = "text", rules: tuple[Rule, ...] = RULES) -> int:
    """Scan what the ledger lacks; returns the number of new pairs."""
    pairs = F.explode(F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules]))
    blobs = docs.select(blob_id(text).alias("blob")).distinct()
    pending = blobs.select("blob", pairs.alias("p")).select("blob", "p.*").join(
        ledger.scans(), ["blob", "kind", "version"], "left_anti")
    todo = pending.groupBy("blob").agg(F.collect_set("kind").alias("todo"))
    texts = docs.select(blob_id(text).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text")) \
        .groupBy("blob").agg(F.first("text").alias("text"))
    before = ledger.scans().count()
    ledger.record(pending, scan(texts.join(todo, "blob"), rules))
    return ledger.scans().count() - before


def findings_of(docs: DataFrame, ledger: Ledger, text: str = "text", rules: tuple[Rule, ...] = RULES,
                keep: list[str] | None = None) -> DataFrame:
    """(doc struct, spans): spans are (start, order, kind, end), sorted; ``doc``
    holds the columns ``keep`` (all by default), ``order`` is the rule's place
    in ``rules``."""
    current = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), F.lit(i).alias("order"))
                        for i, r in enumerate(rules)])
    rule = F.filter(current, lambda r: (r["kind"] == F.col("kind")) & (r["version"] == F.col("version")))
    spans = ledger.findings().withColumn("order", F.get(rule, F.lit(0))["order"]).filter("`order` IS NOT NULL") \
        .groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "order", "kind", "end"))).alias("spans"))
    rows = docs.select(F.struct(*(keep or ["*"])).alias("doc"), blob_id(text).alias("blob"))
    none = F.array().cast("array<struct<start:bigint,order:int,kind:string,end:bigint>>")
    return rows.join(spans, "blob", "left").select("doc", F.coalesce("spans", none).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _oracle() -> str:
    kinds = [(BASE[0].kind, BASE[0].pattern, 2, 6, 0), ("access", "AKIA[A-Z0-9]+", 0, 20, 1), ("hex", "[0-9a-f]+", 0, 24, 2)]
    kinds += [(r.kind, r.pattern, 0, 1, 3 + i) for i, r in enumerate(EXTRA)]
    parts = []
    for kind, pattern, group, least, order in kinds:
        q = "'" + pattern.replace("'", "''") + "'"
        parts.append(f"""SELECT doc_id, '{kind}' AS kind, {order} AS k, {least} AS least,
          unnest(regexp_extract_all(text, {q})) AS m, unnest(regexp_extract_all(text, {q}, {group})) AS g,
          unnest(string_split_regex(text, {q})[:len(regexp_extract_all(text, {q}))]) AS gap,
          generate_subscripts(regexp_extract_all(text, {q}), 1) AS nth FROM documents""")
    return f"""
WITH m AS ({' UNION ALL '.join(parts)}),
ends AS (SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id, k ORDER BY nth) AS e FROM m),
spans AS (SELECT doc_id, k, e - length(m) AS s, kind || ':' || (e - length(m))::BIGINT || ':' || e::BIGINT AS span
          FROM ends WHERE length(g) >= least)
SELECT d.doc_id, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access,
       count(*) FILTER (WHERE k = 2) AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY s, k) FILTER (WHERE k < 3), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY s, k), '') AS spans
FROM documents d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id
"""


ORACLE = _oracle()
