"""V1-V6: a small metric view over the common daily mart.

Dimensions and metrics are named ``Column`` expressions; a query picks any
subset of dimensions and metrics and is planned as one filtered aggregate, so
reach is recomputed for every grouping (it is not additive). An empty scope
returns no rows rather than zeros.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tvpulse.functions.time import micros_between, minutes_sum
from tvpulse.plans.scope import Scope
from tvpulse.schemas import MICROS_PER_MINUTE


class MetricViewError(ValueError):
    """Unknown metric or dimension; the question is refused, never guessed."""


@dataclass(frozen=True)
class Dimension:
    name: str
    column: str
    synonyms: tuple[str, ...] = ()
    comment: str = ""


@dataclass(frozen=True)
class Metric:
    name: str
    expr: object  # callable returning a Column aggregate
    synonyms: tuple[str, ...] = ()
    comment: str = ""


@dataclass
class MetricView:
    """V1: dimensions and metrics over one base table."""
    base: DataFrame
    dimensions: list[Dimension] = field(default_factory=list)
    metrics: list[Metric] = field(default_factory=list)
    comment: str = ""

    def _lookup(self, items, name: str, kind: str):
        key = name.strip().lower()
        for it in items:
            if key == it.name.lower() or key in (s.lower() for s in it.synonyms):
                return it
        raise MetricViewError(f"unknown {kind}: {name!r}")

    def dimension(self, name: str) -> Dimension:
        return self._lookup(self.dimensions, name, "dimension")

    def metric(self, name: str) -> Metric:
        return self._lookup(self.metrics, name, "metric")

    def query(self, metrics=None, dimensions=(), where: Column | None = None) -> DataFrame:
        """V2/V3: metrics for a WHERE, grouped by any subset of dimensions."""
        ms = [self.metric(m) for m in (metrics or [m.name for m in self.metrics])]
        ds = [self.dimension(d) for d in dimensions]
        df = self.base if where is None else self.base.filter(where)
        aggs = [m.expr().alias(m.name.upper()) for m in ms] + [F.count(F.lit(1)).alias("_rows")]
        out = df.groupBy(*[F.col(d.column) for d in ds]).agg(*aggs) if ds else df.agg(*aggs)
        # a global aggregate over nothing is one row of zeros: report no rows instead
        return out.filter("_rows > 0").drop("_rows")

    def ask(self, metrics, dimensions=(), scope: Scope | None = None, default_scope: Scope | None = None):
        """V6: resolve synonyms, default to the full period and all stations."""
        scope = scope or default_scope
        return self.query(metrics, dimensions, scope.predicate() if scope else None)

    def describe(self, spark: SparkSession) -> DataFrame:
        """V5: the definition as rows (KIND, NAME, EXPRESSION, SYNONYMS, COMMENT)."""
        rows = [("DIMENSION", d.name, d.column, ", ".join(d.synonyms), d.comment) for d in self.dimensions]
        rows += [("METRIC", m.name, str(m.expr()), ", ".join(m.synonyms), m.comment) for m in self.metrics]
        return spark.createDataFrame(rows, "KIND string, NAME string, EXPRESSION string, SYNONYMS string, "
                                           "COMMENT string")


# The metric view's names and synonyms as the reference defines them.
VIEWING_DIMENSIONS = [
    Dimension("view_date", "VIEW_DATE", ("視聴日", "日付"), "viewing start date"),
    Dimension("network_id", "NETWORK_ID", ("放送局", "局", "ネットワーク"), "NW01..NW05"),
    Dimension("genre", "GENRE", ("ジャンル",), "genre at viewing start; eight codes"),
]
VIEWING_METRICS = [
    Metric("distinct_reach", lambda: F.count_distinct("DEVICE_ID"),
           ("リーチ", "到達端末数", "ユニーク端末数"), "distinct devices in scope; not additive"),
    Metric("total_minutes", lambda: minutes_sum("VIEW_MINUTES"),
           ("総視聴時間", "視聴時間分"), "sum of elapsed minutes, booked on the start date"),
    Metric("total_sessions", lambda: F.sum("SESSION_COUNT").cast("bigint"),
           ("総視聴回数", "セッション数"), "sum of SESSION_COUNT, not mart rows"),
]


def viewing_metric_view(common_daily: DataFrame) -> MetricView:
    return MetricView(common_daily, list(VIEWING_DIMENSIONS), list(VIEWING_METRICS),
                      "five-station viewing facts, one row per station, device, day and genre")


def reconcile(view: MetricView, clean: DataFrame) -> DataFrame:
    """V4: the metric view's totals over the mart against the same figures
    counted on the clean intervals, which owe nothing to the mart: rows are
    sessions and their own lengths the minutes. MATCHES is true when all three
    agree; two empty sides match."""
    names = {"distinct_reach": "REACH", "total_minutes": "MINUTES", "total_sessions": "SESSIONS"}
    mart = view.base.agg(*[view.metric(m).expr().alias("VIEW_" + m.upper()) for m in names])
    direct = clean.agg(F.count_distinct("DEVICE_ID").alias("DIRECT_REACH"),
                       (F.sum(micros_between("VIEW_FROM", "VIEW_TO").cast("decimal(28,0)")).cast("double")
                        / F.lit(float(MICROS_PER_MINUTE))).alias("DIRECT_MINUTES"),
                       F.nullif(F.count(F.lit(1)), F.lit(0)).alias("DIRECT_SESSIONS"))
    columns = mart.columns + direct.columns
    both = mart.unionByName(direct, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in columns])
    agree = [F.col("VIEW_" + m.upper()).eqNullSafe(F.col("DIRECT_" + n)) for m, n in names.items()]
    return both.withColumn("MATCHES", agree[0] & agree[1] & agree[2])
