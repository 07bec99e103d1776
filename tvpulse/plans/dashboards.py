"""The data behind each dashboard view, one DataFrame per view.

Each view is planned as a single pass over the (scoped) daily or minute
mart; several metrics for different scopes are conditional aggregates in one
aggregate rather than separate queries joined afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tvpulse.functions.time import epoch_micros, minutes_sum
from tvpulse.operators import metrics as K
from tvpulse.plans.scope import Scope
from tvpulse.schemas import NETWORKS

KPIS = ("DISTINCT_REACH", "TOTAL_MINUTES", "TOTAL_SESSIONS", "MINUTES_PER_DEVICE")


def dash_summary(daily: DataFrame, scope: Scope, gate_on_data_start: bool = True) -> DataFrame:
    """KPIs now and for the previous period, deltas and minutes per device.

    The previous period is reported only when it starts on or after the first
    data day (``gate_on_data_start``); otherwise its columns are NULL, which
    is distinct from zero.
    """
    prev = scope.previous()
    cur_in, prev_in = scope.predicate(), prev.predicate()
    # the data start is needed only for the gate; without it the two scopes
    # are pushed into the scan as one disjunctive filter
    source = daily if gate_on_data_start else daily.filter(cur_in | prev_in)
    agg = source.agg(
        F.min("VIEW_DATE").alias("DATA_START"),
        *[c for pfx, inside in (("", cur_in), ("PREV_", prev_in)) for c in (
            F.count_distinct(F.when(inside, F.col("DEVICE_ID"))).alias(pfx + "DISTINCT_REACH"),
            F.coalesce(minutes_sum(F.when(inside, F.col("VIEW_MINUTES"))), F.lit(0.0))
            .alias(pfx + "TOTAL_MINUTES"),
            F.coalesce(F.sum(F.when(inside, F.col("SESSION_COUNT"))), F.lit(0)).cast("bigint")
            .alias(pfx + "TOTAL_SESSIONS"))])
    has_prev = (F.lit(prev.start) >= F.col("DATA_START")) if gate_on_data_start else F.lit(True)
    per_device = lambda p: F.try_divide(F.col(p + "TOTAL_MINUTES"),
                                        F.nullif(F.col(p + "DISTINCT_REACH"), F.lit(0)))
    out = agg.select(
        "DISTINCT_REACH", "TOTAL_MINUTES", "TOTAL_SESSIONS", per_device("").alias("MINUTES_PER_DEVICE"),
        *[F.when(has_prev, F.col("PREV_" + k)).alias("PREV_" + k)
          for k in ("DISTINCT_REACH", "TOTAL_MINUTES", "TOTAL_SESSIONS")],
        F.when(has_prev, per_device("PREV_")).alias("PREV_MINUTES_PER_DEVICE"))
    return out.select("*", *[K.period_delta(F.col(k), F.col("PREV_" + k)).alias("DELTA_" + k)
                             for k in KPIS])


#: D2's groupings: every dimension alone, and stations by genre.
TRENDS = [(d,) for d in K.DIMENSIONS] + [("NETWORK_ID", "GENRE")]


def dash_trends(daily: DataFrame, scope: Scope) -> DataFrame:
    """A3 + A4 + A5 + A6 for one scope in one pass (grouping sets).

    ``TREND_VIEW`` names the grouping after its dimensions; reach is
    recomputed per grouping.
    """
    grouped = scope.apply(daily).groupingSets([[F.col(c) for c in dims] for dims in TRENDS], *K.DIMENSIONS)
    out = grouped.agg(*K.kpi_columns(), *[F.grouping(c).alias("_g_" + c) for c in K.DIMENSIONS])
    view = F.concat_ws("_", *[F.when(F.col("_g_" + c) == 0, F.lit(name)) for c, name in K.DIMENSIONS.items()])
    return out.select(view.alias("TREND_VIEW"), *K.DIMENSIONS, "DISTINCT_REACH", "TOTAL_MINUTES", "TOTAL_SESSIONS")


def minute_scope(audience: DataFrame, day, networks) -> DataFrame:
    """One day's minute audience for the chosen stations, no zero fill."""
    return Scope.of(day, day, networks).apply(audience)


def minute_series(audience: DataFrame, day, networks) -> DataFrame:
    """O1: the scope in display order."""
    return minute_scope(audience, day, networks).orderBy("MINUTE_AT", "NETWORK_ID")


def dash_minute(audience: DataFrame, day, networks) -> DataFrame:
    """The day's series (O1), its pivot (R1) and the station peaks with the
    top one marked (W5, W6), tagged by MINUTE_VIEW.

    The mart is dealt by day once. On that partitioning the minutes become
    rows that carry a station-to-devices map, and a window over the day's
    minutes (1,440 at most) finds the peaks, so nothing is shuffled or sorted
    again; each minute row then unfolds into what the views show of it."""
    scope = Scope.of(day, day, networks)
    stations = sorted(scope.networks)
    seen = F.map_from_entries(F.collect_list(F.struct("NETWORK_ID", "VIEWING_DEVICES")))
    minutes = (scope.apply(audience).repartition("VIEW_DATE").groupBy("VIEW_DATE", "MINUTE_AT").agg(seen.alias("seen")))
    # the most devices, then the earliest minute; over stations, the lowest id
    at = epoch_micros("MINUTE_AT")
    whole_day = Window.partitionBy("VIEW_DATE")
    for s in stations:
        best = F.when(F.col("seen")[s].isNotNull(), F.struct(F.col("seen")[s].alias("n"), (-at).alias("at")))
        minutes = minutes.withColumn("_" + s, F.max(best).over(whole_day))
    top = F.array_max(F.array(*[F.struct(F.col("_" + s)["n"].alias("n"), F.lit(-i).alias("rank")) for i, s in enumerate(stations)]))

    def row(view: str, station=None, devices=None, peak=None, pivot=False):
        none = F.lit(None)
        return F.struct(
            F.lit(view).alias("MINUTE_VIEW"), (none if station is None else F.lit(station)).cast("string").alias("NETWORK_ID"),
            F.col("MINUTE_AT"), (none if devices is None else devices).cast("int").alias("VIEWING_DEVICES"),
            (none if peak is None else peak).cast("boolean").alias("IS_TOP_PEAK"),
            *[(F.col("seen")[n] if pivot and n in stations else none).cast("int").alias(n) for n in NETWORKS])

    rows = [row("pivot", pivot=True)]
    for i, s in enumerate(stations):
        here, best = F.col("seen")[s], F.col("_" + s)
        rows.append(F.when(here.isNotNull(), row("series", s, here)))
        rows.append(F.when((here == best["n"]) & (-at == best["at"]), row("peak", s, here, F.col("top")["rank"] == -i)))
    return minutes.withColumn("top", top).select(F.inline(F.array_compact(F.array(*rows))))


def trend_series(daily: DataFrame, scope: Scope | None = None) -> DataFrame:
    """Daily reach plus the 7-day mean, on the full calendar of the scope or,
    without one, of the data."""
    if scope is None:
        return K.reach_7d(K.calendar_fill(K.kpi(daily, "VIEW_DATE")))
    return K.reach_7d(K.calendar_reindex(K.kpi(scope.apply(daily), "VIEW_DATE"), scope.start, scope.end))


def trend_unpivot(daily: DataFrame, scope: Scope | None = None) -> DataFrame:
    """R2: (VIEW_DATE, SERIES, VALUE) for the daily and 7-day reach lines."""
    wide = trend_series(daily, scope).select(
        "VIEW_DATE", F.col("DISTINCT_REACH").cast("double").alias("DAILY"), F.col("REACH_7D").alias("ROLLING_7D"))
    return K.unpivot_series(wide, ["VIEW_DATE"], ["DAILY", "ROLLING_7D"], "SERIES", "VALUE")
