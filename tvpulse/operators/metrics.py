"""A2-A15 aggregates, T6/T7/T9 series helpers, W5/W6 peaks, R1-R3 reshapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tvpulse.functions.time import minutes_sum
from tvpulse.schemas import GENRES, NETWORKS

#: The mart's dimensions and what a view grouped by them is called.
DIMENSIONS = {"VIEW_DATE": "daily", "NETWORK_ID": "network", "GENRE": "genre"}


def kpi_columns() -> list[Column]:
    """Reach (distinct devices, not additive), minutes and sessions."""
    return [
        F.count_distinct("DEVICE_ID").alias("DISTINCT_REACH"),
        F.coalesce(minutes_sum("VIEW_MINUTES"), F.lit(0.0)).alias("TOTAL_MINUTES"),
        F.coalesce(F.sum("SESSION_COUNT"), F.lit(0)).cast("bigint").alias("TOTAL_SESSIONS"),
    ]


def kpi(daily: DataFrame, *dims: str) -> DataFrame:
    """KPIs over an already scoped daily mart, overall or by dimensions.

    The empty scope yields one row (0, 0.0, 0) for the whole and no rows for
    a grouping. Reach is recomputed per grouping from device ids.
    """
    if not dims:
        return daily.agg(*kpi_columns())
    # O2: ordered by the dimensions (the sort runs on the aggregated rows)
    return daily.groupBy(*dims).agg(*kpi_columns()).orderBy(*dims)


def minutes_per_device(summary: DataFrame) -> DataFrame:
    """Minutes / reach, NULL when reach is 0."""
    return summary.withColumn(
        "MINUTES_PER_DEVICE",
        F.try_divide(F.col("TOTAL_MINUTES"), F.nullif(F.col("DISTINCT_REACH"), F.lit(0))))


def network_share(daily: DataFrame) -> DataFrame:
    """Each station's share of total minutes.

    The station aggregate has at most one row per station, so the global
    window over it runs on a handful of rows.
    """
    per_station = kpi(daily, "NETWORK_ID")
    micros = F.round(F.col("TOTAL_MINUTES") * F.lit(6e7)).cast("decimal(28,0)")
    total = F.sum(micros).over(Window.partitionBy()).cast("double") / F.lit(6e7)
    return per_station.select(
        "NETWORK_ID", "TOTAL_MINUTES",
        F.try_divide(F.col("TOTAL_MINUTES"), F.nullif(total, F.lit(0.0))).alias("MINUTE_SHARE"))


def date_bounds(daily: DataFrame, audience: DataFrame) -> DataFrame:
    """first/last day of both marts in one row."""
    both = (daily.select("VIEW_DATE", F.lit(True).alias("_daily"))
            .unionByName(audience.select("VIEW_DATE", F.lit(False).alias("_daily"))))
    in_daily = F.when(F.col("_daily"), F.col("VIEW_DATE"))
    in_minute = F.when(~F.col("_daily"), F.col("VIEW_DATE"))
    # one pass over the union instead of joining two one-row aggregates
    return both.agg(F.min(in_daily).alias("DATE_MIN"), F.max(in_daily).alias("DATE_MAX"),
                    F.min(in_minute).alias("MINUTE_DATE_MIN"), F.max(in_minute).alias("MINUTE_DATE_MAX"))


def common_totals(daily: DataFrame) -> DataFrame:
    """A10: rows, reach, sessions, minutes, first/last date, genre count."""
    return daily.agg(
        F.count(F.lit(1)).alias("MART_ROWS"),
        F.count_distinct("DEVICE_ID").alias("REACH_DEVICES"),
        F.sum("SESSION_COUNT").cast("bigint").alias("TOTAL_SESSIONS"),
        minutes_sum("VIEW_MINUTES").alias("TOTAL_MINUTES"),
        F.min("VIEW_DATE").alias("FIRST_DATE"),
        F.max("VIEW_DATE").alias("LAST_DATE"),
        F.count_distinct("GENRE").alias("GENRES"),
    )


def minute_totals(audience: DataFrame) -> DataFrame:
    """Minute-mart rows and the device-minute total."""
    return audience.agg(F.count(F.lit(1)).alias("MINUTE_MART_ROWS"),
                        F.sum("VIEWING_DEVICES").cast("bigint").alias("DEVICE_MINUTE_BUCKETS"))


def conditional_sums(daily: DataFrame, key: str = "DEVICE_ID") -> DataFrame:
    """Minutes per genre as columns (one conditional sum per genre)."""
    return daily.groupBy(key).agg(*[
        minutes_sum(F.when(F.col("GENRE") == g, F.col("VIEW_MINUTES")).otherwise(F.lit(0.0)))
        .alias(g + "_MINUTES") for g in GENRES])


# ---- series helpers ----------------------------------------------------------

def calendar_reindex(daily_kpi: DataFrame, start, end) -> DataFrame:
    """One row per calendar day in [start, end]; missing days keep NULLs."""
    spark = daily_kpi.sparkSession
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("VIEW_DATE"))
    # the calendar has one row per day of the scope: size-bounded broadcast
    return F.broadcast(days).join(daily_kpi, "VIEW_DATE", "left")


def calendar_fill(daily_kpi: DataFrame) -> DataFrame:
    """T6 from the first to the last day of the series itself: the days missing
    before a day's successor follow it with NULLs. One row per day comes in, so
    the ordered window holds the calendar, and no other pass finds its bounds."""
    day, values = F.col("VIEW_DATE"), [c for c in daily_kpi.columns if c != "VIEW_DATE"]
    known = daily_kpi.withColumn("_last", F.coalesce(F.date_sub(F.lead(day).over(Window.orderBy(day)), 1), day))
    gaps = known.withColumn("_day", F.explode(F.sequence(day, F.col("_last"))))
    return gaps.select(F.col("_day").alias("VIEW_DATE"), *[F.when(F.col("_day") == day, F.col(c)).alias(c) for c in values])


def reach_7d(calendar: DataFrame) -> DataFrame:
    """7-day mean of daily reach, NULL until seven non-null days.

    Runs on the day-level series (one row per day), so the global ordered
    window touches only a few hundred rows.
    """
    w = Window.orderBy("VIEW_DATE").rowsBetween(-6, 0)
    return calendar.withColumn(
        "REACH_7D",
        F.when(F.count("DISTINCT_REACH").over(w) == 7,
               F.avg("DISTINCT_REACH").over(w)))


def period_delta(current: Column, previous: Column) -> Column:
    """Relative change; NULL if previous is NULL or 0."""
    return F.try_divide(current, F.nullif(previous, F.lit(0))) - F.lit(1)


# ---- peaks and reshapes -------------------------------------------------------

def minute_peaks(series: DataFrame) -> DataFrame:
    """Each station's peak minute; earliest minute on ties."""
    w = Window.partitionBy("NETWORK_ID").orderBy(F.col("VIEWING_DEVICES").desc(), F.col("MINUTE_AT").asc())
    return (series.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
            .select("NETWORK_ID", "MINUTE_AT", "VIEWING_DEVICES"))


def minute_top_peak(peaks: DataFrame) -> DataFrame:
    """The best of the station peaks; lowest station id on ties."""
    return peaks.orderBy(F.col("VIEWING_DEVICES").desc(), F.col("NETWORK_ID").asc()).limit(1)


def minute_pivot(series: DataFrame) -> DataFrame:
    """One row per minute, one column per station, NULL where absent."""
    return series.groupBy("MINUTE_AT").pivot("NETWORK_ID", list(NETWORKS)).agg(F.max("VIEWING_DEVICES"))


def unpivot_series(df: DataFrame, ids: list[str], values: list[str], var: str, value: str) -> DataFrame:
    """R2: wide to long, keeping NULL values (no dropna)."""
    return df.unpivot(ids, values, var, value)


def share_unpivot(wide: DataFrame, ids: list[str]) -> DataFrame:
    """Genre share columns to long form with the ``_SHARE`` suffix stripped."""
    cols = [g + "_SHARE" for g in GENRES]
    long = wide.unpivot(ids, cols, "GENRE", "AVERAGE_SHARE")
    return long.withColumn("GENRE", F.regexp_replace("GENRE", "_SHARE$", ""))
