"""Station and common builds with their check reports.

``station_checks`` / ``common_checks`` name the 15 + 6 checks per scope;
``stations_report`` and ``dq_report`` turn them into rows (CHECK_NAME, SCOPE,
VIOLATIONS); ``publish_common`` writes the common marts only when every check
of every station and of common reported zero violations.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tvpulse.operators import quality as Q
from tvpulse.operators.clean import clean_viewing
from tvpulse.operators.marts import common_minute_audience, common_viewing_daily, device_daily, viewing_minutes
from tvpulse.operators.sweep import minute_audience_sweep
from tvpulse.plans.versions import Versions
from tvpulse.session import output_dir
from tvpulse.schemas import (AUDIENCE_COLUMNS, AUDIENCE_KEYS, CLEAN_COLUMNS, DAILY_COLUMNS, DAILY_KEYS,
                             GENRES, MINUTE_COLUMNS, NETWORKS)

STATION_CHECKS = (
    "clean_not_null", "clean_network", "clean_event_id_unique", "clean_device_id", "clean_genre",
    "clean_valid_intervals", "daily_not_null", "daily_grain", "daily_station_volume",
    "minutes_not_null", "minutes_grain", "minutes_expansion",
    "audience_not_null", "audience_grain", "audience_recount")
COMMON_CHECKS = ("common_daily_not_null", "common_daily_grain", "common_minute_not_null",
                 "common_minute_grain", "common_daily_totals", "common_minute_totals")
#: The gate's own check: no raw row is outside the stations that were built.
GATE_CHECKS = COMMON_CHECKS + ("raw_network",)
REPORT = "CHECK_NAME string, SCOPE string, VIOLATIONS long"


def station_checks(raw: DataFrame, clean: DataFrame, daily: DataFrame, minutes: DataFrame, audience: DataFrame,
                   stations=NETWORKS) -> dict[str, DataFrame]:
    """The checks of all stations at once: every row names its station."""
    per = ("NETWORK_ID",)
    return {
        "clean_not_null": Q.not_null(clean, CLEAN_COLUMNS),
        "clean_network": Q.accepted_values(clean, "NETWORK_ID", stations, per),
        "clean_event_id_unique": Q.unique(clean, "EVENT_ID"),
        "clean_device_id": Q.invalid_device_ids(clean, keep=per),
        "clean_genre": Q.accepted_values(clean, "GENRE", GENRES, per),
        "clean_valid_intervals": Q.invalid_intervals(clean),
        "daily_not_null": Q.not_null(daily, DAILY_COLUMNS),
        "daily_grain": Q.unique_grain(daily, DAILY_KEYS),
        "daily_station_volume": Q.station_volume(raw, clean, daily, stations),
        "minutes_not_null": Q.not_null(minutes, MINUTE_COLUMNS),
        "minutes_grain": Q.minute_grain(minutes),
        "minutes_expansion": Q.minute_expansion(clean, minutes, keep=per),
        "audience_not_null": Q.not_null(audience, AUDIENCE_COLUMNS),
        "audience_grain": Q.unique_grain(audience, AUDIENCE_KEYS),
        "audience_recount": Q.minute_audience_matches(minutes, audience),
    }


def common_checks(daily_by_station: dict[str, DataFrame], audience_by_station: dict[str, DataFrame],
                  common_daily: DataFrame, common_audience: DataFrame) -> dict[str, DataFrame]:
    return {
        "common_daily_not_null": Q.not_null(common_daily, DAILY_COLUMNS),
        "common_daily_grain": Q.unique_grain(common_daily, DAILY_KEYS),
        "common_minute_not_null": Q.not_null(common_audience, AUDIENCE_COLUMNS),
        "common_minute_grain": Q.unique_grain(common_audience, AUDIENCE_KEYS),
        "common_daily_totals": Q.common_totals_match(daily_by_station, common_daily, "daily"),
        "common_minute_totals": Q.common_totals_match(audience_by_station, common_audience, "minute"),
    }


def dq_report(checks: dict[str, DataFrame], scope: str) -> DataFrame:
    """Q13: one row per check with its violation count (a global count, so a
    check with no violations still reports 0)."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("VIOLATIONS")).select(
            F.lit(name).alias("CHECK_NAME"), F.lit(scope).alias("SCOPE"), "VIOLATIONS")
        for name, df in checks.items()])


def stations_report(checks: dict[str, DataFrame], stations=NETWORKS) -> DataFrame:
    """Q13 by station: each check is planned once and counted by NETWORK_ID;
    a literal row per check and station keeps the zeros."""
    spark = next(iter(checks.values())).sparkSession
    zeros = spark.createDataFrame([(c, s, 0) for c in checks for s in stations], REPORT)
    counted = [df.filter(F.col("NETWORK_ID").isin(list(stations))).groupBy(F.col("NETWORK_ID").alias("SCOPE"))
               .agg(F.count(F.lit(1)).alias("VIOLATIONS")).select(F.lit(name).alias("CHECK_NAME"), "SCOPE", "VIOLATIONS")
               for name, df in checks.items()]
    return (reduce(DataFrame.unionByName, [zeros, *counted]).groupBy("CHECK_NAME", "SCOPE")
            .agg(F.sum("VIOLATIONS").alias("VIOLATIONS")))


def full_report(raw_all: DataFrame, stations=NETWORKS, common_daily: DataFrame | None = None,
                common_audience: DataFrame | None = None, materialize: bool = False) -> DataFrame:
    """All station checks (15 each) plus the 6 common checks as one DataFrame
    of 21 plans, whatever the number of stations.

    With ``materialize`` every stage (raw included) is computed once and
    written as a table (the marts partitioned by NETWORK_ID) under a run id in the shared
    output folder, which also cuts the lineage: the checks then read stored
    stages instead of recomputing them."""
    clean = clean_viewing(raw_all)
    daily, minutes, audience = device_daily(clean), viewing_minutes(clean), minute_audience_sweep(clean)
    if materialize:
        spark = raw_all.sparkSession
        base = f"{output_dir(spark)}/report/run={uuid.uuid4().hex}"
        stored = []
        for name, df in (("raw", raw_all), ("clean", clean), ("daily", daily), ("minutes", minutes),
                         ("audience", audience)):
            writer = df.write.mode("overwrite")
            # only the marts are read by station; a partitioned write would sort, and spill, every minute row
            (writer.partitionBy("NETWORK_ID") if name in ("daily", "audience") else writer).parquet(f"{base}/{name}")
            stored.append(spark.read.schema(df.schema).parquet(f"{base}/{name}").select(*df.columns))
        raw_all, clean, daily, minutes, audience = stored
    by_station = lambda df: {s: df.filter(F.col("NETWORK_ID") == s) for s in stations}
    common = common_checks(by_station(daily), by_station(audience), daily if common_daily is None else common_daily,
                           audience if common_audience is None else common_audience)
    return stations_report(station_checks(raw_all, clean, daily, minutes, audience, stations), stations).unionByName(
        dq_report(common, "COMMON"))


class GateError(RuntimeError):
    """The common marts were not published: a check failed or is missing."""


class ViolationsError(GateError):
    """Every check ran, and some found violations."""


def assert_all_passed(report_rows, required: dict[str, tuple[str, ...]]) -> None:
    """Q14: every required (scope, check) present exactly once with 0 violations."""
    seen: dict[tuple[str, str], int] = {}
    for r in report_rows:
        key = (r["SCOPE"], r["CHECK_NAME"])
        if key in seen:
            raise GateError(f"check reported twice: {key}")
        seen[key] = int(r["VIOLATIONS"])
    missing = [(s, c) for s, names in required.items() for c in names if (s, c) not in seen]
    if missing:
        raise GateError(f"checks missing from the report: {missing}")
    failed = {k: v for k, v in seen.items() if v != 0}
    if failed:
        raise ViolationsError(f"checks with violations: {failed}")


def outside_stations(raw_all: DataFrame, stations=NETWORKS) -> DataFrame:
    """Raw rows that no station's build takes: unknown or missing NETWORK_ID.
    Known stations left out on purpose are not counted."""
    known = F.col("NETWORK_ID").isin(sorted({*stations, *NETWORKS}))
    return raw_all.filter(~F.coalesce(known, F.lit(False)))


#: What is stored per station, and its declared form.
_RAW = "EVENT_ID string, NETWORK_ID string, DEVICE_ID string, VIEW_FROM timestamp_ntz, VIEW_TO timestamp_ntz, GENRE string"
STATION_MARTS = {
    "raw": _RAW, "clean_viewing": f"{_RAW}, VIEW_MINUTES double",
    "mart_device_daily": "NETWORK_ID string, DEVICE_ID string, VIEW_DATE date, GENRE string, SESSION_COUNT int, VIEW_MINUTES double",
    "mart_minute_audience": "NETWORK_ID string, VIEW_DATE date, MINUTE_AT timestamp_ntz, VIEWING_DEVICES int"}


def _stored(spark, run: str, name: str) -> DataFrame:
    df = spark.read.schema(STATION_MARTS[name]).parquet(f"{run}/{name}")
    return df.select(*[f.split()[0] for f in STATION_MARTS[name].split(", ")])


def store_stations(raw_all: DataFrame, out_dir: str, stations=NETWORKS, marts=tuple(STATION_MARTS)) -> str:
    """Build the stations' marts and make them the stations' current
    versions; returns the run folder.

    All stations are built in one pass per mart, each into a folder of its own
    (``NETWORK_ID=...``). Other stations' folders are not touched, so this is
    the refresh of one station as well as the build of all. ``marts`` may leave
    out stages that nobody reads; a stage reads the stored one before it if
    that is kept."""
    spark, versions = raw_all.sparkSession, Versions(raw_all.sparkSession, f"{out_dir}/stations")
    run = versions.new_run()
    stages = {"raw": lambda stored: raw_all.filter(F.col("NETWORK_ID").isin(list(stations))),
              "clean_viewing": lambda stored: clean_viewing(stored("raw")),
              "mart_device_daily": lambda stored: device_daily(stored("clean_viewing")),
              "mart_minute_audience": lambda stored: minute_audience_sweep(stored("clean_viewing"))}

    def stage(name: str) -> DataFrame:
        return _stored(spark, run, name) if name in marts else stages[name](stage)

    for name in STATION_MARTS:
        if name in marts:
            stages[name](stage).write.partitionBy("NETWORK_ID").parquet(f"{run}/{name}")
    versions.publish(run, *stations)
    return run


def station_mart(spark, out_dir: str, name: str, station: str) -> DataFrame:
    """One station's current mart, from that station's folder alone (the others
    are pruned); a station without rows is the empty mart."""
    run = Versions(spark, f"{out_dir}/stations").current(station)
    return _stored(spark, run, name).filter(F.col("NETWORK_ID") == station)


def common_daily(spark, out_dir: str, stations=NETWORKS) -> DataFrame:
    """UNION ALL of the stations' separately stored daily marts."""
    return common_viewing_daily([station_mart(spark, out_dir, "mart_device_daily", s) for s in stations])


def common_audience(spark, out_dir: str, stations=NETWORKS) -> DataFrame:
    """UNION ALL of the stations' separately stored minute marts."""
    return common_minute_audience([station_mart(spark, out_dir, "mart_minute_audience", s) for s in stations])


def publish_common(raw_all: DataFrame, out_dir: str, stations=NETWORKS, refresh=None) -> str:
    """Q14: build the stations, check everything, then publish the common marts.

    ``refresh`` names the stations to build anew (default: all); the others
    keep their current versions. Checks and union read the stored marts. The
    common marts are written only after the gate, which also fails on raw rows
    of unknown stations, and become current by one pointer row after the last
    of them is written: readers never see a failed or half-written build.
    Returns the run folder; the report (one row per check) is stored in it,
    and before the gate judges it among the build's reports (``gate_report``)."""
    spark = raw_all.sparkSession
    store_stations(raw_all, out_dir, stations if refresh is None else refresh)
    marts = {name: {s: station_mart(spark, out_dir, name, s) for s in stations} for name in STATION_MARTS}
    raw, clean, daily, audience = (reduce(DataFrame.unionByName, by.values()) for by in marts.values())
    report = stations_report(station_checks(raw, clean, daily, viewing_minutes(clean), audience, stations), stations).unionByName(dq_report(
        common_checks(marts["mart_device_daily"], marts["mart_minute_audience"], daily, audience)
        | {"raw_network": outside_stations(raw_all, stations)}, "COMMON"))
    rows = report.collect()  # one row per check
    reports = Versions(spark, f"{out_dir}/reports")
    judged = reports.new_run()
    spark.createDataFrame(rows, REPORT).coalesce(1).write.parquet(judged)
    reports.publish(judged)
    assert_all_passed(rows, {s: STATION_CHECKS for s in stations} | {"COMMON": GATE_CHECKS})
    versions = Versions(spark, f"{out_dir}/common")
    run = versions.new_run()
    spark.createDataFrame(rows, REPORT).coalesce(1).write.parquet(f"{run}/report")
    # station folders prune station filters; range partitioning on (station,
    # date, third key) keeps each file's dates narrow, so date scopes skip row
    # groups, and its sampled bounds split a hot station-day over several tasks
    for name, df, order in (("viewing_daily", daily, ["NETWORK_ID", "VIEW_DATE", "DEVICE_ID"]),
                            ("minute_audience", audience, ["NETWORK_ID", "VIEW_DATE", "MINUTE_AT"])):
        df.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("NETWORK_ID").parquet(f"{run}/{name}")
    versions.publish(run)
    return run


def gate_report(spark, out_dir: str) -> DataFrame:
    """The report of the last build, whether the gate let it through or not."""
    return spark.read.schema(REPORT).parquet(Versions(spark, f"{out_dir}/reports").current())


def read_common(spark, out_dir: str, name: str) -> DataFrame:
    """The current common mart ``name`` ("viewing_daily", "minute_audience")
    or the "report" of its gate."""
    columns = {"viewing_daily": DAILY_COLUMNS, "minute_audience": AUDIENCE_COLUMNS, "report": ["CHECK_NAME", "SCOPE", "VIOLATIONS"]}[name]
    return spark.read.parquet(f"{Versions(spark, f'{out_dir}/common').current()}/{name}").select(*columns)


__all__ = ["station_checks", "common_checks", "dq_report", "stations_report", "full_report", "assert_all_passed", "store_stations",
           "station_mart", "common_daily", "common_audience", "publish_common", "gate_report", "read_common", "GateError", "ViolationsError"]
