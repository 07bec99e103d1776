"""Audited loads, load history, footer counts, versions, refresh."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tvpulse.plans import build as B
from tvpulse.plans.pipeline import Pipeline
from tvpulse.plans.versions import Versions
from tvpulse.schemas import DATASET_VERSION, DEVICE_LABELS, NETWORKS, VIEWING_LOG
from tvpulse.sources import readers, testdata
from tvpulse.sources.history import LoadHistory

from conftest import SF001, rows

T = dt.datetime
LOGS = [("E1", "NW01", "C000001", T(2024, 1, 1, 8), T(2024, 1, 1, 9), "NEWS"),
        ("E2", "NW02", "C000002", T(2024, 1, 1, 8), T(2024, 1, 1, 8, 30), "news"),
        ("E3", "NW02", "C000003", T(2024, 1, 1, 9), None, None)]


@pytest.fixture
def folder(scratch):
    return f"{scratch}/load-{uuid.uuid4().hex}"


def write(spark, path, logs=LOGS, without=None, **cast):
    df = spark.createDataFrame(logs, VIEWING_LOG).coalesce(1)
    for c, t in cast.items():
        df = df.withColumn(c, F.col(c).cast(t))
    (df.drop(without) if without else df).write.mode("append").parquet(path)


@pytest.mark.parametrize("without", ["GENRE", "VIEW_TO"])
def test_a_column_missing_from_a_later_file_is_named_with_its_file(spark, folder, without):
    write(spark, folder)
    assert readers.viewing_log(spark, folder).count() == 3
    write(spark, folder, without=without)
    with pytest.raises(ValueError, match=f"{without} in file:.*parquet") as error:
        readers.viewing_log(spark, folder)
    assert str(error.value).count(".parquet") == 1
    assert [c for c, _ in readers.absent_columns(spark, folder, VIEWING_LOG)] == [without]


def test_a_column_of_nulls_is_not_missing(spark, folder):
    write(spark, folder, LOGS[2:])
    assert {r.COLUMN_NAME for r in readers.valueless_columns(spark, folder, VIEWING_LOG).collect()} == {"GENRE", "VIEW_TO"}
    assert readers.viewing_log(spark, folder).count() == 1


def test_declared_types_are_never_inferred(spark, folder):
    write(spark, folder, VIEW_FROM="string")
    with pytest.raises(Exception):
        readers.viewing_log(spark, folder, audit=False).collect()
    from pyspark.sql import types
    as_text = {"VIEW_FROM": types.StringType()}
    assert rows(readers.viewing_log(spark, folder, stored=as_text), "EVENT_ID", "VIEW_FROM") == [(r[0], r[3]) for r in LOGS]
    spark.createDataFrame([("E9", "NW01", "C1", "not a time", T(2024, 1, 1), "NEWS")],
                          "EVENT_ID string, NETWORK_ID string, DEVICE_ID string, VIEW_FROM string, VIEW_TO timestamp_ntz, "
                          "GENRE string").write.mode("append").parquet(folder)
    with pytest.raises(Exception, match="bad value in column VIEW_FROM of file"):
        readers.viewing_log(spark, folder, stored=as_text).collect()


def test_labels_may_be_unknown_throughout_a_file(spark, folder):
    spark.createDataFrame([("C000001", False, None)], DEVICE_LABELS).write.parquet(folder)
    assert readers.device_labels(spark, folder).count() == 1


def test_history_loads_each_file_version_once(spark, folder):
    source = f"{folder}/source"
    path = readers.versioned(source, DATASET_VERSION, "VIEWING_LOG")
    history = LoadHistory(spark, f"{folder}/loaded")
    load = lambda: history.load(source, "VIEWING_LOG", DATASET_VERSION, VIEWING_LOG, ("NETWORK_ID",))
    table = lambda v=None: rows(history.table("VIEWING_LOG", VIEWING_LOG, v), "EVENT_ID", "NETWORK_ID")
    assert history.rows().count() == 0 and table() == []
    write(spark, f"{path}/a", LOGS[:2])
    write(spark, f"{path}/b", LOGS[2:])
    assert (load(), load()) == (2, 0)
    assert table() == [("E1", "NW01"), ("E2", "NW02"), ("E3", "NW02")]
    # a new file is the only one that is read
    write(spark, f"{path}/c", [("E4", *LOGS[0][1:])])
    assert (load(), load()) == (1, 0)
    # a replaced file takes the place of what it held
    file = next(f"{path}/a/{f}" for f in os.listdir(f"{path}/a".replace("file:", "")) if f.endswith(".parquet")).replace("file:", "")
    write(spark, f"{folder}/other", [("E1", "NW03", *LOGS[0][2:]), ("E5", *LOGS[0][1:])])
    new = next(f for f in os.listdir(f"{folder}/other".replace("file:", "")) if f.endswith(".parquet"))
    os.replace(f"{folder}/other/{new}".replace("file:", ""), file)
    for crc in (f"{os.path.dirname(file)}/.{os.path.basename(file)}.crc",):
        os.path.exists(crc) and os.remove(crc)
    assert (load(), load()) == (1, 0)
    assert table() == [("E1", "NW03"), ("E3", "NW02"), ("E4", "NW01"), ("E5", "NW01")]
    # another dataset version has a history of its own
    write(spark, f"{readers.versioned(source, 'NEXT', 'VIEWING_LOG')}/a", LOGS[:1])
    assert history.load(source, "VIEWING_LOG", "NEXT", VIEWING_LOG) == 1
    assert table("NEXT") == [("E1", "NW01")] and len(table(DATASET_VERSION)) == 4 and len(table()) == 5


def test_a_load_that_fails_leaves_no_trace(spark, folder):
    source = f"{folder}/source"
    path = readers.versioned(source, DATASET_VERSION, "VIEWING_LOG")
    history = LoadHistory(spark, f"{folder}/loaded")
    write(spark, f"{path}/a")
    assert history.load(source, "VIEWING_LOG", DATASET_VERSION, VIEWING_LOG) == 1
    write(spark, f"{path}/b", without="GENRE")
    with pytest.raises(ValueError, match="GENRE in"):
        history.load(source, "VIEWING_LOG", DATASET_VERSION, VIEWING_LOG)
    # rows written by a load that died before its history rows are not read either
    write(spark, f"{folder}/loaded/VIEWING_LOG/load=dead")
    assert history.table("VIEWING_LOG", VIEWING_LOG).count() == 3 and history.rows().count() == 1


def test_counts_come_from_the_footers(spark, folder):
    testdata.viewing_log(spark, SF001).write.partitionBy("NETWORK_ID").parquet(folder)
    counted = readers.stored_rows(spark, folder)
    assert "PushedAggregation: [COUNT(*)]" in counted._jdf.queryExecution().executedPlan().toString()
    n = counted.first()[0]
    loaded = readers.viewing_log(spark, folder, audit=False)
    assert n == loaded.count()
    whole, cut = readers.row_counts({"A": loaded, "B": loaded.limit(n - 1)}, {"A": n, "B": n}).orderBy("TABLE_NAME").collect()
    assert whole.MATCHES and not cut.MATCHES and cut.ACTUAL_ROWS == n - 1
    assert not readers.row_counts({"C": loaded}, {}).first().MATCHES
    # the caller's session keeps its reader
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def files_of(path):
    path = path.replace("file:", "")
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(path) for f in names}


def test_refreshing_a_station_leaves_the_others_untouched(spark, folder):
    raw = Pipeline(spark, SF001).raw
    first = B.store_stations(raw, folder)
    before, files = rows(B.common_daily(spark, folder)), files_of(first)
    assert before == rows(Pipeline(spark, SF001).daily)
    assert rows(B.common_audience(spark, folder)) == rows(Pipeline(spark, SF001).audience)
    fewer = raw.filter("NETWORK_ID <> 'NW03' OR EVENT_ID < 'E00000500'")
    second = B.store_stations(fewer, folder, ["NW03"])
    assert files_of(first) == files and os.listdir(f"{second}/mart_device_daily".replace("file:", "")).count("NETWORK_ID=NW03") == 1
    assert not any("NETWORK_ID=NW0" in f and "NW03" not in f for f in files_of(second))
    assert rows(B.common_daily(spark, folder)) == rows(Pipeline(spark, SF001, raw=fewer).daily)
    # a station that has no rows any more is an empty mart
    B.store_stations(raw.limit(0), folder, ["NW05"])
    assert B.station_mart(spark, folder, "mart_device_daily", "NW05").count() == 0
    plan = B.station_mart(spark, folder, "mart_device_daily", "NW01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(NETWORK_ID" in plan


def test_a_build_that_dies_before_the_pointer_leaves_the_old_version(spark, folder, monkeypatch):
    raw = Pipeline(spark, SF001).raw
    B.publish_common(raw, folder)
    old = rows(B.read_common(spark, folder, "viewing_daily"))
    assert len(B.read_common(spark, folder, "report").collect()) == len(NETWORKS) * 15 + 7
    fewer = raw.filter("EVENT_ID < 'E00000700'")
    publish = Versions.publish

    def dying(self, run, *names):
        if not names:  # all marts of the common version are written by now
            raise RuntimeError("executor lost")
        publish(self, run, *names)
    monkeypatch.setattr(Versions, "publish", dying)
    with pytest.raises(RuntimeError, match="executor lost"):
        B.publish_common(fewer, folder)
    assert rows(B.read_common(spark, folder, "viewing_daily")) == old
    monkeypatch.undo()
    # the stations were built by then; two of them are refreshed, the others keep their versions
    B.publish_common(raw, folder, refresh=["NW01", "NW02"])
    want = Pipeline(spark, SF001, raw=raw.filter("EVENT_ID < 'E00000700' OR NETWORK_ID <= 'NW02'")).daily
    assert rows(B.read_common(spark, folder, "viewing_daily")) == rows(want)


def test_versions_are_numbered_and_need_a_first_one(spark, folder):
    versions = Versions(spark, folder)
    with pytest.raises(LookupError):
        versions.current()
    runs = [versions.new_run() for _ in range(3)]
    for run in runs[:2]:
        versions.publish(run, "a", "b")
    versions.publish(runs[2], "b")
    assert (versions.current("a"), versions.current("b")) == (runs[1], runs[2])
    with pytest.raises(LookupError):
        versions.current("c")
