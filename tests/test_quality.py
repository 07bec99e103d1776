"""Every check is empty on the clean pipeline and fires on its mutation."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from tvpulse.operators import quality as Q
from tvpulse.operators.clean import clean_viewing
from tvpulse.operators.marts import device_daily
from tvpulse.plans import build as B
from tvpulse.plans.pipeline import Pipeline
from tvpulse.schemas import CLEAN_COLUMNS, DAILY_KEYS, GENRES, NETWORKS

from conftest import SF001


@pytest.fixture(scope="module")
def nw01(spark):
    p = Pipeline(spark, SF001, raw=Pipeline(spark, SF001).raw.filter(F.col("NETWORK_ID") == "NW01").cache())
    p.__dict__.update({stage: getattr(p, stage).cache() for stage in ("clean", "daily", "minutes", "audience")})
    return p


def test_full_report_is_all_zero(spark):
    rep = B.full_report(Pipeline(spark, SF001).raw).collect()
    assert len(rep) == 5 * 15 + 6
    assert {(r.SCOPE, r.CHECK_NAME) for r in rep} == (
        {(s, c) for s in NETWORKS for c in B.STATION_CHECKS} | {("COMMON", c) for c in B.COMMON_CHECKS})
    assert all(r.VIOLATIONS == 0 for r in rep)


def first_row(df):
    return df.limit(1)


def test_not_null_and_grain_fire(nw01):
    bad = nw01.clean.limit(1).withColumn("GENRE", F.lit(None).cast("string"))
    assert Q.not_null(nw01.clean.unionByName(bad), CLEAN_COLUMNS).count() == 1
    assert Q.unique_grain(nw01.daily.unionByName(first_row(nw01.daily)), DAILY_KEYS).count() == 1
    other = first_row(nw01.clean).withColumn("GENRE", F.lit("DRAMA"))
    assert Q.unique(nw01.clean.unionByName(other), "EVENT_ID").count() == 1


def test_accepted_values_fire(nw01):
    bad = first_row(nw01.clean).withColumn("NETWORK_ID", F.lit("NW09")).withColumn("GENRE", F.lit("QUIZ"))
    mutated = nw01.clean.unionByName(bad)
    assert [r.VALUE_FIELD for r in Q.accepted_values(mutated, "NETWORK_ID", ["NW01"]).collect()] == ["NW09"]
    assert [r.VALUE_FIELD for r in Q.accepted_values(mutated, "GENRE", GENRES).collect()] == ["QUIZ"]


def test_device_id_fires(spark):
    ids = ["C000001", "C020000", "C000000", "C020001", "xC000001", "C000001\n", None, "C00001"]
    df = spark.createDataFrame([(i,) for i in ids], "DEVICE_ID string")
    assert sorted(r.DEVICE_ID or "" for r in Q.invalid_device_ids(df).collect()) == sorted(
        ["C000000", "C020001", "xC000001", "C000001\n", "", "C00001"])
    assert Q.device_id_out_of_range(df).count() == 6


def test_valid_intervals_fire(nw01):
    plus = first_row(nw01.clean).withColumn("VIEW_MINUTES", F.col("VIEW_MINUTES") + 1e-6)
    empty = first_row(nw01.clean).withColumn("VIEW_TO", F.col("VIEW_FROM"))
    assert Q.invalid_intervals(plus).count() == 1
    assert Q.invalid_intervals(empty).count() == 1
    assert Q.invalid_intervals(nw01.clean).count() == 0


def test_station_volume_fires(spark, nw01):
    volume = lambda *stages: Q.station_volume(*stages, ["NW01"])
    assert volume(nw01.raw, nw01.clean, nw01.daily).count() == 0
    more = nw01.daily.withColumn("SESSION_COUNT", F.col("SESSION_COUNT") + F.when(
        F.col("DEVICE_ID") == nw01.daily.first().DEVICE_ID, 1).otherwise(0))
    assert volume(nw01.raw, nw01.clean, more).count() == 1
    fewer = nw01.daily.exceptAll(first_row(nw01.daily))
    assert volume(nw01.raw, nw01.clean, fewer).count() == 1
    empty = nw01.raw.limit(0)
    assert volume(empty, clean_viewing(empty), device_daily(clean_viewing(empty))).count() == 1


def test_station_volume_judges_each_station_alone(spark):
    """One station's surplus doesn't cancel another's loss; an empty station fails."""
    p = Pipeline(spark, SF001)
    assert Q.station_volume(p.raw, p.clean, p.daily).count() == 0
    shift = F.when(F.col("NETWORK_ID") == "NW01", 1).when(F.col("NETWORK_ID") == "NW02", -1).otherwise(0)
    one = p.daily.groupBy("NETWORK_ID").agg(F.min(F.struct("DEVICE_ID", "VIEW_DATE", "GENRE")).alias("k")).select("NETWORK_ID", "k.*")
    moved = p.daily.join(one.withColumn("_hit", F.lit(1)), DAILY_KEYS, "left").withColumn(
        "SESSION_COUNT", F.col("SESSION_COUNT") + F.coalesce("_hit", F.lit(0)) * shift).drop("_hit")
    assert moved.agg(F.sum("SESSION_COUNT")).first()[0] == p.daily.agg(F.sum("SESSION_COUNT")).first()[0]
    found = {r.NETWORK_ID: r.WRONG_CELLS for r in Q.station_volume(p.raw, p.clean, moved).collect()}
    assert found == {"NW01": 1, "NW02": 1}
    without = [df.filter("NETWORK_ID <> 'NW04'") for df in (p.raw, p.clean, p.daily)]
    assert [r.NETWORK_ID for r in Q.station_volume(*without).collect()] == ["NW04"]
    nowhere = p.clean.withColumn("GENRE", F.when(F.col("NETWORK_ID") != "NW05", F.col("GENRE")))
    # a NULL genre is a key of its own that never matches (the definition's equality join)
    assert {r.NETWORK_ID for r in Q.station_volume(p.raw, nowhere, device_daily(nowhere)).collect()} == {"NW05"}


def test_uniqueness_is_per_station(spark):
    p = Pipeline(spark, SF001)
    other = p.clean.filter("NETWORK_ID = 'NW01'").limit(1).withColumn("NETWORK_ID", F.lit("NW02"))
    assert Q.unique(p.clean.unionByName(other), "EVENT_ID").count() == 0
    assert Q.unique(p.clean.unionByName(other), "EVENT_ID", per=()).count() == 1


def test_recount_equals_the_definition(spark):
    p = Pipeline(spark, SF001)
    odd = p.minutes.limit(5).withColumn("MINUTE_AT", F.timestamp_add("SECOND", F.lit(7), F.col("MINUTE_AT")))
    null = p.minutes.limit(3).withColumn("MINUTE_AT", F.lit(None).cast("timestamp_ntz"))
    for minutes in (p.minutes, p.minutes.unionByName(odd).unionByName(p.minutes.limit(50)), p.minutes.unionByName(null)):
        want = minutes.groupBy("NETWORK_ID", "VIEW_DATE", "MINUTE_AT").agg(F.count_distinct("DEVICE_ID").alias("VIEWING_DEVICES"))
        known = [df.filter("MINUTE_AT IS NOT NULL") for df in (Q.recount(minutes), want)]
        assert sorted(map(tuple, known[0].collect())) == sorted(map(tuple, known[1].collect()))
    assert Q.recount(p.minutes.unionByName(null)).filter("MINUTE_AT IS NULL").count() > 0


def test_every_check_finds_its_seeded_faults(spark):
    from tvpulse import registry
    for name in registry.CHECKS:
        assert registry.QUERIES[name + "_faulty"](spark, SF001).count() > 0, name


def test_minute_expansion_fires(nw01):
    m = nw01.minutes
    e = m.first().EVENT_ID
    first_min = m.filter(F.col("EVENT_ID") == e).agg(F.min("MINUTE_AT")).first()[0]
    dropped = m.filter(~((F.col("EVENT_ID") == e) & (F.col("MINUTE_AT") == first_min)))
    repeated = m.unionByName(first_row(m))
    shifted = m.withColumn("MINUTE_AT", F.when(F.col("EVENT_ID") == e, F.col("MINUTE_AT") + F.expr(
        "INTERVAL 1 SECOND")).otherwise(F.col("MINUTE_AT")))
    wrong_day = m.withColumn("VIEW_DATE", F.when(F.col("EVENT_ID") == e, F.date_add("VIEW_DATE", 1))
                             .otherwise(F.col("VIEW_DATE")))
    assert Q.minute_expansion(nw01.clean, m).count() == 0
    for mutated in (dropped, repeated, shifted, wrong_day):
        assert Q.minute_expansion(nw01.clean, mutated).count() >= 1


def test_minute_audience_fires(nw01):
    a = nw01.audience
    k = a.first()
    hit = (F.col("MINUTE_AT") == k.MINUTE_AT) & (F.col("NETWORK_ID") == k.NETWORK_ID)
    assert Q.minute_audience_matches(nw01.minutes, a).count() == 0
    plus = a.withColumn("VIEWING_DEVICES", F.when(hit, F.col("VIEWING_DEVICES") + 1).otherwise(F.col("VIEWING_DEVICES")))
    zero = a.withColumn("VIEWING_DEVICES", F.when(hit, F.lit(0)).otherwise(F.col("VIEWING_DEVICES")))
    extra = a.unionByName(first_row(a).withColumn("MINUTE_AT", F.lit(dt.datetime(2030, 1, 1)).cast("timestamp_ntz"))
                          .withColumn("VIEW_DATE", F.lit(dt.date(2030, 1, 1))))
    for mutated in (plus, zero, extra):
        assert Q.minute_audience_matches(nw01.minutes, mutated).count() >= 1


def test_common_totals_fire(spark):
    p = Pipeline(spark, SF001)
    stations = {s: p.daily.filter(F.col("NETWORK_ID") == s) for s in NETWORKS}
    assert Q.common_totals_match(stations, p.daily, "daily").count() == 0
    dropped = p.daily.filter(F.col("NETWORK_ID") != "NW03")
    assert [r.NETWORK_ID for r in Q.common_totals_match(stations, dropped, "daily").collect()] == ["NW03"]
    changed = p.daily.withColumn("VIEW_MINUTES", F.when(F.col("NETWORK_ID") == "NW02", F.col("VIEW_MINUTES") * 2)
                                 .otherwise(F.col("VIEW_MINUTES")))
    assert [r.NETWORK_ID for r in Q.common_totals_match(stations, changed, "daily").collect()] == ["NW02"]
    empty = dict(stations, NW05=p.daily.limit(0))
    assert Q.common_totals_match(empty, p.daily.filter("NETWORK_ID != 'NW05'"), "daily").count() == 1


def test_label_coverage_fires(spark):
    p = Pipeline(spark, SF001)
    extra = spark.createDataFrame([("C999999", True, 1)], p.labels.schema)
    r = Q.label_coverage(p.labels.unionByName(extra).filter("DEVICE_ID != 'C000001'"), p.daily).first()
    assert (r.LABEL_DEVICES_WITHOUT_OBSERVATIONS, r.OBSERVED_DEVICES_WITHOUT_LABEL_ROW) == (1, 1)


def test_publish_gate(spark, scratch):
    import uuid
    raw = Pipeline(spark, SF001).raw
    out = f"{scratch}/build-{uuid.uuid4().hex}"
    B.publish_common(raw, out)
    published = B.read_common(spark, out, "viewing_daily")
    assert published.columns == Pipeline(spark, SF001).daily.columns
    assert sorted(published.collect()) == sorted(Pipeline(spark, SF001).daily.collect())
    assert sorted(B.read_common(spark, out, "minute_audience").collect()) == sorted(
        Pipeline(spark, SF001).audience.collect())
    # the model job runs on the published build (command-line path, few rounds)
    from tvpulse.__main__ import run_model_job
    from tvpulse.sources import testdata
    testdata.device_labels(spark, SF001).write.parquet(f"{out}/labels")
    metrics = run_model_job(spark, out, f"{out}/labels", rounds=3)
    assert set(metrics) == {"ROC_AUC", "PRECISION", "RECALL", "F1_SCORE"}
    from tvpulse.ml.model import published_predictions
    assert published_predictions(spark, f"{out}/predictions").count() == Pipeline(spark, SF001).features.count()
    bad_out = f"{scratch}/build-{uuid.uuid4().hex}"
    eid = Pipeline(spark, SF001).clean.orderBy("EVENT_ID").first().EVENT_ID
    broken = raw.withColumn("DEVICE_ID", F.when(F.col("EVENT_ID") == eid, F.lit("C999999"))
                            .otherwise(F.col("DEVICE_ID")))
    with pytest.raises(B.GateError):
        B.publish_common(broken, bad_out)
    import os
    assert not os.path.exists(f"{bad_out}/common")


def test_report_gate_requires_every_check():
    rows = [{"SCOPE": "NW01", "CHECK_NAME": c, "VIOLATIONS": 0} for c in B.STATION_CHECKS[:-1]]
    with pytest.raises(B.GateError):
        B.assert_all_passed(rows, {"NW01": B.STATION_CHECKS})



def test_publishing_rows_of_an_unknown_station_fails(spark, scratch):
    raw = Pipeline(spark, SF001).raw
    for station in ("NW09", None):
        odd = raw.withColumn("NETWORK_ID", F.when(F.col("EVENT_ID") == "E00000001", F.lit(station))
                             .otherwise(F.col("NETWORK_ID")))
        assert B.outside_stations(odd).count() == 1
    with pytest.raises(B.GateError, match="raw_network"):
        B.publish_common(odd, f"{scratch}/unknown-{uuid.uuid4().hex}")


def test_a_refused_build_reports_its_violations(spark, scratch):
    """A device outside the known numbers: nothing is published, every check has its row."""
    import duckdb
    from tvpulse.oracles.report import gate_sql
    from tvpulse.registry import QUERIES
    sf = f"{scratch}/refused-{uuid.uuid4().hex}"
    events = spark.read.parquet(f"{SF001}/events.parquet")
    odd = events.agg(F.min("user_id")).first()[0]
    events.withColumn("user_id", F.when(F.col("user_id") == odd, 30000).otherwise(F.col("user_id")).cast("bigint")) \
        .coalesce(1).write.parquet(f"{sf}/events.parquet")
    got = sorted(map(tuple, QUERIES["gate_report"](spark, sf).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf.removeprefix('file:')}/events.parquet/*.parquet')")
    assert got == sorted(con.execute(gate_sql()).fetchall())
    assert {check for check, _, n in got if n} == {"clean_device_id"}
    assert not {s for s in NETWORKS} - {scope for check, scope, n in got if n}


def test_minute_grain_counts_words_and_finds_every_repeat(nw01):
    keys = ["NETWORK_ID", "EVENT_ID", "MINUTE_AT"]
    minutes = nw01.minutes
    # within a word, over a word's end, thrice, off the minute, without a time
    odd = minutes.filter(F.substring("EVENT_ID", 8, 2) == "05")
    more = [minutes, odd.filter(F.minute("MINUTE_AT") % 7 == 0), odd.filter(F.minute("MINUTE_AT") % 14 == 0),
            odd.limit(3).withColumn("MINUTE_AT", F.lit(None).cast("timestamp_ntz")),
            odd.limit(2).withColumn("MINUTE_AT", F.timestamp_add("SECOND", F.lit(1), F.col("MINUTE_AT")))]
    faulty = more[0]
    for extra in more[1:]:
        faulty = faulty.unionByName(extra)
    want = sorted(map(str, Q.unique_grain(faulty, keys).collect()))
    assert want and sorted(map(str, Q.minute_grain(faulty).collect())) == want
    assert Q.minute_grain(minutes).count() == 0


def test_report_and_mart_shuffle_words_of_minutes(spark):
    """No aggregate of the minute rows is keyed by the minute itself, but behind the suspects' join."""
    p = Pipeline(spark, SF001)
    plan = p.audience_exploded._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" in plan and not any(line.strip().startswith(("Aggregate", "+- Aggregate")) and "MINUTE_AT#" in line.split("]")[0]
                                        for line in plan.splitlines())
    plan = B.station_checks(p.raw, p.clean, p.daily, p.minutes, p.audience)["minutes_grain"]._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "bit_or" in plan
