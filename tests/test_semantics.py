"""Edge semantics of cleaning, minute buckets, the sweep, folding and scope."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tvpulse.operators import clean as C
from tvpulse.operators import marts as M
from tvpulse.operators import metrics as K
from tvpulse.operators.intervals import fold_intervals, fold_totals, fold_with_totals
from tvpulse.operators.sweep import minute_audience_sweep
from tvpulse.plans.pipeline import Pipeline
from tvpulse.plans.scope import Scope, ScopeError
from tvpulse.schemas import VIEWING_LOG

from conftest import SF01, rows
from fixtures import fold_example

T = dt.datetime


def raw_df(spark, data):
    return spark.createDataFrame(data, VIEWING_LOG)


def test_minute_buckets_end_exclusive(spark):
    raw = raw_df(spark, [
        ("E1", "NW01", "C000001", T(2024, 1, 1, 8, 0, 50), T(2024, 1, 1, 8, 1, 10), "NEWS"),
        ("E2", "NW01", "C000002", T(2024, 1, 1, 8, 0, 0), T(2024, 1, 1, 8, 2, 0), "NEWS"),
    ])
    mins = M.viewing_minutes(C.clean_viewing(raw))
    got = {(r.EVENT_ID, r.MINUTE_AT.minute) for r in mins.collect()}
    assert got == {("E1", 0), ("E1", 1), ("E2", 0), ("E2", 1)}


def test_sweep_equals_explode_with_overlaps_midnight_and_copies(spark):
    raw = raw_df(spark, [
        ("E1", "NW01", "C000001", T(2024, 1, 1, 23, 58, 30), T(2024, 1, 2, 0, 2, 0), "NEWS"),
        ("E2", "NW01", "C000001", T(2024, 1, 1, 23, 59, 0), T(2024, 1, 1, 23, 59, 1), "NEWS"),
        ("E3", "NW01", "C000001", T(2024, 1, 2, 0, 2, 0), T(2024, 1, 2, 0, 3, 0), "NEWS"),
        ("E4", "NW01", "C000002", T(2024, 1, 1, 23, 0, 0), T(2024, 1, 2, 23, 0, 0), "DRAMA"),
        ("E4", "NW01", "C000002", T(2024, 1, 1, 23, 0, 0), T(2024, 1, 2, 23, 0, 0), "DRAMA"),
        ("E5", "NW02", "C000001", T(2024, 1, 1, 10, 0, 0), T(2024, 1, 1, 10, 0, 0, 1), "NEWS"),
    ])
    clean = C.clean_viewing(raw)
    a = M.minute_audience(M.viewing_minutes(clean))
    b = minute_audience_sweep(C.valid_intervals_filter(raw))
    assert rows(a) == rows(b)
    assert a.count() > 1400


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
def test_minute_marts_are_zone_independent(spark, zone):
    p = Pipeline(spark, SF01)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    base = rows(p.audience)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert rows(Pipeline(spark, SF01).audience) == base
        assert rows(Pipeline(spark, SF01).audience_exploded) == base
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_validity_bounds_and_dedupe_before_normalisation(spark):
    t0 = T(2024, 1, 1, 8)
    raw = raw_df(spark, [
        ("A", "NW01", "C000001", t0, t0 + dt.timedelta(hours=24), "news"),
        ("B", "NW01", "C000001", t0, t0 + dt.timedelta(hours=24, microseconds=1), "NEWS"),
        ("C", "NW01", "C000001", t0, t0, "NEWS"),
        ("D", "NW01", "C000001", t0, t0 - dt.timedelta(minutes=1), "NEWS"),
        ("E", "NW01", "C000001", t0, t0 + dt.timedelta(minutes=1), "NEWS"),
        ("E", "NW01", "C000001", t0, t0 + dt.timedelta(minutes=1), "news"),
        ("F", "NW01", "C000001", t0, t0 + dt.timedelta(minutes=1), "　ｓｐｏｒｔｓ\t"),
        ("G", "NW01", "C000001", t0, t0 + dt.timedelta(minutes=1), " QUIZ "),
    ])
    clean = C.clean_viewing(raw)
    got = sorted((r.EVENT_ID, r.GENRE) for r in clean.collect())
    assert got == [("A", "NEWS"), ("E", "NEWS"), ("E", "NEWS"), ("F", "SPORTS"), ("G", "QUIZ")]
    rep = dict((r.REASON, r.ROW_COUNT) for r in C.rejects_report(raw).collect())
    assert rep == {"MISSING_TIME": 0, "REVERSED": 1, "ZERO_LENGTH": 1, "OVER_24H": 1, "DUPLICATE": 0, "KEPT": 5}


def test_daily_books_whole_interval_on_start_date(spark):
    raw = raw_df(spark, [("A", "NW01", "C000001", T(2024, 1, 1, 23, 0), T(2024, 1, 2, 1, 0), "NEWS")])
    d = M.device_daily(C.clean_viewing(raw)).collect()
    assert [(r.VIEW_DATE, r.SESSION_COUNT, r.VIEW_MINUTES) for r in d] == [(dt.date(2024, 1, 1), 1, 120.0)]


def test_fold_worked_example(spark):
    folded = fold_intervals(fold_example(spark))
    assert sorted(r.SOURCE_ROWS for r in folded.collect()) == [1, 2, 4]
    t = fold_totals(folded).first()
    assert (t.INPUT_ROWS, t.FOLDED_ROWS) == (7, 3)


def test_fold_totals_stand_on_every_row_without_a_single_task(spark, scratch):
    import uuid
    whole = fold_with_totals(fold_intervals(fold_example(spark)), f"{scratch}/fold-{uuid.uuid4().hex}")
    assert {(r.INPUT_ROWS, r.FOLDED_ROWS) for r in whole.collect()} == {(7, 3)} and whole.count() == 3
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan and "Exchange" not in plan
    none = fold_with_totals(fold_intervals(fold_example(spark).limit(0)), f"{scratch}/fold-{uuid.uuid4().hex}")
    assert none.count() == 0


def test_fold_carries_across_hour_chunks(spark):
    raw = raw_df(spark, [
        ("1", "NW01", "C1", T(2024, 1, 1, 8, 0), T(2024, 1, 1, 12, 0), "NEWS"),
        ("2", "NW01", "C1", T(2024, 1, 1, 10, 30), T(2024, 1, 1, 10, 40), "NEWS"),
        ("3", "NW01", "C1", T(2024, 1, 1, 12, 0), T(2024, 1, 1, 12, 5), "NEWS"),
        ("4", "NW01", "C1", T(2024, 1, 1, 12, 6), T(2024, 1, 1, 12, 7), "NEWS"),
    ])
    got = sorted((r.VIEW_FROM.hour, r.VIEW_TO.minute, r.SOURCE_ROWS) for r in fold_intervals(raw).collect())
    assert got == [(8, 5, 3), (12, 7, 1)]


def test_reach_is_not_additive(spark):
    daily = Pipeline(spark, SF01).daily
    total = K.kpi(daily).first().DISTINCT_REACH
    by_station = sum(r.DISTINCT_REACH for r in K.kpi(daily, "NETWORK_ID").collect())
    assert by_station > total


def test_scope_validation_binds_and_previous_period():
    s = Scope.of("2026-05-01", "2026-05-07", ["NW01", "NW02", "NW01"])
    assert s.networks == ("NW01", "NW02")
    with pytest.raises(ScopeError):
        Scope.of("2026-05-01", "2026-05-07", ["NW01", "BAD"])
    with pytest.raises(ScopeError):
        Scope.of("2026-05-08", "2026-05-01")
    with pytest.raises(ScopeError):
        Scope.of("2026-02-30", "2026-05-01")
    p = Scope.of("2026-05-08", "2026-05-14", ["NW01"]).previous()
    assert (p.start, p.end) == (dt.date(2026, 5, 1), dt.date(2026, 5, 7))


def test_scope_predicate_reaches_the_plan_as_literals(spark):
    s = Scope.of("2024-01-08", "2024-01-14", ["NW01", "NW02"])
    plan = s.apply(Pipeline(spark, SF01).daily)._jdf.queryExecution().optimizedPlan().toString()
    assert "2024-01-08" in plan and "NW02" in plan


def test_summary_gate_and_empty_scope(spark):
    from tvpulse.plans.dashboards import dash_summary
    daily = Pipeline(spark, SF01).daily
    first = dash_summary(daily, Scope.of("2024-01-01", "2024-01-07")).first()
    assert first.PREV_DISTINCT_REACH is None and first.DELTA_DISTINCT_REACH is None
    empty = K.kpi(Scope.of("2030-01-01", "2030-01-02").apply(daily)).first()
    assert (empty.DISTINCT_REACH, empty.TOTAL_MINUTES, empty.TOTAL_SESSIONS) == (0, 0.0, 0)


def test_calendar_keeps_missing_days_null(spark):
    daily = Pipeline(spark, SF01).daily
    cal = K.calendar_reindex(K.kpi(daily, "VIEW_DATE"), "2024-01-29", "2024-02-02").orderBy("VIEW_DATE").collect()
    assert len(cal) == 5 and cal[-1].DISTINCT_REACH is None and cal[0].DISTINCT_REACH is not None


def test_probability_bins(spark):
    from tvpulse.operators.predictions import probability_bin
    df = spark.createDataFrame([(0.0,), (0.05,), (0.1,), (0.99,), (1.0,), (1.2,), (float("nan"),)], "p double")
    got = [r.b for r in df.select(probability_bin(F.col("p")).alias("b")).collect()]
    assert got == [0, 0, 1, 9, 9, None, None]


def test_union_of_station_marts_equals_the_grouped_pass(spark):
    from tvpulse.schemas import NETWORKS
    p = Pipeline(spark, SF01)
    stations = [M.device_daily(C.clean_viewing(p.station_raw(s))) for s in NETWORKS]
    assert rows(M.common_viewing_daily(stations)) == rows(p.daily)
    aud = [minute_audience_sweep(C.valid_intervals_filter(p.station_raw(s))) for s in NETWORKS]
    assert rows(M.common_minute_audience(aud)) == rows(p.audience)


def test_metric_view_synonyms_refusal_describe_and_empty_scope(spark):
    from tvpulse.plans import semantic as S
    view = S.viewing_metric_view(Pipeline(spark, SF01).daily)
    assert view.metric("リーチ").name == "distinct_reach" and view.dimension("局").column == "NETWORK_ID"
    with pytest.raises(S.MetricViewError):
        view.metric("viewers")
    assert view.describe(spark).count() == 6
    empty = view.ask(["total_minutes"], scope=Scope.of("2030-01-01", "2030-01-31"))
    assert empty.count() == 0
    total = view.ask(["リーチ"], default_scope=Scope.of("2024-01-01", "2024-01-31")).first()
    assert total.DISTINCT_REACH == K.kpi(Pipeline(spark, SF01).daily).first().DISTINCT_REACH


def test_grouping_sets_dashboard_equals_the_four_kpi_groupings(spark):
    from tvpulse.plans.dashboards import TRENDS, dash_trends
    scope = Scope.of("2024-01-10", "2024-01-20", ["NW01", "NW03"])
    daily = Pipeline(spark, SF01).daily
    trends = dash_trends(daily, scope)
    assert len(TRENDS) == 4
    for dims in TRENDS:
        view = "_".join(K.DIMENSIONS[d] for d in dims)
        got = rows(trends.filter(F.col("TREND_VIEW") == view), *dims, "DISTINCT_REACH", "TOTAL_MINUTES",
                   "TOTAL_SESSIONS")
        want = rows(K.kpi(scope.apply(daily), *dims), *dims, "DISTINCT_REACH", "TOTAL_MINUTES", "TOTAL_SESSIONS")
        assert got == want


def test_minute_dashboard_is_one_exchange_and_equals_its_parts(spark):
    from tvpulse.plans import dashboards as D
    stations = ("NW05", "NW01", "NW03")
    mart = Pipeline(spark, SF01).audience
    view = D.dash_minute(mart, "2024-01-15", stations)
    scoped = D.minute_scope(mart, "2024-01-15", stations)
    part = lambda v: view.filter(F.col("MINUTE_VIEW") == v)
    assert rows(part("series"), "NETWORK_ID", "MINUTE_AT", "VIEWING_DEVICES") == rows(scoped, "NETWORK_ID", "MINUTE_AT", "VIEWING_DEVICES")
    peaks = K.minute_peaks(scoped)
    assert rows(part("peak"), "NETWORK_ID", "MINUTE_AT", "VIEWING_DEVICES") == rows(peaks)
    assert rows(part("peak").filter("IS_TOP_PEAK"), "NETWORK_ID") == rows(K.minute_top_peak(peaks), "NETWORK_ID")
    wide = ["MINUTE_AT", "NW01", "NW02", "NW03", "NW04", "NW05"]
    assert sorted(map(str, part("pivot").select(*wide).collect())) == sorted(map(str, K.minute_pivot(scoped).select(*wide).collect()))
    assert D.dash_minute(mart, "2031-01-01", stations).count() == 0


def test_minute_dashboard_ties_and_plan(spark):
    from tvpulse.plans import dashboards as D
    at = lambda m: T(2024, 1, 15, 10, m)
    mart = spark.createDataFrame([("NW03", dt.date(2024, 1, 15), at(1), 5), ("NW03", dt.date(2024, 1, 15), at(2), 5),
                                  ("NW01", dt.date(2024, 1, 15), at(2), 5), ("NW01", dt.date(2024, 1, 15), at(1), 4),
                                  ("NW02", dt.date(2024, 1, 15), at(1), 9)],
                                 "NETWORK_ID string, VIEW_DATE date, MINUTE_AT timestamp_ntz, VIEWING_DEVICES int")
    view = D.dash_minute(mart, "2024-01-15", ("NW03", "NW01"))
    peaks = {(r.NETWORK_ID, r.MINUTE_AT.minute, r.IS_TOP_PEAK) for r in view.filter("MINUTE_VIEW = 'peak'").collect()}
    assert peaks == {("NW03", 1, False), ("NW01", 2, True)}
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(VIEW_DATE" in plan


def test_calendar_fill_keeps_missing_days_null(spark):
    days = [dt.date(2024, 1, 3), dt.date(2024, 1, 1), dt.date(2024, 1, 7)]
    kpi = spark.createDataFrame([(d, d.day) for d in days], "VIEW_DATE date, DISTINCT_REACH int")
    got = {r.VIEW_DATE.day: r.DISTINCT_REACH for r in K.calendar_fill(kpi).collect()}
    assert got == {1: 1, 2: None, 3: 3, 4: None, 5: None, 6: None, 7: 7}
    assert K.calendar_fill(kpi.limit(0)).count() == 0
