"""Golden counts measured for the fixtures (FIXTURES.md section 3)."""

from pyspark.sql import functions as F

from tvpulse.operators.intervals import fold_intervals
from tvpulse.plans.pipeline import Pipeline
from tvpulse.schemas import NETWORKS

from conftest import SF01


def test_sf001_golden_counts(spark):
    p = Pipeline(spark, SF01)
    assert p.raw.count() == 10104
    per_station = {r.NETWORK_ID: r["count"] for r in p.raw.groupBy("NETWORK_ID").count().collect()}
    assert [per_station[n] for n in NETWORKS] == [2021, 2021, 2021, 2020, 2021]
    assert p.clean.count() == 9752
    assert p.daily.count() == 9382
    assert p.minutes.count() == 623756
    assert p.audience.count() == 216457
    assert p.audience.agg(F.max("VIEWING_DEVICES")).first()[0] == 8
    assert fold_intervals(p.clean).count() == 9737
    assert p.daily.select("DEVICE_ID").distinct().count() == 150
    assert p.daily.select("VIEW_DATE").distinct().count() == 30
    labels = {r.TARGET_F1: r["count"] for r in p.labels.groupBy("TARGET_F1").count().collect()}
    assert labels == {1: 25, 0: 50, None: 75}
    assert p.split.filter("SPLIT = 'test'").count() == 15


def test_sf01_clean_and_audience_counts(spark):
    p = Pipeline(spark, SF01.replace("sf0.01", "sf0.1"))
    assert p.clean.count() == 97544
    assert p.minutes.count() == 6220918
    assert p.audience.count() == 220644
