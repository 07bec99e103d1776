"""Randomised equivalence of the scale paths against their plain definitions."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from tvpulse.operators import clean as C
from tvpulse.operators import marts as M
from tvpulse.operators.intervals import fold_intervals
from tvpulse.operators.sweep import minute_audience_sweep
from tvpulse.schemas import VIEWING_LOG

BASE = dt.datetime(2024, 3, 9, 20, 0, 0)


def random_intervals(seed: int, n: int = 400) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    # one hot device holds about a third of the rows
    dev = np.where(rng.random(n) < 0.35, 1, rng.integers(2, 8, n))
    start = rng.integers(0, 3 * 24 * 3600 * 10**6, n)          # three days, microseconds
    length = np.where(rng.random(n) < 0.1, rng.integers(3600 * 10**6, 86400 * 10**6 + 1, n),
                      rng.integers(1, 90 * 60 * 10**6, n))        # some span many hours / midnight
    length = np.where(rng.random(n) < 0.05, 60 * 10**6 - (start % (60 * 10**6)), length)  # end on a minute
    rows = []
    for i in range(n):
        f = BASE + dt.timedelta(microseconds=int(start[i]))
        rows.append((f"E{i:05d}", "NW0" + str(1 + i % 2), f"C{dev[i]:06d}", f,
                     f + dt.timedelta(microseconds=int(length[i])), ["NEWS", "DRAMA"][i % 3 == 0]))
    df = pd.DataFrame(rows, columns=["EVENT_ID", "NETWORK_ID", "DEVICE_ID", "VIEW_FROM", "VIEW_TO", "GENRE"])
    dup = df.sample(frac=0.05, random_state=seed)
    # same device, station, genre and start, another end (and event id)
    same_start = df.sample(frac=0.05, random_state=seed + 100).copy()
    same_start["EVENT_ID"] = same_start["EVENT_ID"] + "S"
    same_start["VIEW_TO"] = same_start["VIEW_FROM"] + pd.to_timedelta(
        rng.integers(1, 3 * 3600 * 10**6, len(same_start)), unit="us")
    return pd.concat([df, dup, same_start], ignore_index=True)


def plain_fold(pdf: pd.DataFrame) -> list:
    out = []
    for key, g in pdf.groupby(["DEVICE_ID", "NETWORK_ID", "GENRE"]):
        g = g.sort_values(["VIEW_FROM", "VIEW_TO", "EVENT_ID"])
        cur_start = cur_end = None
        count = 0
        for r in g.itertuples():
            if cur_end is None or r.VIEW_FROM > cur_end:
                if cur_end is not None:
                    out.append((*key, cur_start, cur_end, count))
                cur_start, cur_end, count = r.VIEW_FROM, r.VIEW_TO, 0
            cur_end = max(cur_end, r.VIEW_TO)
            count += 1
        out.append((*key, cur_start, cur_end, count))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_chunked_fold_equals_running_max_definition(spark, seed):
    pdf = random_intervals(seed)
    df = spark.createDataFrame(pdf, VIEWING_LOG)
    got = sorted((r.DEVICE_ID, r.NETWORK_ID, r.GENRE, r.VIEW_FROM, r.VIEW_TO, r.SOURCE_ROWS)
                 for r in fold_intervals(df).collect())
    assert got == plain_fold(pdf)


@pytest.mark.parametrize("seed", [4, 5])
def test_sweep_equals_explode_on_random_intervals(spark, seed):
    df = spark.createDataFrame(random_intervals(seed), VIEWING_LOG)
    clean = C.clean_viewing(df)
    a = M.minute_audience(M.viewing_minutes(clean))
    b = minute_audience_sweep(C.valid_intervals_filter(df))
    assert sorted(a.collect()) == sorted(b.collect())


def test_minute_floor_and_last_touched_minute_match_python(spark):
    from tvpulse.functions.time import last_touched_minute, minute_floor
    rng = np.random.default_rng(11)
    epoch = dt.datetime(1970, 1, 1)
    micros = rng.integers(-20 * 365 * 86400 * 10**6, 60 * 365 * 86400 * 10**6, 500)
    micros[:50] = (micros[:50] // 60_000_000) * 60_000_000          # exact minute boundaries
    ts = [epoch + dt.timedelta(microseconds=int(m)) for m in micros]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    got = df.select("t", minute_floor("t").alias("f"), last_touched_minute("t").alias("l")).collect()
    for r in got:
        assert r.f == r.t.replace(second=0, microsecond=0)
        before = r.t - dt.timedelta(microseconds=1)
        assert r.l == before.replace(second=0, microsecond=0)
