"""Data-quality checks. Each returns the violating rows; empty = pass.

Checks are plain DataFrame plans (aggregates and full outer joins on the
mart keys); nothing is collected except the per-check row counts of the
report. Three-valued logic follows the SQL definitions: a comparison with
NULL does not flag a row unless an explicit NULL test is part of the check.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tvpulse.functions.text import device_id_invalid, device_id_pattern_ok
from tvpulse.functions.time import last_touched_minute, micros_between, minute_floor, minutes_sum, view_minutes
from tvpulse.operators.clean import valid_interval
from tvpulse.operators.marts import minute_audience as recount, minute_words
from tvpulse.schemas import (DAILY_KEYS, DEVICE_ID_MAX, DEVICE_ID_MIN, MAX_INTERVAL_MICROS, MICROS_PER_MINUTE, NETWORKS,
                             RAW_COLUMNS)


def _any(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


def _tolerance_exceeded(a: Column, b: Column, scale: Column) -> Column:
    """|a - b| > max(1e-6, |scale| * 1e-9) (the reference's minute tolerance)."""
    return F.abs(a - b) > F.greatest(F.lit(0.000001), F.abs(scale) * F.lit(0.000000001))


def unique_grain(df: DataFrame, columns: list[str]) -> DataFrame:
    """Q1: key combinations holding more than one row (partial count per key)."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("ROW_COUNT")).filter("ROW_COUNT > 1")


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Q2: rows with a NULL in any required column."""
    return df.filter(_any([F.col(c).isNull() for c in columns]))


def unique(df: DataFrame, column: str, per: tuple[str, ...] = ("NETWORK_ID",)) -> DataFrame:
    """Q3: duplicated non-NULL values of one column within each station."""
    return unique_grain(df.filter(F.col(column).isNotNull()), [*per, column])


def accepted_values(df: DataFrame, column: str, values, per: tuple[str, ...] = ()) -> DataFrame:
    """Q4: values outside the accepted set with their row counts (NULL is not
    reported, as ``NOT IN`` with NULL is unknown), for each ``per`` key."""
    return (df.filter(~F.col(column).isin(list(values))).groupBy(*per, F.col(column).alias("VALUE_FIELD"))
            .agg(F.count(F.lit(1)).alias("N_RECORDS")))


def invalid_device_ids(df: DataFrame, column: str = "DEVICE_ID", keep: tuple[str, ...] = ()) -> DataFrame:
    """Q5: NULL, not ``C`` + 6 digits, or number outside 1..20000."""
    return df.select(*keep, column).filter(device_id_invalid(column))


def device_id_out_of_range(df: DataFrame, column: str = "DEVICE_ID") -> DataFrame:
    """Q6: string-range form ``BETWEEN 'C000001' AND 'C020000'`` with the pattern."""
    c = F.col(column)
    ok = device_id_pattern_ok(c) & c.between(DEVICE_ID_MIN, DEVICE_ID_MAX)
    return df.select(column).filter(~F.coalesce(ok, F.lit(False)))


def invalid_intervals(clean: DataFrame) -> DataFrame:
    """Q7: bad length, NULL times or minutes that disagree by more than 1e-9."""
    length = micros_between("VIEW_FROM", "VIEW_TO")
    bad = _any([
        F.col("VIEW_TO") <= F.col("VIEW_FROM"),
        length > MAX_INTERVAL_MICROS,
        F.col("VIEW_MINUTES") <= 0,
        F.abs(F.col("VIEW_MINUTES") - view_minutes()) > F.lit(0.000000001),
        F.col("VIEW_FROM").isNull(), F.col("VIEW_TO").isNull(), F.col("VIEW_MINUTES").isNull()])
    return clean.filter(bad).select("EVENT_ID", "NETWORK_ID", "DEVICE_ID", "VIEW_FROM", "VIEW_TO", "VIEW_MINUTES")


def _micros(minutes: str) -> Column:
    """Minutes back to whole microseconds: exact sums in any order."""
    return F.round(F.col(minutes) * F.lit(float(MICROS_PER_MINUTE))).cast("bigint")


def _apart(a: Column, b: Column) -> Column:
    """Microsecond totals that differ by more than the minute tolerance."""
    as_minutes = lambda c: c.cast("double") / F.lit(float(MICROS_PER_MINUTE))
    return _tolerance_exceeded(as_minutes(a), as_minutes(b), as_minutes(a))


def station_volume(raw: DataFrame, clean: DataFrame, daily: DataFrame, stations=NETWORKS) -> DataFrame:
    """Q8, J2 by station: valid raw rows vs clean vs daily totals, and every
    mart cell against its clean rows. One row per station in which anything
    disagrees or whose valid log is empty; a station without any row fails too.

    Clean rows and mart rows meet in one aggregate by the four keys (which also
    gives both totals), so a station's surplus can't cancel another's loss and
    no join is needed; the distinct raw rows are counted beside it."""
    none = F.lit(None).cast("bigint")
    keys = [F.to_date("VIEW_FROM").alias(k) if k == "VIEW_DATE" else F.col(k) for k in DAILY_KEYS]
    both = clean.select(*keys, F.lit(1).cast("bigint").alias("c_n"), _micros("VIEW_MINUTES").alias("c_u"), none.alias("d_n"),
                        none.alias("d_u"), F.lit(False).alias("mart")).unionByName(
        daily.select(*DAILY_KEYS, none.alias("c_n"), none.alias("c_u"), F.col("SESSION_COUNT").cast("bigint").alias("d_n"),
                     _micros("VIEW_MINUTES").alias("d_u"), F.lit(True).alias("mart")))
    cells = both.groupBy(*DAILY_KEYS).agg(
        *[F.sum(c).alias(c) for c in ("c_n", "c_u", "d_n", "d_u")], F.bool_and("mart").alias("only_mart"),
        F.bool_or("mart").alias("in_mart"), F.bool_or(F.col("mart") & (F.col("d_n").isNull() | F.col("d_u").isNull())).alias("holes"))
    # a NULL key never equals a key, so such a cell has no partner
    wrong = _any([F.col(k).isNull() for k in DAILY_KEYS]) | F.col("only_mart") | ~F.col("in_mart") | F.col("holes") | (
        F.col("c_n") != F.col("d_n")) | _apart(F.col("c_u"), F.col("d_u"))
    # a station's microseconds may pass 64 bits, a cell's can't
    total = lambda c: F.sum(F.col(c).cast("decimal(28,0)" if c.endswith("_u") else "bigint")).alias(c)
    measured = cells.groupBy("NETWORK_ID").agg(*[total(c) for c in ("c_n", "c_u", "d_n", "d_u")],
                                               F.count_if(wrong).alias("wrong"))
    valid = raw.filter(valid_interval()).select(*RAW_COLUMNS).dropDuplicates(RAW_COLUMNS)
    expected = valid.groupBy("NETWORK_ID").agg(F.count(F.lit(1)).alias("e_n"),
                                               F.sum(micros_between("VIEW_FROM", "VIEW_TO").cast("decimal(28,0)")).alias("e_u"))
    named = raw.sparkSession.createDataFrame([(s,) for s in stations], "NETWORK_ID string")  # at most a row per station
    parts = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [named, measured, expected])
    totals = parts.groupBy("NETWORK_ID").agg(*[F.coalesce(F.max(c), F.lit(0)).alias(c)
                                               for c in ("e_n", "c_n", "d_n", "e_u", "c_u", "d_u", "wrong")])
    disagree = _any([F.col("e_n") == 0, F.col("wrong") > 0, F.size(F.array_distinct(F.array("e_n", "c_n", "d_n"))) > 1,
                     _apart(F.col("e_u"), F.col("c_u")), _apart(F.col("c_u"), F.col("d_u"))])
    names = {"e": "EXPECTED", "c": "CLEAN", "d": "DAILY"}
    return totals.filter(disagree).select(
        "NETWORK_ID", *[F.col(f"{k}_n").alias(f"{n}_SESSIONS") for k, n in names.items()],
        *[(F.col(f"{k}_u").cast("double") / F.lit(float(MICROS_PER_MINUTE))).alias(f"{n}_MINUTES") for k, n in names.items()],
        F.col("wrong").alias("WRONG_CELLS"))


#: Groups of events that ``minute_grain`` tells apart.
GRAIN_BUCKETS = 1 << 16


def minute_grain(minutes: DataFrame) -> DataFrame:
    """Q1 on (NETWORK_ID, EVENT_ID, MINUTE_AT), without a row per minute shuffled.

    An event's 64-minute word repeats a minute if it has more rows than bits
    set. Rows are counted one by one only for events that share a bucket with
    such a word: none if nothing repeats, all of them at worst. The buckets are
    at most GRAIN_BUCKETS rows, which bounds their broadcast."""
    bucket = F.pmod(F.xxhash64("EVENT_ID"), F.lit(GRAIN_BUCKETS)).alias("_bucket")
    words = minute_words(minutes).groupBy("NETWORK_ID", "EVENT_ID", "_word", "_off").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_count(F.bit_or("_bit")), F.lit(1)).alias("distinct"))
    suspect = words.filter(F.col("n") > F.col("distinct")).select(bucket).distinct()
    rows = minutes.select("NETWORK_ID", "EVENT_ID", "MINUTE_AT", bucket).join(F.broadcast(suspect), "_bucket", "left_semi")
    return unique_grain(rows, ["NETWORK_ID", "EVENT_ID", "MINUTE_AT"])


def minute_expansion(clean: DataFrame, minutes: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per event, row count, distinct minutes, first and last minute and
    bad buckets of the stored minutes against the event's range.

    The distinct minutes are the set bits of the event's 64-minute words, which
    are or-ed map-side: at most 24 rows an event are shuffled, not its minutes.
    (Sums of minute numbers and of their squares would not do: 1, 5, 6 and
    2, 3, 7 agree in both.)"""
    first, last = minute_floor("VIEW_FROM"), last_touched_minute("VIEW_TO")
    event = ["EVENT_ID", "NETWORK_ID", "DEVICE_ID"]
    expected = clean.select(*event, (F.timestamp_diff("MINUTE", first, last) + 1).alias("EXPECTED_MINUTES"),
                            first.alias("_first"), last.alias("_last"))
    misplaced = F.coalesce((F.col("_off") == 0) & (F.col("VIEW_DATE") == F.to_date("MINUTE_AT")), F.lit(False))
    words = minute_words(minutes).groupBy(*event, "_word", "_off").agg(
        F.count(F.lit(1)).alias("n"), F.bit_or("_bit").alias("bits"), F.min("MINUTE_AT").alias("lo"), F.max("MINUTE_AT").alias("hi"),
        F.count_if(~misplaced).alias("bad"))
    actual = words.groupBy(*event).agg(
        F.sum("n").alias("ACTUAL_MINUTES"), F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).alias("DISTINCT_MINUTES"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("bad").alias("bad"))
    e, a = expected.alias("e"), actual.alias("a")
    joined = e.join(a, [F.col(f"e.{k}") == F.col(f"a.{k}") for k in event], "full")
    one_side = F.col("e.EVENT_ID").isNull() | F.col("a.EVENT_ID").isNull()
    # rows = distinct minutes = the range's minutes between the same ends: the minutes are the range's
    same = F.struct("e.EXPECTED_MINUTES", F.col("e.EXPECTED_MINUTES").alias("d"), "e._first", "e._last", F.lit(0).cast("bigint").alias("b")).eqNullSafe(
        F.struct(F.col("a.ACTUAL_MINUTES").alias("EXPECTED_MINUTES"), F.col("a.DISTINCT_MINUTES").alias("d"), F.col("a.lo").alias("_first"),
                 F.col("a.hi").alias("_last"), F.col("a.bad").alias("b")))
    return joined.filter(one_side | ~same).select(
        *[F.coalesce(f"e.{k}", f"a.{k}").alias(k) for k in keep], F.col("e.EVENT_ID").alias("EXPECTED_EVENT"), F.col("a.EVENT_ID").alias("ACTUAL_EVENT"),
        F.col("e.EXPECTED_MINUTES"), F.col("a.ACTUAL_MINUTES"), F.col("a.DISTINCT_MINUTES"))


def minute_audience_matches(minutes: DataFrame, audience: DataFrame) -> DataFrame:
    """Independent recount vs the mart: missing, extra, misaligned, non-positive."""
    keys = ["NETWORK_ID", "VIEW_DATE", "MINUTE_AT"]
    e, a = recount(minutes).alias("e"), audience.select(*keys, "VIEWING_DEVICES").alias("a")
    joined = e.join(a, [F.col(f"e.{k}") == F.col(f"a.{k}") for k in keys], "full")
    at, devices = F.col("a.MINUTE_AT"), F.col("a.VIEWING_DEVICES")
    right = reduce(lambda x, y: x & y, [F.col(f"{s}.{k}").isNotNull() for s in ("e", "a") for k in keys]) & (devices > 0) & (
        devices == F.col("e.VIEWING_DEVICES")) & (at == minute_floor(at)) & (F.to_date(at) == F.col("a.VIEW_DATE"))
    return joined.filter(~F.coalesce(right, F.lit(False))).select(
        F.coalesce("e.NETWORK_ID", "a.NETWORK_ID").alias("NETWORK_ID"), F.coalesce("e.MINUTE_AT", "a.MINUTE_AT").alias("MINUTE_AT"),
        F.col("e.VIEWING_DEVICES").alias("EXPECTED_DEVICES"), F.col("a.VIEWING_DEVICES").alias("ACTUAL_DEVICES"))


def _totals(df: DataFrame, kind: str) -> list[Column]:
    if kind == "daily":
        return [F.count(F.lit(1)).alias("ROW_COUNT"),
                F.coalesce(F.sum("SESSION_COUNT"), F.lit(0)).cast("bigint").alias("TOTAL_COUNT"),
                F.coalesce(minutes_sum("VIEW_MINUTES"), F.lit(0.0)).alias("TOTAL_MINUTES"),
                F.count(F.when(F.col("SESSION_COUNT").isNull() | F.col("VIEW_MINUTES").isNull(), 1))
                .alias("INVALID_ROWS")]
    v = F.col("VIEWING_DEVICES")
    return [F.count(F.lit(1)).alias("ROW_COUNT"),
            F.coalesce(F.sum(v), F.lit(0)).cast("bigint").alias("TOTAL_COUNT"),
            F.lit(0.0).alias("TOTAL_MINUTES"),
            F.count(F.when(v.isNull() | (v <= 0) | F.col("MINUTE_AT").isNull() | F.col("VIEW_DATE").isNull()
                           | (F.col("VIEW_DATE") != F.to_date("MINUTE_AT")), 1)).alias("INVALID_ROWS")]


def common_totals_match(station_marts: dict[str, DataFrame], common: DataFrame, kind: str) -> DataFrame:
    """Q11 (daily) / Q12 (minute): per-station rows and totals, station marts vs common.

    Each station mart gets a global aggregate labelled with its own station
    (so an empty mart still yields a 0-row line and fails), then a full outer
    join on the station id against the common mart grouped by station.
    """
    expected = reduce(DataFrame.unionByName, [
        mart.agg(*_totals(mart, kind)).select(F.lit(station).alias("NETWORK_ID"), "*")
        for station, mart in station_marts.items()])
    actual = common.groupBy("NETWORK_ID").agg(*_totals(common, kind))
    e, a = expected.alias("e"), actual.alias("a")
    return e.join(a, F.col("e.NETWORK_ID") == F.col("a.NETWORK_ID"), "full").filter(_any([
        F.col("e.NETWORK_ID").isNull(), F.col("a.NETWORK_ID").isNull(),
        F.col("e.ROW_COUNT") == 0, F.col("e.ROW_COUNT") != F.col("a.ROW_COUNT"),
        F.col("e.INVALID_ROWS") > 0, F.col("a.INVALID_ROWS") > 0,
        F.col("e.TOTAL_COUNT") != F.col("a.TOTAL_COUNT"),
        _tolerance_exceeded(F.col("e.TOTAL_MINUTES"), F.col("a.TOTAL_MINUTES"), F.col("e.TOTAL_MINUTES"))])).select(
        F.coalesce("e.NETWORK_ID", "a.NETWORK_ID").alias("NETWORK_ID"),
        F.col("e.ROW_COUNT").alias("EXPECTED_ROWS"), F.col("a.ROW_COUNT").alias("ACTUAL_ROWS"),
        F.col("e.TOTAL_COUNT").alias("EXPECTED_COUNT"), F.col("a.TOTAL_COUNT").alias("ACTUAL_COUNT"),
        F.col("e.TOTAL_MINUTES").alias("EXPECTED_MINUTES"), F.col("a.TOTAL_MINUTES").alias("ACTUAL_MINUTES"))


def label_coverage(labels: DataFrame, daily: DataFrame) -> DataFrame:
    """Full outer join of labels with observed devices; misses on each side."""
    observed = daily.select("DEVICE_ID").distinct().alias("o")
    lab = labels.select("DEVICE_ID").alias("l")
    joined = lab.join(observed, F.col("l.DEVICE_ID") == F.col("o.DEVICE_ID"), "full")
    return joined.agg(
        F.count(F.when(F.col("o.DEVICE_ID").isNull(), 1)).alias("LABEL_DEVICES_WITHOUT_OBSERVATIONS"),
        F.count(F.when(F.col("l.DEVICE_ID").isNull(), 1)).alias("OBSERVED_DEVICES_WITHOUT_LABEL_ROW"))


__all__ = ["unique_grain", "minute_grain", "not_null", "unique", "accepted_values", "invalid_device_ids",
           "device_id_out_of_range", "invalid_intervals", "station_volume", "minute_expansion",
           "recount", "minute_audience_matches", "common_totals_match", "label_coverage"]
