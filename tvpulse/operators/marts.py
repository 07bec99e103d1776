"""Device-by-day and minute-by-minute marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tvpulse.functions.time import epoch_micros, last_touched_minute, micros_between, minute_floor
from tvpulse.schemas import AUDIENCE_COLUMNS, DAILY_COLUMNS, MICROS_PER_MINUTE, MINUTE_COLUMNS


def device_daily(clean: DataFrame) -> DataFrame:
    """A1: sessions and minutes by station, device, start date, genre.

    The whole interval is booked on its start date and start genre. Minutes
    are summed as exact BIGINT microseconds and divided once, so the value is
    independent of summation order. Partial aggregation pre-combines a hot
    device map-side before the shuffle.
    """
    return (clean
            .groupBy("NETWORK_ID", "DEVICE_ID", F.to_date("VIEW_FROM").alias("VIEW_DATE"), "GENRE")
            .agg(F.count(F.lit(1)).cast("int").alias("SESSION_COUNT"),
                 (F.sum(micros_between("VIEW_FROM", "VIEW_TO")).cast("double")
                  / F.lit(float(MICROS_PER_MINUTE))).alias("VIEW_MINUTES"))
            .select(*DAILY_COLUMNS))


def viewing_minutes(clean: DataFrame) -> DataFrame:
    """One row per event and touched minute bucket (end exclusive).

    Each interval yields at most 1,441 rows; the list is generated inclusive
    from the first to the last touched minute, which is non-empty because
    clean intervals have positive length.
    """
    first = minute_floor("VIEW_FROM")
    last = last_touched_minute("VIEW_TO")
    minutes = clean.select(
        "EVENT_ID", "NETWORK_ID", "DEVICE_ID",
        F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MINUTE"))).alias("MINUTE_AT"))
    return minutes.withColumn("VIEW_DATE", F.to_date("MINUTE_AT")).select(*MINUTE_COLUMNS)


def minute_words(minutes: DataFrame) -> DataFrame:
    """Minute rows with their place in a 64-bit word: the word's number, the
    bit, and the microseconds by which the time misses the whole minute."""
    at = epoch_micros("MINUTE_AT")
    number = F.floor(at / MICROS_PER_MINUTE).cast("bigint")
    placed = minutes.withColumn("_n", number).withColumn("_off", F.pmod(at, F.lit(MICROS_PER_MINUTE)).cast("int"))
    return placed.withColumn("_word", F.floor(F.col("_n") / 64).cast("bigint")).withColumn(
        "_bit", F.expr("shiftleft(1L, CAST(pmod(_n, 64) AS INT))")).drop("_n")


def minute_audience(minutes: DataFrame) -> DataFrame:
    """Distinct devices per station, date and minute, in bit-vertical form.

    A device's minutes become bits of 64-minute words, or-ed map-side (which
    removes repeats); a word's 64 bit columns are then summed over devices, so
    neither step moves a row per device and minute. A minute without a known
    device counts none. Independent of the sweep."""
    keys = ["NETWORK_ID", "VIEW_DATE", "_word", "_off"]
    per_device = minute_words(minutes).groupBy(*keys, "DEVICE_ID").agg(F.bit_or("_bit").alias("bits"))
    known = F.when(F.col("DEVICE_ID").isNotNull(), F.col("bits"))
    counted = per_device.groupBy(*keys).agg(F.bit_or("bits").alias("seen"), *[
        F.sum(F.shiftrightunsigned(known, i).bitwiseAND(F.lit(1))).alias(f"_{i}") for i in range(64)])
    minute = counted.select(*keys, "seen", F.posexplode(F.array(*[F.coalesce(f"_{i}", F.lit(0)) for i in range(64)])).alias("_i", "_devices"))
    at = F.expr("timestampadd(MICROSECOND, _off, timestampadd(MINUTE, CAST(_word * 64 + _i AS INT), TIMESTAMP_NTZ'1970-01-01 00:00:00'))")
    return (minute.filter(F.col("seen").isNull() & (F.col("_i") == 0) | (F.expr("shiftrightunsigned(seen, _i) & 1") == 1))
            .select("NETWORK_ID", "VIEW_DATE", at.alias("MINUTE_AT"), F.col("_devices").cast("int").alias("VIEWING_DEVICES"))
            .select(*AUDIENCE_COLUMNS))


def union_marts(marts: list[DataFrame], columns: list[str]) -> DataFrame:
    """UNION ALL of same-shaped station marts, by column name."""
    return reduce(lambda a, b: a.unionByName(b), [m.select(*columns) for m in marts])


def common_viewing_daily(station_marts: list[DataFrame]) -> DataFrame:
    return union_marts(station_marts, DAILY_COLUMNS)


def common_minute_audience(station_marts: list[DataFrame]) -> DataFrame:
    return union_marts(station_marts, AUDIENCE_COLUMNS)


__all__ = ["device_daily", "viewing_minutes", "minute_words", "minute_audience", "union_marts", "common_viewing_daily",
           "common_minute_audience"]
