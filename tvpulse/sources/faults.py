"""Seeded faults in the stages, so that every data-quality check has rows to find.

Each rule is fixed by the row's own numbers (event, device, minute of day), so
the same rows are faulty at any scale and in any engine. FIXTURES.md lists them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A prime of no rule of the test data, so that the faults meet every station, genre and day.
EVERY = 89


def _number(column: str) -> Column:
    return F.substring(column, 2, 20).cast("bigint")


def _repeated(df: DataFrame, drop: Column, twice: Column) -> DataFrame:
    """Rows of ``drop`` left out, rows of ``twice`` two times, in one pass."""
    copies = F.when(drop, F.array()).when(twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.select(*df.columns, F.explode(copies.cast("array<int>")).alias("_copy")).drop("_copy")


def _changed(df: DataFrame, rule: Column, changes: dict[str, dict[int, Column]]) -> DataFrame:
    new = {}
    for column, cases in changes.items():
        value = F.col(column)
        for code, changed in cases.items():
            value = F.when(rule == code, changed.cast(df.schema[column].dataType)).otherwise(value)
        new[column] = value
    return df.withColumns(new)


def clean(df: DataFrame) -> DataFrame:
    rule = _number("EVENT_ID") % EVERY
    plus = F.col("VIEW_MINUTES") + 0.5
    changed = _changed(df, rule, {
        "GENRE": {1: F.lit(None), 3: F.lit("QUIZ")}, "DEVICE_ID": {2: F.lit("X00001"), 6: F.lit("C099999")},
        "VIEW_TO": {4: F.col("VIEW_FROM")}, "VIEW_MINUTES": {4: F.lit(0.0), 5: plus}, "NETWORK_ID": {8: F.lit("NW09")}})
    return _repeated(changed, rule == 9, rule == 7)


def daily(df: DataFrame) -> DataFrame:
    rule = (_number("DEVICE_ID") * 31 + F.dayofmonth("VIEW_DATE")) % EVERY
    changed = _changed(df, rule, {"SESSION_COUNT": {2: F.col("SESSION_COUNT") + 1}, "VIEW_MINUTES": {4: F.lit(None)}})
    return _repeated(changed, rule == 3, rule == 1)


def minutes(df: DataFrame) -> DataFrame:
    rule = _number("EVENT_ID") % EVERY
    changed = _changed(df, rule, {"MINUTE_AT": {3: F.timestamp_add("SECOND", F.lit(1), F.col("MINUTE_AT"))},
                                  "VIEW_DATE": {4: F.date_add("VIEW_DATE", 1)}})
    return _repeated(changed, (rule == 5) | (rule == 1) & (F.minute("MINUTE_AT") % 2 == 0), rule == 2)


def audience(df: DataFrame) -> DataFrame:
    rule = (F.hour("MINUTE_AT") * 60 + F.minute("MINUTE_AT")) % EVERY
    changed = _changed(df, rule, {
        "VIEWING_DEVICES": {1: F.col("VIEWING_DEVICES") + 1, 2: F.lit(0), 5: F.lit(None)},
        "MINUTE_AT": {4: F.timestamp_add("SECOND", F.lit(30), F.col("MINUTE_AT"))}})
    return _repeated(changed, rule == 3, F.lit(False))


def predictions(df: DataFrame) -> DataFrame:
    rule = _number("DEVICE_ID") % 7
    return _changed(df, rule, {"DEVICE_ID": {1: F.lit("X00001"), 2: F.lit("C099999"), 3: F.lit(None)}})


def features(df: DataFrame) -> DataFrame:
    rule = _number("DEVICE_ID") % 7
    changed = _changed(df, rule, {"TOTAL_MINUTES": {1: F.lit(float("nan"))}, "MEAN_MINUTES": {2: F.lit(float("inf"))},
                                  "NEWS_SHARE": {3: F.lit(None)}})
    return _repeated(changed, F.lit(False), rule == 4)


def labels(df: DataFrame) -> DataFrame:
    rule = _number("DEVICE_ID") % 7
    changed = _changed(df, rule, {"TARGET_F1": {1: F.lit(2), 3: F.lit(None)}})
    return _repeated(changed, F.lit(False), rule == 6)
