"""The seeded faults of the data-quality checks as common table expressions."""

from __future__ import annotations

#: As in the Spark rules: every 89th row by its own number.
EVERY = 89
_EVENT = f"cast(substring(EVENT_ID, 2) AS BIGINT) % {EVERY}"
_DEVICE = "cast(substring(DEVICE_ID, 2) AS BIGINT)"
_SEVENTH = f"{_DEVICE} % 7"


def _faulty(name: str, rule: str, changes: dict[str, dict[int, str]], drop: str = "false", twice: str = "false") -> str:
    replaced = ", ".join(f"CASE r {' '.join(f'WHEN {k} THEN {v}' for k, v in cases.items())} ELSE {c} END AS {c}"
                         for c, cases in changes.items())
    replace = f" REPLACE ({replaced})" if replaced else ""
    return f"""
{name}_ruled AS (SELECT *, {rule} AS r FROM {name}),
{name}_f AS (
  SELECT * EXCLUDE (r){replace} FROM {name}_ruled WHERE NOT ({drop})
  UNION ALL
  SELECT * EXCLUDE (r){replace} FROM {name}_ruled WHERE {twice} AND NOT ({drop}))"""


FAULTY = {
    "clean": _faulty("clean", _EVENT, {
        "GENRE": {1: "NULL", 3: "'QUIZ'"}, "DEVICE_ID": {2: "'X00001'", 6: "'C099999'"}, "VIEW_TO": {4: "VIEW_FROM"},
        "VIEW_MINUTES": {4: "0.0::DOUBLE", 5: "VIEW_MINUTES + 0.5::DOUBLE"}, "NETWORK_ID": {8: "'NW09'"}}, "r = 9", "r = 7"),
    "daily": _faulty("daily", f"({_DEVICE} * 31 + day(VIEW_DATE)) % {EVERY}", {
        "SESSION_COUNT": {2: "SESSION_COUNT + 1"}, "VIEW_MINUTES": {4: "NULL"}}, "r = 3", "r = 1"),
    "minutes": _faulty("minutes", _EVENT, {
        "MINUTE_AT": {3: "MINUTE_AT + INTERVAL 1 SECOND"}, "VIEW_DATE": {4: "cast(VIEW_DATE + INTERVAL 1 DAY AS date)"}},
        "r = 5 OR r = 1 AND minute(MINUTE_AT) % 2 = 0", "r = 2"),
    "audience": _faulty("audience", f"(hour(MINUTE_AT) * 60 + minute(MINUTE_AT)) % {EVERY}", {
        "VIEWING_DEVICES": {1: "VIEWING_DEVICES + 1", 2: "0", 5: "NULL"}, "MINUTE_AT": {4: "MINUTE_AT + INTERVAL 30 SECOND"}}, "r = 3"),
    "predictions": _faulty("predictions", _SEVENTH, {"DEVICE_ID": {1: "'X00001'", 2: "'C099999'", 3: "NULL"}}),
    "features": _faulty("features", _SEVENTH, {"TOTAL_MINUTES": {1: "'NaN'::DOUBLE"}, "MEAN_MINUTES": {2: "'inf'::DOUBLE"},
                                               "NEWS_SHARE": {3: "NULL"}}, twice="r = 4"),
    "device_labels": _faulty("device_labels", _SEVENTH, {"TARGET_F1": {1: "2", 3: "NULL"}}, twice="r = 6"),
}
