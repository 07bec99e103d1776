"""Shared CTE text for the DuckDB oracles."""

from __future__ import annotations

from tvpulse.functions.text import full_width
from tvpulse.schemas import GENRES

_UP = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_GENRE_CASE = "CASE event_id % 8 " + " ".join(f"WHEN {i} THEN '{g}'" for i, g in enumerate(GENRES)) + " END"
_PART_GENRE = "CASE p_partkey % 8 " + " ".join(f"WHEN {i} THEN '{g}'" for i, g in enumerate(GENRES)) + " END"
_MAP_WIDE = "CASE k " + " ".join(f"WHEN '{full_width(g)}' THEN '{g}'" for g in GENRES) + " ELSE k END"
TRIM_SET = "' ' || chr(9) || chr(13) || chr(10) || chr(12288)"

RAW = f"""
base AS (
  SELECT event_id, user_id, ts, (event_id * 7919) % 7200 + 1 AS dur_s,
         CASE WHEN user_id % 6 = 0 AND event_id % 3 <> 0 THEN 'DRAMA' ELSE {_GENRE_CASE} END AS g
  FROM events
), typed AS (
  SELECT 'E' || lpad(cast(event_id AS varchar), greatest(8, length(cast(event_id AS varchar)))::INTEGER, '0') AS EVENT_ID,
         'NW0' || cast(event_id % 5 + 1 AS varchar) AS NETWORK_ID,
         'C' || lpad(cast(user_id + 1 AS varchar), greatest(6, length(cast(user_id + 1 AS varchar)))::INTEGER, '0') AS DEVICE_ID,
         ts AS VIEW_FROM,
         CASE WHEN event_id % 101 = 7 THEN ts - INTERVAL '5' MINUTE
              WHEN event_id % 103 = 9 THEN ts + INTERVAL '86401' SECOND
              WHEN event_id % 499 = 3 THEN ts + INTERVAL '24' HOUR
              WHEN event_id % 211 = 5 THEN ts
              WHEN event_id % 11 = 0 THEN cast(date_trunc('minute', ts + INTERVAL '1' SECOND * dur_s) AS timestamp)
              ELSE ts + INTERVAL '1' SECOND * dur_s END AS VIEW_TO,
         CASE event_id % 13 WHEN 1 THEN lower(g) WHEN 2 THEN ' ' || g || '  '
              WHEN 3 THEN translate(g, '{_UP}', '{full_width(_UP)}')
              WHEN 4 THEN lower(translate(g, '{_UP}', '{full_width(_UP)}'))
              WHEN 5 THEN chr(12288) || g || chr(9) ELSE g END AS GENRE,
         event_id % 97 = 0 AS dup
  FROM base
), raw AS (
  SELECT EVENT_ID, NETWORK_ID, DEVICE_ID, VIEW_FROM, VIEW_TO, GENRE FROM typed
  UNION ALL
  SELECT EVENT_ID, NETWORK_ID, DEVICE_ID, VIEW_FROM, VIEW_TO, GENRE FROM typed WHERE dup
)"""

CLEAN = f"""
valid AS (
  SELECT DISTINCT EVENT_ID, NETWORK_ID, DEVICE_ID, VIEW_FROM, VIEW_TO, GENRE FROM raw
  WHERE VIEW_TO > VIEW_FROM AND datediff('microsecond', VIEW_FROM, VIEW_TO) <= 86400000000
), clean AS (
  SELECT EVENT_ID, NETWORK_ID, DEVICE_ID, VIEW_FROM, VIEW_TO, {_MAP_WIDE} AS GENRE,
         datediff('microsecond', VIEW_FROM, VIEW_TO)::DOUBLE / 60000000.0::DOUBLE AS VIEW_MINUTES
  FROM (SELECT *, upper(trim(GENRE, {TRIM_SET})) AS k FROM valid) n
)"""

DAILY = """
daily AS (
  SELECT NETWORK_ID, DEVICE_ID, cast(VIEW_FROM AS date) AS VIEW_DATE, GENRE,
         count(*)::INTEGER AS SESSION_COUNT,
         cast(sum(datediff('microsecond', VIEW_FROM, VIEW_TO)) AS BIGINT)::DOUBLE / 60000000.0::DOUBLE AS VIEW_MINUTES
  FROM clean GROUP BY ALL
)"""

MINUTES = """
minutes AS (
  SELECT EVENT_ID, NETWORK_ID, DEVICE_ID, m AS MINUTE_AT, cast(m AS date) AS VIEW_DATE
  FROM (SELECT EVENT_ID, NETWORK_ID, DEVICE_ID,
               unnest(generate_series(date_trunc('minute', VIEW_FROM),
                                      date_trunc('minute', VIEW_TO - INTERVAL '1' MICROSECOND),
                                      INTERVAL '1' MINUTE)) AS m
        FROM clean) x
)"""

AUDIENCE = """
audience AS (
  SELECT NETWORK_ID, VIEW_DATE, MINUTE_AT, count(DISTINCT DEVICE_ID)::INTEGER AS VIEWING_DEVICES
  FROM minutes GROUP BY ALL
)"""

LABELS = """
device_labels AS (
  SELECT 'C' || lpad(cast(user_id + 1 AS varchar), greatest(6, length(cast(user_id + 1 AS varchar)))::INTEGER, '0') AS DEVICE_ID,
         user_id % 2 = 0 AS LABEL_AVAILABLE,
         CASE WHEN user_id % 2 = 0 THEN cast(CASE WHEN user_id % 6 = 0 THEN 1 ELSE 0 END AS int) END AS TARGET_F1
  FROM (SELECT DISTINCT user_id FROM events) u
)"""

PREDICTIONS = """
predictions AS (
  SELECT DEVICE_ID, PROB_F1, CASE WHEN PROB_F1 >= 0.5 THEN 1 ELSE 0 END::INTEGER AS PREDICTED_HAS_F1,
         'TV_F1_PRESENCE_MODEL' AS MODEL_NAME, 'V1' AS MODEL_VERSION,
         cast('2024-02-01 00:00:00' AS timestamp) AS PREDICTED_AT,
         cast(0.5 AS double) AS PREDICTION_THRESHOLD, 'F1_SIGNAL_V2' AS DATASET_VERSION
  FROM (SELECT 'C' || lpad(cast(user_id + 1 AS varchar), greatest(6, length(cast(user_id + 1 AS varchar)))::INTEGER, '0') AS DEVICE_ID,
               cast((user_id * 37) % 101 AS double) / 100 AS PROB_F1
        FROM (SELECT DISTINCT user_id FROM events) u) x
)"""

PROGRAM_MASTER = f"""
program_master AS (
  SELECT 'P' || lpad(cast(p_partkey AS varchar), greatest(4, length(cast(p_partkey AS varchar)))::INTEGER, '0') AS PROGRAM_ID, p_name AS PROGRAM_NAME,
         'NW0' || cast(p_partkey % 5 + 1 AS varchar) AS NETWORK_ID, {_PART_GENRE} AS GENRE,
         CASE WHEN p_partkey % 60 < 20 THEN 'MORNING' WHEN p_partkey % 60 < 40 THEN 'DAY' ELSE 'PRIME' END AS TIME_SLOT,
         cast((p_partkey % 4 + 1) * 30 AS decimal(4,0)) AS DURATION_MIN, p_type AS SYNOPSIS
  FROM part
)"""

PROGRAM_SCHEDULE = """
program_schedule AS (
  SELECT 'P' || lpad(cast(p_partkey AS varchar), greatest(4, length(cast(p_partkey AS varchar)))::INTEGER, '0') AS PROGRAM_ID,
         'NW0' || cast(p_partkey % 5 + 1 AS varchar) AS NETWORK_ID, d AS AIR_DATE,
         cast(d AS timestamp) + INTERVAL '1' MINUTE * ((p_partkey % 60 - p_partkey % 5) * 24) AS AIR_FROM,
         cast(d AS timestamp) + INTERVAL '1' MINUTE * ((p_partkey % 60 - p_partkey % 5) * 24 + (p_partkey % 4 + 1) * 30) AS AIR_TO
  FROM part CROSS JOIN (SELECT DISTINCT cast(ts AS date) AS d FROM events) days
)"""

_ORDER = ["RAW", "CLEAN", "DAILY", "MINUTES", "AUDIENCE", "LABELS", "PREDICTIONS",
          "PROGRAM_MASTER", "PROGRAM_SCHEDULE"]
_TEXT = {"RAW": RAW, "CLEAN": CLEAN, "DAILY": DAILY, "MINUTES": MINUTES, "AUDIENCE": AUDIENCE,
         "LABELS": LABELS, "PREDICTIONS": PREDICTIONS, "PROGRAM_MASTER": PROGRAM_MASTER,
         "PROGRAM_SCHEDULE": PROGRAM_SCHEDULE}
_NEEDS = {"CLEAN": ["RAW"], "DAILY": ["CLEAN"], "MINUTES": ["CLEAN"], "AUDIENCE": ["MINUTES"]}


def with_ctes(*names: str, extra: str = "") -> str:
    """``WITH`` clause holding the named shared CTEs (and their inputs) plus
    any extra CTE text; the caller appends the final SELECT."""
    wanted: set[str] = set()

    def add(n):
        if n not in wanted:
            wanted.add(n)
            for d in _NEEDS.get(n, []):
                add(d)
    for n in names:
        add(n)
    parts = [_TEXT[n].strip() for n in _ORDER if n in wanted]
    if extra.strip():
        parts.append(extra.strip())
    return "WITH " + ",\n".join(parts) + "\n"
