"""Zone-free time arithmetic on TIMESTAMP_NTZ columns.

``date_trunc`` returns a session-zone TIMESTAMP, which shifts minute buckets on
daylight-saving nights; everything here stays in NTZ microsecond arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tvpulse.schemas import MICROS_PER_MINUTE

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros_between(start, end) -> Column:
    """Exact elapsed microseconds ``end - start`` as BIGINT."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end))


def epoch_micros(ts) -> Column:
    """Microseconds of a wall-clock time since 1970-01-01, whatever the zone."""
    return micros_between(F.expr(_EPOCH), ts)


def minute_floor(ts) -> Column:
    """Truncate an NTZ timestamp to its minute without leaving NTZ."""
    ts = _col(ts)
    offset = F.pmod(epoch_micros(ts), F.lit(MICROS_PER_MINUTE))
    return F.timestamp_add("MICROSECOND", -offset, ts)


def add_micros(ts, micros) -> Column:
    return F.timestamp_add("MICROSECOND", _col(micros) if not isinstance(micros, int) else F.lit(micros), _col(ts))


def add_minutes(ts, minutes) -> Column:
    return F.timestamp_add("MINUTE", _col(minutes) if not isinstance(minutes, int) else F.lit(minutes), _col(ts))


def view_minutes(start="VIEW_FROM", end="VIEW_TO") -> Column:
    """Exact elapsed minutes as DOUBLE (microseconds / 6e7, one division)."""
    return micros_between(start, end).cast("double") / F.lit(float(MICROS_PER_MINUTE))


def last_touched_minute(end="VIEW_TO") -> Column:
    """Minute bucket of the last instant before an exclusive end."""
    return minute_floor(add_micros(end, -1))


def minutes_to_micros(c="VIEW_MINUTES") -> Column:
    """Integer microseconds of a minutes column as DECIMAL(28,0).

    Minute values are microsecond counts / 6e7, so each converts back exactly."""
    return F.round(_col(c) * F.lit(float(MICROS_PER_MINUTE))).cast("decimal(28,0)")


def micros_sum(micros) -> Column:
    """Minutes in the sum of a ``minutes_to_micros`` column.

    Summing as DECIMAL(38,0), which can't overflow, and dividing once gives the
    same double on every engine and every partitioning (a DOUBLE sum does not).
    """
    return F.sum(_col(micros)).cast("double") / F.lit(float(MICROS_PER_MINUTE))


def minutes_sum(c="VIEW_MINUTES") -> Column:
    """Exact, order-independent sum of a minutes column."""
    return micros_sum(minutes_to_micros(c))
