"""Column-level helpers (JVM-side expressions only, no Python UDFs)."""

from tvpulse.functions.text import device_id_invalid, device_id_pattern_ok, normalize_genre  # noqa: F401
from tvpulse.functions.time import micros_between, minute_floor, view_minutes  # noqa: F401
from tvpulse.functions.ranking import cumulative_before, log_bucket  # noqa: F401
from tvpulse.functions.time import minutes_sum  # noqa: F401
