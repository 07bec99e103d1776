"""Validated dashboard scope, its predicate and previous period."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tvpulse.schemas import NETWORKS


class ScopeError(ValueError):
    """Raised before any plan is built when a scope is not usable."""


@dataclass(frozen=True)
class Scope:
    start: dt.date
    end: dt.date
    networks: tuple[str, ...]

    @classmethod
    def of(cls, start, end, networks=NETWORKS) -> "Scope":
        """Real dates, start <= end, at least one known station;
        stations deduplicated keeping their first order."""
        start, end = _as_date(start), _as_date(end)
        if start > end:
            raise ScopeError("start date must not be after end date")
        wanted = list(networks)
        unknown = sorted(set(map(str, wanted)).difference(NETWORKS))
        if unknown:
            raise ScopeError(f"unknown stations {unknown}; there are {', '.join(NETWORKS)}")
        if not wanted:
            raise ScopeError("at least one station is required")
        return cls(start, end, tuple(sorted(set(wanted), key=wanted.index)))

    def predicate(self, date_col: str = "VIEW_DATE", network_col: str = "NETWORK_ID") -> Column:
        """``date BETWEEN start AND end AND station IN (...)`` with literal
        binds, so the filter reaches the Parquet scan and partition pruning."""
        return (F.col(date_col).between(F.lit(self.start), F.lit(self.end))
                & F.col(network_col).isin(list(self.networks)))

    def apply(self, df: DataFrame) -> DataFrame:
        return df.filter(self.predicate())

    @property
    def days(self) -> int:
        return (self.end - self.start).days + 1

    def previous(self) -> "Scope":
        """The equal-length window ending the day before ``start``."""
        prev_end = self.start - dt.timedelta(days=1)
        return Scope(prev_end - dt.timedelta(days=self.days - 1), prev_end, self.networks)


def _as_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        raise ScopeError("dates, not timestamps, are required")
    if isinstance(value, dt.date):
        return value
    if isinstance(value, str):
        try:
            return dt.date.fromisoformat(value)
        except ValueError as exc:
            raise ScopeError(f"not a date: {value!r}") from exc
    raise ScopeError("start and end dates are required")
