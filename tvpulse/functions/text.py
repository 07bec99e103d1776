"""String normalisation and identifier checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tvpulse.schemas import DEVICE_ID_MAX, DEVICE_ID_MIN, DEVICE_NUMBER_MAX, GENRE_TRIM_CHARS, GENRES


def full_width(text: str) -> str:
    """ASCII letters to their full-width forms (U+FF21.. = 'A' + 0xFEE0)."""
    return "".join(chr(ord(c) + 0xFEE0) if "A" <= c <= "Z" or "a" <= c <= "z" else c for c in text)


def normalize_genre(genre="GENRE") -> Column:
    """Trim the fixed character set, upper-case, then map full-width codes.

    Order matters: upper first so full-width lower case is caught too;
    anything outside the eight codes passes through unchanged.
    """
    key = F.upper(F.btrim(F.col(genre) if isinstance(genre, str) else genre, F.lit(GENRE_TRIM_CHARS)))
    mapped = reduce(lambda acc, g: acc.when(key == F.lit(full_width(g)), F.lit(g)),
                    GENRES[1:], F.when(key == F.lit(full_width(GENRES[0])), F.lit(GENRES[0])))
    return mapped.otherwise(key)


def device_id_pattern_ok(c="DEVICE_ID") -> Column:
    """Whole-string match of ``C`` + six digits (no trailing newline)."""
    return (F.col(c) if isinstance(c, str) else c).rlike(r"\AC[0-9]{6}\z")


def device_id_invalid(c: str = "DEVICE_ID") -> Column:
    """NULL, not ``C`` + 6 digits, or number outside 1..20000."""
    col = F.col(c)
    number = F.expr(f"try_cast(substring(`{c}`, 2) AS BIGINT)")
    return col.isNull() | ~device_id_pattern_ok(col) | ~number.between(1, DEVICE_NUMBER_MAX)


def device_id_in_range(c="DEVICE_ID") -> Column:
    """String-range form used by the prediction checks."""
    col = F.col(c) if isinstance(c, str) else c
    return device_id_pattern_ok(col) & col.between(DEVICE_ID_MIN, DEVICE_ID_MAX)
