"""Casts between envelope text and column types, as SQL text. None of them throws."""

from __future__ import annotations


def to_long(text: str) -> str:
    return f"try_cast({text} AS BIGINT)"


def to_money(value: str) -> str:
    """Rounds half up to two places; NULL when not a number or out of range."""
    return f"try_cast({value} AS DECIMAL(12, 2))"


def cut_to_millis(instant: str) -> str:
    return f"date_trunc('MILLISECOND', {instant})"


def to_instant(text: str) -> str:
    """ISO-8601 text with a zone to an instant, cut to milliseconds."""
    return cut_to_millis(f"try_cast({text} AS TIMESTAMP)")


def wall_clock(instant: str) -> str:
    """An instant as zone-less session time."""
    return f"CAST({instant} AS TIMESTAMP_NTZ)"


def iso_text(moment: str, zone: str = "") -> str:
    """ISO text cut to milliseconds, with an optional zone suffix."""
    return f"""date_format({moment}, "yyyy-MM-dd'T'HH:mm:ss.SSS{f"'{zone}'" if zone else ''}")"""


def canonical_text(value: str, dtype: str) -> str:
    """One spelling per value: moments and days in ISO form, decimals with all their places."""
    if dtype.startswith("timestamp"):
        return iso_text(value)
    if dtype == "date":
        return f"date_format({value}, 'yyyy-MM-dd')"
    return f"CAST({value} AS STRING)"
