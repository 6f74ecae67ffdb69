"""Date and time expressions on zone-less timestamps."""

from __future__ import annotations


def date_key(ts: str) -> str:
    """``YYYYMMDD`` as int; NULL stays NULL."""
    return f"(year({ts}) * 10000 + month({ts}) * 100 + dayofmonth({ts}))"


def minute_key(ts: str) -> str:
    """Minute of the day, 0..1439."""
    return f"(hour({ts}) * 60 + minute({ts}))"


def _seconds(start: str, end: str) -> str:
    # Subtracting zone-less timestamps never consults the session zone, unlike timestampdiff.
    return f"cast(cast({end} - {start} as interval second) as decimal(20,6))"


def minutes_between(start: str, end: str) -> str:
    """Minutes from start to end as double with the sub-minute part; NULL when either is NULL."""
    return f"(cast({_seconds(start, end)} as double) / 60d)"


def whole_days_between(start: str, end: str) -> str:
    """Whole elapsed days, rounded down."""
    return f"cast(floor({_seconds(start, end)} / 86400) as int)"


def completed_years(birth: str, as_of: str) -> str:
    """Birthdays passed by ``as_of``; 29 February counts from 1 March in common years."""
    early = f"month({as_of}) * 100 + dayofmonth({as_of}) < month({birth}) * 100 + dayofmonth({birth})"
    return f"(year({as_of}) - year({birth}) - if({early}, 1, 0))"


def padded_name(day: str, pattern: str) -> str:
    """English month or day name, blank-padded to nine characters."""
    return f"rpad(date_format({day}, '{pattern}'), 9, ' ')"
