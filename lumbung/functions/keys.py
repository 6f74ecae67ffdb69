"""Hashed surrogate keys."""

from __future__ import annotations

# Separator and NULL marker must agree with keys already stored.
SEPARATOR = "||"
NULL_MARK = "_dbt_null_"


def surrogate_key(*columns: str) -> str:
    """md5 over the text form of one or more columns; NULL has its own marker."""
    parts = [f"coalesce(cast({c} as string), '{NULL_MARK}')" for c in columns]
    return f"md5(concat_ws('{SEPARATOR}', {', '.join(parts)}))"
