"""Money and ratio expressions."""

from __future__ import annotations


def money(amount: str) -> str:
    """Round half to even and store as whole currency units."""
    return f"cast(bround({amount}, 0) as bigint)"


def zero_padded(number: str, digits: int) -> str:
    """Number with leading zeros; longer numbers keep all their digits. Not negative."""
    return f"lpad(cast({number} as string), greatest({digits}, length(cast({number} as string))), '0')"


def ratio(numerator: str, denominator: str) -> str:
    """Double division that yields NULL for a zero denominator."""
    return f"(cast({numerator} as double) / nullif(cast({denominator} as double), 0d))"
