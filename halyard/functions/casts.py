"""Casts that give null, not an error, for malformed values (ANSI mode stays on)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_date(c: Column | str) -> Column:
    return _col(c).cast("string").try_cast("date")


def to_timestamp(c: Column | str) -> Column:
    return _col(c).cast("string").try_cast("timestamp")


def to_double(c: Column | str) -> Column:
    return _col(c).cast("string").try_cast("double")


def to_decimal(c: Column | str, precision: int = 18, scale: int = 2) -> Column:
    return _col(c).cast("string").try_cast(f"decimal({precision},{scale})")


def to_bool(c: Column | str) -> Column:
    """0 and 1, or their words."""
    return _col(c).cast("string").try_cast("boolean")


def first_of(c: Column | str) -> Column:
    """First element; null for a null or empty array."""
    return F.get(_col(c), 0)
