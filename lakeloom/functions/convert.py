"""Text and type conversions of the cleaning recipes.

Every conversion takes ``strict``. Lenient (the default) turns text that does
not parse into null, so that a required-column filter can drop and count the
row; strict raises, which is what an ANSI cast does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _convert(column: Column, to: str, strict: bool) -> Column:
    return column.cast(to) if strict else column.try_cast(to)


def as_date(column: Column, strict: bool = False) -> Column:
    return _convert(column, "date", strict)


def as_timestamp(column: Column, strict: bool = False) -> Column:
    """Zone-less timestamp: the same wall clock whatever the session zone."""
    return _convert(column, "timestamp_ntz", strict)


def as_money(column: Column, strict: bool = False) -> Column:
    """Two decimals, half up."""
    return _convert(column, "decimal(12,2)", strict)


def trimmed(column: Column, strict: bool = False) -> Column:
    """Strip spaces (only spaces: tabs stay)."""
    return F.trim(column)


def title_case(column: Column, strict: bool = False) -> Column:
    """Strip spaces and capitalise each space-separated word."""
    return F.initcap(F.trim(column))
