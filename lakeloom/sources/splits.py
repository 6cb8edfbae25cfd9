"""Splits of a source table that hold about the same number of rows each.

Bounds of equal width leave most rows to a few readers where a key has gaps or a
dense span. Here they are quantiles, taken by a sketch of the column in the last
bronze copy: as many values as there are splits, however large the table. They
become conditions for the database, one for each reader. Every row meets exactly
one of them, also rows that came since the copy: the outer splits have no outer
bound, and rows without a value have a split of their own. All rows of one value
are in one split, so a value on more rows than a split's share makes a larger one.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Bound = int | float | Decimal | date | datetime


def equi_depth(df: DataFrame, column: str, parts: int, accuracy: int = 10_000) -> list[Bound]:
    """At most ``parts`` - 1 ascending bounds of a numeric, date or time column; none for a table without values.

    accuracy: of the sketch, whose ranks are right within rows / accuracy.
    """
    if parts < 1:
        raise ValueError(f"{parts} splits")
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        return []
    found = df.agg(F.percentile_approx(column, shares, accuracy)).first()[0] or []
    # a bound that is on many rows comes several times
    return sorted(set(found))


def literal(value: Bound) -> str:
    """A bound as standard SQL has it."""
    match value:
        case bool():
            raise TypeError("a truth value is no bound")
        case int() | Decimal():
            return str(value)
        case float():
            return repr(value)
        case datetime():
            if value.tzinfo:
                raise TypeError("a bound with a time zone depends on the database's")
            return f"'{value.isoformat(sep=' ')}'"
        case date():
            return f"'{value.isoformat()}'"
    raise TypeError(f"no bound: {value!r}")


def predicates(column: str, bounds: Sequence[Bound]) -> list[str]:
    """Conditions of which every row meets one: below the first bound, between two, from the last on, without a value."""
    written = [literal(b) for b in bounds]
    if not written:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(written, written[1:], strict=False)]
    return [f"{column} < {written[0]}", *between, f"{column} >= {written[-1]}", f"{column} IS NULL"]


def even_splits(df: DataFrame, column: str, parts: int) -> list[str]:
    """The conditions for ``parts`` readers, and one for rows without a value, from a copy of the table."""
    return predicates(column, equi_depth(df, column, parts))
