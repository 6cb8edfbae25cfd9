"""Data checks. Each yields ``(check, table, column, failures)`` rows."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class QualityError(AssertionError):
    """Raised when a check found failures."""


@dataclass(frozen=True)
class Unique:
    """No value of ``column`` occurs twice. Nulls are not counted."""

    table: str
    column: str


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str


@dataclass(frozen=True)
class Relationship:
    """Every non-null value of ``column`` occurs in ``parent.parent_column``."""

    table: str
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Condition:
    """``condition`` is never false. Null passes, as in a SQL CHECK."""

    table: str
    column: str
    condition: str


Check = Unique | NotNull | Relationship | Condition


def _counted(df: DataFrame, failed: list[Column], labels: list[tuple[str, str, str]]) -> DataFrame:
    """How many rows of ``df`` meet each condition, as one result row each."""
    counts = df.agg(*(F.count_if(f).alias(f"c{i}") for i, f in enumerate(failed)))
    rows = [
        F.struct(
            F.lit(kind).alias("check"),
            F.lit(table).alias("table"),
            F.lit(column).alias("column"),
            F.col(f"c{i}").cast("long").alias("failures"),
        )
        for i, (kind, table, column) in enumerate(labels)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _unique(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """All unique checks of a table in one pass: one grouping set per column."""
    every = 2 ** len(columns) - 1
    values = df.groupingSets([[c] for c in columns], *columns).agg(
        F.count(F.lit(1)).alias("__rows"), F.grouping_id().alias("__set")
    )
    # the id of a set has a bit for each column it leaves out, the first column the highest
    twice = [
        (F.col("__set") == every - 2 ** (len(columns) - 1 - i))
        & F.col(column).isNotNull()
        & (F.col("__rows") > 1)
        for i, column in enumerate(columns)
    ]
    return _counted(values, twice, [("unique", table, column) for column in columns])


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """``(value, rows)`` of child values the parent lacks.

    Child values are counted before they are shuffled to the join, so a value
    that holds most rows is one row per map task.
    """
    used = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = parent.select(F.col(parent_column).alias("value")).distinct()
    return used.join(known, "value", "left_anti")


def _relationships(
    df: DataFrame, tables: Mapping[str, DataFrame], checks: list[Relationship]
) -> DataFrame:
    """All relationship checks of a table in one pass over it: the values of all its
    columns are counted together, by number of check, then looked for in the parents."""

    def value(column: str, kind: str, number: int) -> Column:
        text = F.col(column).cast(kind).cast("string")
        return F.struct(F.lit(number).alias("check"), text.alias("value"))

    kinds = [df.schema[c.column].dataType.simpleString() for c in checks]
    held = F.array(*(value(c.column, k, i) for i, (c, k) in enumerate(zip(checks, kinds, strict=True))))
    used = (
        df.select(F.inline(held))
        .where(F.col("value").isNotNull())
        .groupBy("check", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = reduce(
        DataFrame.unionByName,
        (
            tables[c.parent].select(F.inline(F.array(value(c.parent_column, k, i))))
            for i, (c, k) in enumerate(zip(checks, kinds, strict=True))
        ),
    )
    missing = used.join(known.distinct(), ["check", "value"], "left_anti")
    lost = [F.sum(F.when(F.col("check") == i, F.col("rows"))).alias(f"c{i}") for i in range(len(checks))]
    counts = missing.agg(*lost)
    rows = [
        F.struct(
            F.lit("relationships").alias("check"),
            F.lit(c.table).alias("table"),
            F.lit(c.column).alias("column"),
            F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("long").alias("failures"),
        )
        for i, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _row_checks(df: DataFrame, table: str, checks: list[NotNull | Condition]) -> DataFrame:
    """All per-row checks of a table in one pass."""
    failed, labels = [], []
    for check in checks:
        if isinstance(check, NotNull):
            failed.append(F.col(check.column).isNull())
            labels.append(("not_null", table, check.column))
        else:
            failed.append(~F.expr(check.condition))
            labels.append(("condition", table, check.column))
    return _counted(df, failed, labels)


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """One row per check. Costs one pass per table for its row checks, one for
    its unique checks and one for its relationships; all aggregate before they
    shuffle."""
    parts: list[DataFrame] = []
    per_row: dict[str, list[NotNull | Condition]] = defaultdict(list)
    unique: dict[str, list[str]] = defaultdict(list)
    related: dict[str, list[Relationship]] = defaultdict(list)
    for check in checks:
        match check:
            case Unique():
                unique[check.table].append(check.column)
            case Relationship():
                related[check.table].append(check)
            case _:
                per_row[check.table].append(check)
    parts += [_unique(tables[table], table, columns) for table, columns in unique.items()]
    parts += [_relationships(tables[table], tables, group) for table, group in related.items()]
    parts += [_row_checks(tables[table], table, group) for table, group in per_row.items()]
    return reduce(DataFrame.unionByName, parts)


def require_passed(results: DataFrame) -> None:
    """Raise if any check failed. ``results`` has one row per check."""
    failed = results.where(F.col("failures") > 0).collect()
    if failed:
        listed = ", ".join(f"{r['check']}({r['table']}.{r['column']})={r['failures']}" for r in failed)
        raise QualityError(listed)
