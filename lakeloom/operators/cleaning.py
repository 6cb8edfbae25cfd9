"""Declarative cleaning: convert columns in place, then keep valid rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Conversion = Callable[[Column, bool], Column]


@dataclass(frozen=True)
class CleaningRecipe:
    """What a table's rows must look like.

    conversions: column -> conversion, replaced in place; other columns pass.
    required:    columns that must not be null after conversion.
    checks:      SQL conditions that must be true (null counts as false).
    """

    conversions: Mapping[str, Conversion] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    checks: tuple[str, ...] = ()

    def rules(self) -> dict[str, Column]:
        named = {f"{name} is not null": F.col(name).isNotNull() for name in self.required}
        return named | {check: F.expr(check) for check in self.checks}

    def convert(self, df: DataFrame, strict: bool = False) -> DataFrame:
        return df.withColumns(
            {name: convert(F.col(name), strict) for name, convert in self.conversions.items()}
        )

    def keep_valid(self, df: DataFrame) -> DataFrame:
        rules = self.rules()
        return df.where(reduce(and_, rules.values())) if rules else df

    def apply(self, df: DataFrame, strict: bool = False) -> DataFrame:
        return self.keep_valid(self.convert(df, strict))

    def reject_counts(self, df: DataFrame) -> DataFrame:
        """``(rule, rejected)``: rows each rule turns away, in one pass.

        A row that breaks two rules is counted under both.
        """
        rules = self.rules()
        counted = self.convert(df).agg(
            *(
                F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"r{i}")
                for i, rule in enumerate(rules.values())
            )
        )
        pairs = [
            F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("rejected"))
            for i, name in enumerate(rules)
        ]
        return counted.select(F.inline(F.array(*pairs)))
