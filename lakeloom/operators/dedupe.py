"""One row per key, always the same one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PICKED = "__picked"


def _total_order(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], tie_breakers: Sequence[str] | None
) -> list[str]:
    """``order_by``, then the tie breakers: by default all other columns, so that
    rows which still tie are equal in every column that can be compared."""
    if tie_breakers is not None:
        return [*order_by, *tie_breakers]
    placed = {*keys, *order_by}
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in placed and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    return [*order_by, *rest]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """The row with the largest ``order_by`` of each key; nulls rank last.

    Ties go to ``tie_breakers``, by default all remaining columns. Null keys
    form one group, as with any SQL grouping.

    A maximum over structs: each map task sends one row per key, however many
    rows a hot key has. It also tells Catalyst that the key is unique, so that
    a left join that only needs the key can be dropped.
    """
    order = _total_order(df, keys, order_by, tie_breakers)
    rest = [c for c in df.columns if c not in {*keys, *order}]
    if rest or not order:
        # columns that cannot be compared, or that only follow the chosen row
        return first_ranked(df, keys, order_by, tie_breakers)
    chosen = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias(_PICKED))
    return chosen.select(
        *(F.col(c) if c in keys else F.col(f"{_PICKED}.{c}").alias(c) for c in df.columns)
    )


def first_ranked(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """The same row by rank: ``row_number() = 1``. Takes columns of any type.

    Spark turns the rank filter into a per-key limit before the shuffle as well
    as after it, so here too a hot key sends one row per map task.
    """
    order = [F.col(c).desc_nulls_last() for c in _total_order(df, keys, order_by, tie_breakers)]
    if not order:
        return df.dropDuplicates(list(keys))
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(_PICKED, F.row_number().over(window))
    return ranked.where(F.col(_PICKED) == 1).drop(_PICKED)


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key when no column says which is latest: the largest row."""
    return latest_per_key(df, keys, order_by=())
