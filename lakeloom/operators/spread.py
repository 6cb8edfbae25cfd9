"""Joins that stay even when one key, or no key at all, is on most rows.

AQE splits a skewed partition of a sort-merge join only where both sides arrive
straight from a shuffle made for that join. A side that was just grouped by the
same key does not, and then one task gets the hot key whole. Also, all rows
without a key hash to the same partition though none of them can match.

Joining on one more column cures both: it is 0 for rows with a key, so it
changes no match, and a hash of the row for rows without one. The extra column
makes Spark shuffle both sides for this join, unless it broadcasts one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPREAD = "__spread"


def with_spread(df: DataFrame, keys: Sequence[str], by: Sequence[str] | None = None) -> DataFrame:
    """``df`` with the extra join column.

    by: columns that differ between rows without a key; by default all. They
    are hashed: unlike a random number, a hash sends a row to the same place
    when its task is run again.
    """
    if by is None:
        unhashable = (T.MapType, T.VariantType)
        by = [f.name for f in df.schema.fields if not isinstance(f.dataType, unhashable)]
    keyless = reduce(or_, (F.col(k).isNull() for k in keys))
    # always 0; a literal would be folded away where the keys are never null
    zero = F.pmod(F.xxhash64(*keys), F.lit(1))
    return df.withColumn(SPREAD, F.when(keyless, F.xxhash64(*by)).otherwise(zero))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    by: Sequence[str] | None = None,
) -> DataFrame:
    """``left.join(right, keys, how)`` for inner, left, left_semi and left_anti."""
    keys = list(keys)
    return (
        with_spread(left, keys, by)
        .join(with_spread(right, keys, keys), [*keys, SPREAD], how)
        .drop(SPREAD)
    )
