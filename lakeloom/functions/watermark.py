"""High-water marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the mark of a source that was never loaded.
LOWEST_WATERMARK = "1900-01-01 00:00:00"


def high_water_mark(df: DataFrame, column: str) -> Column:
    """Largest ``column`` of ``df`` as a scalar subquery, or the lowest mark.

    The subquery stays inside the plan that uses it: no value passes through
    the driver program, and Spark runs it once.
    """
    column_type = df.schema[column].dataType.simpleString()
    lowest = F.lit(LOWEST_WATERMARK).cast(column_type)
    return df.agg(F.coalesce(F.max(column), lowest).alias("mark")).scalar()
