"""Calendar attributes of a day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_columns(day: Column) -> list[Column]:
    """The nine attributes of the date dimension that follow its day column."""
    return [
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.monthname(day).alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),  # ISO week
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"),  # Sunday = 1
        F.dayname(day).alias("day_name"),
    ]
