"""The control table: which sources to load, how, and from which mark on."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.watermark import LOWEST_WATERMARK

CONTROL_SCHEMA = (
    "table_name string, source_schema string, load_type string, "
    "watermark_column string, last_loaded_at timestamp_ntz"
)
FULL, INCREMENTAL = "full", "incremental"
NEVER = datetime.fromisoformat(LOWEST_WATERMARK)
# The sources of a new lakehouse, none of which was loaded yet.
CONTROL_SEED = (
    ("customers", "dbo", "full", None, NEVER),
    ("products", "dbo", "full", None, NEVER),
    ("orders", "dbo", "incremental", "updated_at", NEVER),
    ("order_items", "dbo", "incremental", "created_at", NEVER),
    ("payments", "dbo", "incremental", "updated_at", NEVER),
)


@dataclass(frozen=True)
class ControlRow:
    table_name: str
    source_schema: str
    load_type: str
    watermark_column: str | None
    last_loaded_at: datetime


def control_rows(control: DataFrame) -> list[ControlRow]:
    """The control table on the driver: one row per source, so a few dozen. A source
    without a mark was never loaded."""
    names = ControlRow.__dataclass_fields__
    rows = [ControlRow(**row.asDict()) for row in control.select(*names).collect()]
    rows = [row if row.last_loaded_at else replace(row, last_loaded_at=NEVER) for row in rows]
    for row in rows:
        if row.load_type not in (FULL, INCREMENTAL):
            raise ValueError(f"{row.table_name}: load_type {row.load_type!r}")
        if row.load_type == INCREMENTAL and not row.watermark_column:
            raise ValueError(f"{row.table_name}: incremental load without a watermark column")
    return sorted(rows, key=lambda row: row.table_name)


def incremental_rows(df: DataFrame, watermark_column: str, last_loaded_at: datetime) -> DataFrame:
    """Rows changed after ``last_loaded_at``; a row at the mark was loaded before. Rows without
    a mark are not among them, see ``unmarked_rows``."""
    column_type = df.schema[watermark_column].dataType.simpleString()
    mark = F.lit(last_loaded_at.isoformat(sep=" ")).cast(column_type)
    return df.where(F.col(watermark_column) > mark)


def unmarked_rows(df: DataFrame, watermark_column: str) -> DataFrame:
    """Rows of unknown change time. No mark tells whether they were loaded, so each run copies them all."""
    return df.where(F.col(watermark_column).isNull())


def extract(df: DataFrame, row: ControlRow) -> DataFrame:
    """What this run must copy from one source table, less the rows without a mark."""
    if row.load_type == FULL:
        return df
    return incremental_rows(df, row.watermark_column, row.last_loaded_at)
