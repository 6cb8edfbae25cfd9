"""Metadata-driven ingestion: the control table decides what is copied."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators.cleaning import CleaningRecipe
from lakeloom.operators.quarantine import sort_out
from lakeloom.plans.audit import AuditRecord, AuditSink, audited, utc_now
from lakeloom.plans.lakehouse import Lakehouse
from lakeloom.sinks.bronze import write_batch, write_full, write_unmarked
from lakeloom.sources.bronze import read_batch, read_full, read_unmarked
from lakeloom.sources.control import FULL, ControlRow, control_rows, extract, unmarked_rows
from lakeloom.sources.delimited import CSV_COLUMNS, read_csv, read_csv_lines

log = logging.getLogger(__name__)

# (source schema, table) -> its rows; for example ``JdbcSource.read``
Reader = Callable[[str, str], DataFrame]


def advanced(control: DataFrame, table_name: str, run_start: datetime) -> DataFrame:
    """The control table with the mark of one source set to the run's start.

    The start, not the end: a row written during the run is read again next
    time rather than missed.
    """
    mark = F.lit(run_start.replace(microsecond=0).isoformat(sep=" ")).cast("timestamp_ntz")
    this = F.col("table_name") == table_name
    return control.withColumn("last_loaded_at", F.when(this, mark).otherwise(F.col("last_loaded_at")))


def ingest(
    spark: SparkSession,
    lakehouse: Lakehouse,
    reader: Reader,
    run_date: str,
    record: AuditRecord | None = None,
    sink: AuditSink | None = None,
    run_start: datetime | None = None,
) -> dict[str, int]:
    """Copy every source the control table lists; returns rows copied per table. A new
    lakehouse gets the control table first.

    Each source is one Spark job over its own table. A source that fails is
    audited and its mark stays; the others still run, then the first error is
    raised.

    Rows of an incremental source whose mark column is null are copied in every run,
    as nothing tells whether they changed; a day holds them once, merges are
    idempotent, and an audit row of their own says how many there were.
    """
    sink = sink or lakehouse.audit_sink(spark)
    record = record or AuditRecord("Bronze", "", "", orchestrator="lakeloom")
    run_start = run_start or utc_now()
    control = lakehouse.control_table()
    if not control.exists(spark):
        lakehouse.seed_control(spark)
    copied: dict[str, int] = {}
    errors: list[Exception] = []
    for row in control_rows(control.read(spark)):
        this = replace(
            record,
            source_name=row.table_name,
            activity_name=f"Data Ingestion: {row.table_name}",
            load_type=row.load_type.upper(),
            run_date=None,
            task_name=None,
        )
        try:
            with audited(sink, this) as outcome:
                outcome.row_count, unmarked = _copy(spark, lakehouse, reader, row, run_date)
                control.replace(advanced(control.read(spark), row.table_name, run_start))
            copied[row.table_name] = outcome.row_count + unmarked
            if unmarked:
                log.warning("%s: %d rows without %s", row.table_name, unmarked, row.watermark_column)
                with audited(sink, replace(this, activity_name=f"Rows without {row.watermark_column}: {row.table_name}")) as outcome:
                    outcome.row_count = unmarked
        except Exception as error:
            log.error("ingestion of %s failed: %s", row.table_name, error)
            errors.append(error)
    if errors:
        raise errors[0]
    return copied


def _copy(
    spark: SparkSession, lakehouse: Lakehouse, reader: Reader, row: ControlRow, run_date: str
) -> tuple[int, int]:
    """Rows copied: by the mark or in full, and without a mark."""
    source = reader(row.source_schema, row.table_name)
    place = (lakehouse.bronze, row.table_name)
    if row.load_type == FULL:
        write_full(source, *place)
        return read_full(spark, *place).count(), 0
    since = row.last_loaded_at
    write_batch(extract(source, row), *place, run_date, since)
    write_unmarked(unmarked_rows(source, row.watermark_column), *place, run_date)
    marked = read_batch(spark, *place, run_date, since=since).count()
    return marked, read_unmarked(spark, *place, run_date).count()


def land_csv(
    spark: SparkSession,
    lakehouse: Lakehouse,
    folder: str,
    file_name: str,
    table: str,
    record: AuditRecord | None = None,
    sink: AuditSink | None = None,
    quarantine: bool = False,
) -> int:
    """Copy a CSV source, all columns as text, to bronze; returns its rows.

    quarantine: lines with more or fewer fields than columns go to the source's
                ``rejected`` table, instead of being cut or filled up with nulls.
    """
    record = record or AuditRecord("", "", "", orchestrator="lakeloom")
    this = replace(
        record,
        layer="Bronze",
        source_name=table,
        activity_name=f"Data Ingestion: {table}",
        load_type="FULL",
    )
    with audited(sink or lakehouse.audit_sink(spark), this) as outcome:
        if quarantine:
            found = sort_out(CleaningRecipe(), read_csv_lines(spark, folder, file_name, CSV_COLUMNS[table]))
            write_full(found.clean, lakehouse.bronze, table)
            lakehouse.rejected_table(f"{table}_lines").replace(found.rejected)
        else:
            write_full(read_csv(spark, folder, file_name, CSV_COLUMNS[table]), lakehouse.bronze, table)
        outcome.row_count = read_full(spark, lakehouse.bronze, table).count()
    return outcome.row_count
