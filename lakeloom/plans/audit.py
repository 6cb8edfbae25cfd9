"""One audit row per task run, whether it succeeded or failed."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.sinks.tables import Table
from lakeloom.sources.relational import JdbcSource

log = logging.getLogger(__name__)

# The fields of the audit log, in its order.
AUDIT_SCHEMA = (
    "run_date string, pipeline_run_id string, pipeline_name string, orchestrator string, "
    "job_name string, job_run_id string, task_name string, task_run_id string, "
    "layer string, source_name string, activity_name string, load_type string, "
    "status string, row_count bigint, error_message string, "
    "start_time timestamp_ntz, end_time timestamp_ntz"
)
SUCCESS, FAIL = "SUCCESS", "FAIL"


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class AuditRecord:
    layer: str
    source_name: str
    activity_name: str
    load_type: str | None = None
    run_date: str | None = None
    pipeline_run_id: str | None = None
    pipeline_name: str | None = None
    orchestrator: str | None = None
    job_name: str | None = None
    job_run_id: str | None = None
    task_name: str | None = None
    task_run_id: str | None = None
    status: str | None = None
    row_count: int | None = None
    error_message: str | None = None
    start_time: datetime | None = None
    end_time: datetime | None = None


AuditSink = Callable[[AuditRecord], None]


def audit_frame(spark: SparkSession, records: list[AuditRecord]) -> DataFrame:
    """Records as a DataFrame; missing times become now."""
    now = utc_now()
    rows = []
    for record in records:
        row = asdict(record)
        row["start_time"] = row["start_time"] or now
        row["end_time"] = row["end_time"] or now
        rows.append(row)
    return spark.createDataFrame(rows, schema=AUDIT_SCHEMA)


def table_sink(spark: SparkSession, table: Table) -> AuditSink:
    """Add records to a catalog table, each as a partition of its own: tasks that end at
    one time don't disturb each other."""

    def write(record: AuditRecord) -> None:
        table.add(audit_frame(spark, [record]).coalesce(1))

    return write


def compact(spark: SparkSession, table: Table, grace: timedelta = timedelta(hours=1)) -> dict[str, int]:
    """Join the log's records into one partition a month of their start; returns how many partitions each took."""
    return table.join_leaves(spark, F.date_format("start_time", "yyyy-MM"), grace)


def jdbc_sink(spark: SparkSession, source: JdbcSource, table: str) -> AuditSink:
    """Append records to a database table."""

    def write(record: AuditRecord) -> None:
        df = audit_frame(spark, [record]).coalesce(1)
        df.write.format("jdbc").options(**source.writer_options(table)).mode("append").save()

    return write


class Outcome:
    """What the audited block reports back."""

    row_count: int | None = None


@contextmanager
def audited(sink: AuditSink, record: AuditRecord) -> Iterator[Outcome]:
    """Run a block and write how it ended.

    The original error is re-raised. Trouble with writing the FAIL record is
    logged only, so that it does not hide that error.
    """
    outcome = Outcome()
    started = utc_now()
    try:
        yield outcome
    except Exception as error:
        failed = replace(
            record, status=FAIL, error_message=str(error), start_time=started, end_time=utc_now()
        )
        try:
            sink(failed)
        except Exception:
            log.exception("no audit record for %s", record.source_name)
        raise
    sink(
        replace(
            record,
            status=SUCCESS,
            row_count=outcome.row_count,
            start_time=started,
            end_time=utc_now(),
        )
    )
