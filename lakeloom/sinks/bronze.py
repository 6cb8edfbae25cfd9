"""Raw extracts as Snappy Parquet."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame

from lakeloom.sources.bronze import BATCH_COLUMN, COPY, copies, mark_folder


def _write(df: DataFrame, path: str, mode: str) -> None:
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def write_full(df: DataFrame, base: str, table: str) -> None:
    """Replace the bronze copy of a fully loaded table.

    The copy is written beside the last one and listed when it is whole, so a run
    that dies leaves the last one, and readers meanwhile see that. Give superseded
    copies a lifecycle rule.
    """
    name = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    _write(df, f"{base}/{table}/{COPY}={name}", "errorifexists")
    _write(df.sparkSession.createDataFrame([(name,)], f"{COPY} string").coalesce(1), copies(base, table), "append")


def write_batch(
    df: DataFrame, base: str, table: str, run_date: str, since: datetime | None = None
) -> None:
    """Write the batch of ``run_date``; other days stay as they are.

    since: the mark the batch starts from. Batches of one day with different marks
           stay side by side, each run adds its own rows; a run that failed and
           starts from its mark again replaces what it left. Without a mark the
           batch is the whole day.
    """
    day = f"{base}/{table}/{BATCH_COLUMN}={run_date}"
    _write(df, day if since is None else f"{day}/{mark_folder(since)}", "overwrite")


def write_unmarked(df: DataFrame, base: str, table: str, run_date: str) -> None:
    """Write the rows of ``run_date`` that have no mark, in place of those the day has; its batches stay."""
    _write(df, f"{base}/{table}/{BATCH_COLUMN}={run_date}/{mark_folder(None)}", "overwrite")
