"""Raw Parquet folders: all of a table, or the batch of one day.

A table loaded by batches has a folder per day, and in it one per mark that a batch
starts from (``since=none`` for rows without one). A fully loaded table has a folder
per copy, and beside it a small list of the copies that are whole.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_COLUMN = "ingest_date"
MARK_COLUMN = "since"
NO_MARK = "none"
COPY = "copy"


def mark_folder(since: datetime | None) -> str:
    return f"{MARK_COLUMN}={NO_MARK if since is None else f'{since:%Y%m%dT%H%M%S%f}'}"


def copies(base: str, table: str) -> str:
    """Where the whole copies of a table are listed."""
    return f"{base}/{table}.copies"


def _files(spark: SparkSession, path: str) -> DataFrame:
    """All files below a folder. Folders of days and marks are no columns: lakes hold days
    with and without marks, which Spark would not read as one table."""
    return spark.read.option("recursiveFileLookup", True).parquet(path)


def current_copy(spark: SparkSession, base: str, table: str) -> str | None:
    """The name of the last whole copy; None if the table was never fully loaded, or by an older release."""
    try:
        return spark.read.schema(f"{COPY} string").parquet(copies(base, table)).agg(F.max(COPY)).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return None


def read_full(spark: SparkSession, base: str, table: str) -> DataFrame:
    """Every row of a bronze table: its last whole copy, or all its batches."""
    copy = current_copy(spark, base, table)
    return _files(spark, f"{base}/{table}" + (f"/{COPY}={copy}" if copy else ""))


def has_copy(spark: SparkSession, base: str, table: str) -> bool:
    """Whether anything of a table has been copied yet."""
    try:
        read_full(spark, base, table)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False
    return True


def read_unmarked(spark: SparkSession, base: str, table: str, run_date: str) -> DataFrame:
    """The rows of ``run_date`` that have no mark."""
    return _files(spark, f"{base}/{table}/{BATCH_COLUMN}={run_date}/{mark_folder(None)}")


def read_batch(
    spark: SparkSession,
    base: str,
    table: str,
    run_date: str,
    strict: bool = False,
    since: datetime | None = None,
) -> DataFrame:
    """The rows that arrived on ``run_date``, in one batch or several, without the
    partition columns.

    Names the day's folder instead of filtering the whole table, so years of
    other days are not even listed. A day without a folder is an empty batch of
    the table's type; ``strict`` raises instead.

    since: only the batch that starts from this mark.
    """
    folder = f"{base}/{table}"
    batch = f"{folder}/{BATCH_COLUMN}={run_date}"
    if since is not None:
        batch += f"/{mark_folder(since)}"
    try:
        return _files(spark, batch)
    except AnalysisException as error:
        if strict or error.getCondition() != "PATH_NOT_FOUND":
            raise
    return _files(spark, folder).where(F.lit(False))
