"""Session settings and shared scratch space."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE splits a skewed sort-merge join by itself only if no further shuffle
# follows from it. With this setting it also splits the others, so a key that
# holds a third of the rows never ends up in one task.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Spark lists the folders of a table's partitions in as many tasks as there are, up to its default of
# 10,000, whenever the table is read anew. A folder takes less time than a task.
LISTING, LISTING_DEFAULT, LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism", "10000", "64"


def tune(spark: SparkSession) -> SparkSession:
    """Turn on skew handling for every plan built in this session, and list folders in few tasks."""
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    if spark.conf.get(LISTING) == LISTING_DEFAULT:
        spark.conf.set(LISTING, LISTING_TASKS)
    return spark


@functools.lru_cache(maxsize=1)
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def workspace(spark: SparkSession, purpose: str) -> str:
    """A new, empty folder under the shared folder the cluster names. All folders of
    one application are in one, so that they can be expired together.

    Only a session whose driver is its one executor falls back to a temporary
    folder without ``spark.checkpoint.dir``; other machines could not read one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_scratch()
    application = spark.sparkContext.applicationId
    return f"{base.rstrip('/')}/lakeloom/{application}/{purpose}-{uuid.uuid4().hex[:16]}"


def materialise(df: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back. compression: other than the session's.

    Used where one result feeds several jobs. Unlike a cache, the files are
    still there when executors are lost.
    """
    path = workspace(df.sparkSession, purpose)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
