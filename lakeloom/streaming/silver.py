"""Bronze to silver as a stream that takes what has arrived and stops."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakeloom.plans.jobs import load_silver
from lakeloom.plans.silver import SilverTable
from lakeloom.sinks.tables import Table

_ROW, _ARRIVED = "__row", "__arrived"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ON_HEAP = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_ADAPTIVE = "spark.sql.adaptive.enabled"


@contextmanager
def _adaptive(session: SparkSession) -> Iterator[None]:
    """Adaptive plans in the session of a micro-batch. Spark turns them off there for the sake of the state, whose plan
    is fixed by then. Without them no rows are brought to their ranges before files are written, and each task writes a
    file for each range."""
    before = session.conf.get(_ADAPTIVE)
    session.conf.set(_ADAPTIVE, "true")
    try:
        yield
    finally:
        session.conf.set(_ADAPTIVE, before)  # as the next micro-batch's state needs it


def stream_silver(
    spark: SparkSession,
    table: SilverTable,
    target: Table,
    bronze_folder: str,
    schema: StructType,
    checkpoint: str,
    files_per_batch: int | None = None,
    remember: str | None = None,
) -> StreamingQuery:
    """Start an available-now query over the bronze files not yet processed.

    remember: how long the stream knows a row it has seen, as ``7 days``. A row
              that arrives again within that time, equal in all columns, does not
              reach the merge. The time is that of arrival, not of the event: no
              row is ever late, so none is dropped for it, and the state holds
              what arrived in that time. Rows that come again later meet the
              merge, which changes nothing for them. The state is partitioned by
              row and lies in RocksDB, not on the heap of the executors, unless
              the session names a store of its own; a checkpoint keeps the store
              that it began with.

    Each micro-batch is cleaned and loaded like a daily batch. A micro-batch
    that is run again after a failure changes nothing the second time, because
    the merge is idempotent; so no rows are lost or doubled.
    """
    if not table.incremental:
        raise ValueError(f"{table.name} is loaded by full refresh")
    # the folders of days and marks are no columns of the table, and days may differ in them
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    arrived = reader.parquet(bronze_folder).select(*schema.names)

    if remember:
        # the text of each column, which keeps microseconds where JSON of a timestamp would not
        row = F.md5(F.to_json(F.struct(*(F.col(c).cast("string").alias(c) for c in schema.names))))
        seen = arrived.withColumns({_ROW: row, _ARRIVED: F.current_timestamp()}).withWatermark(_ARRIVED, remember)
        arrived = seen.dropDuplicatesWithinWatermark([_ROW]).drop(_ROW, _ARRIVED)

    def load(batch: DataFrame, _: int) -> None:
        with _adaptive(batch.sparkSession):
            load_silver(table, target, table.transform(batch), count_target=False)

    writer = arrived.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if not remember or spark.conf.get(_STORE) != _ON_HEAP:
        return writer.start()
    # a query keeps the settings of the moment it starts at
    spark.conf.set(_STORE, _ROCKSDB)
    try:
        return writer.start()
    finally:
        spark.conf.set(_STORE, _ON_HEAP)
