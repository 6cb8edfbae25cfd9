"""Where a lakehouse keeps its layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession

from lakeloom.plans.audit import AuditSink, table_sink
from lakeloom.sinks.tables import Ranges, Table
from lakeloom.sources.control import CONTROL_SCHEMA, CONTROL_SEED


@dataclass(frozen=True)
class Lakehouse:
    """Folders and schemas of one lakehouse.

    gold: schema of the star; a second build, such as a trial one, names another.
    ranges: ``schema.table`` -> how a large table is partitioned. Give orders,
          order items and the fact the same ranges of ``order_id``, and a gold
          build reads only the items whose orders changed.
    format: of new tables: ``parquet``, or a format of the session that merges by itself.
    """

    root: str
    silver: str = "silver"
    gold: str = "gold"
    control: str = "etl"
    ranges: Mapping[str, Ranges] = field(default_factory=dict)
    format: str = "parquet"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    def create_schemas(self, spark: SparkSession) -> None:
        for schema in (self.silver, self.gold, self.control):
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{self.root}/{schema}'")

    def table(self, schema: str, name: str, keys: tuple[str, ...] = ()) -> Table:
        return Table(
            name=f"{schema}.{name}",
            root=f"{self.root}/{schema}/{name}",
            keys=keys,
            ranges=self.ranges.get(f"{schema}.{name}"),
            format=self.format,
        )

    def control_table(self) -> Table:
        return self.table(self.control, "control_table", ("table_name",))

    def rejected_table(self, source: str) -> Table:
        """What the last load of a source turned away: at bronze its lines, at silver its rows."""
        return self.table(self.control, f"rejected_{source}")

    def audit_table(self) -> Table:
        return replace(self.table(self.control, "audit_log"), leaves=True, format="parquet")

    def audit_sink(self, spark: SparkSession) -> AuditSink:
        return table_sink(spark, self.audit_table())

    def seed_control(self, spark: SparkSession, rows: Sequence[tuple] = CONTROL_SEED) -> None:
        """Add control rows for sources that have none yet."""
        df = spark.createDataFrame(list(rows), schema=CONTROL_SCHEMA)
        self.control_table().insert_new(df)
