"""Tables of a relational database, read over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Split:
    """Read a table in ``parts`` ranges of a numeric, date or time column, each
    over a connection of its own. The bounds only place the cuts: rows outside
    them are read too."""

    column: str
    lower: object
    upper: object
    parts: int


@dataclass(frozen=True)
class JdbcSource:
    """One database.

    options: driver, user, password and the like.
    splits:  table -> how to read it in parallel; a table without one is read
             by a single task, which only suits small tables.
    conditions: table -> SQL conditions, one for each reader, of which every row
             meets exactly one (see ``sources.splits``); they go before splits.
    """

    url: str
    options: Mapping[str, str] = field(default_factory=dict)
    splits: Mapping[str, Split] = field(default_factory=dict)
    fetch_size: int = 10_000
    conditions: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def reader_options(self, schema: str, table: str) -> dict[str, str]:
        options = {
            "url": self.url,
            "dbtable": f"{schema}.{table}",
            "fetchsize": str(self.fetch_size),
            # `watermark > last` runs in the database, so only new rows travel
            "pushDownPredicate": "true",
            "preferTimestampNTZ": "true",
            **self.options,
        }
        if (split := self.splits.get(table)) and table not in self.conditions:
            options |= {
                "partitionColumn": split.column,
                "lowerBound": str(split.lower),
                "upperBound": str(split.upper),
                "numPartitions": str(split.parts),
            }
        return options

    def writer_options(self, table: str) -> dict[str, str]:
        return {"url": self.url, "dbtable": table, **self.options}

    def read(self, spark: SparkSession, schema: str, table: str) -> DataFrame:
        options = self.reader_options(schema, table)
        if readers := self.conditions.get(table):
            url, name = options.pop("url"), options.pop("dbtable")
            return spark.read.jdbc(url, name, predicates=list(readers), properties=options)
        return spark.read.format("jdbc").options(**options).load()
