"""Managed Parquet tables: full refresh, insert-only merge, conditional upsert.

Spark refuses ``MERGE INTO`` on plain Parquet, so a merge here writes new files
in a new folder and then points the catalog entry at it. Files that a query may
be reading are never overwritten, and a job that dies half-way leaves the old
state in place.

A table may be partitioned by ranges of a whole-number column that never changes
for a key, such as the key itself or the order an item belongs to. A merge then
reads only the ranges its batch falls into and rewrites only those in which a
row is really replaced or added. All files are written before the catalog hears
of any, so a merge that died half-way is simply run again. Without ranges, a
batch that replaces any row rewrites the table and new keys alone are appended.
The ranges are kept with the table: a later run need not name them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime, timedelta, timezone
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeloom.operators import merge as m
from lakeloom.session import materialise as written_once

RANGE = "key_range"
LEAF = "leaf"
# Leaves that were made of others, and what tells which.
JOINED = "joined-"
JOINS = f"{LEAF} string, into string, at timestamp_ntz"
RANGE_COLUMN, RANGE_WIDTH = "lakeloom.range_column", "lakeloom.range_width"
# Catalog calls at a time when the partitions of a merge are moved.
CATALOG_CALLS = 16
# Batches of fewer rows are small enough for Spark to broadcast; others filter the target by their keys.
FILTERED_FROM = 100_000
# Keys that are digests take half the room of Spark's default.
COMPRESSION = "zstd"
# Makes a table's columns of rows that were shuffled without some of them.
Finish = Callable[[DataFrame], DataFrame]
# Formats whose own MERGE is used instead.
MERGING_FORMATS = frozenset({"delta", "iceberg"})


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """``session.materialise`` with the compression of tables."""
    return written_once(df, purpose, COMPRESSION)


@dataclass(frozen=True)
class MergeCounts:
    """Reconciliation of one merge: ``after = before + inserts``.

    ``before`` is None where the table was not counted.
    """

    before: int | None
    incoming: int
    updates: int
    inserts: int

    @property
    def after(self) -> int | None:
        return None if self.before is None else self.before + self.inserts

    @property
    def changed(self) -> int:
        return self.updates + self.inserts


@dataclass(frozen=True)
class Ranges:
    """Rows of ``width`` consecutive values of ``column`` share a partition.

    Choose the width so that a partition holds some gigabytes: the driver
    handles the list of partitions.
    """

    column: str
    width: int

    def of(self) -> Column:
        # rows without a value never match, so any range will do for them
        return F.coalesce(F.floor(F.col(self.column) / F.lit(self.width)), F.lit(-1)).cast("long")

    def listed(self, df: DataFrame) -> list[int]:
        """The ranges ``df`` falls into, at most one per partition."""
        return sorted(row[0] for row in df.select(self.of()).distinct().collect())


@dataclass(frozen=True)
class Table:
    """A catalog table and where its files go.

    name:   catalog name, for example ``silver.orders``.
    root:   folder that holds the table's files.
    keys:   columns of the merge key; unique in the table.
    ranges: how the table is partitioned, if it is; a table that exists knows it by itself.
    format: ``parquet``, or a format of the session that merges by itself.
    leaves: each ``add`` makes a partition of its own, so that writers at one
            time don't meet; ``join_leaves`` makes few of many.
    """

    name: str
    root: str
    keys: tuple[str, ...] = ()
    ranges: Ranges | None = None
    format: str = "parquet"
    leaves: bool = False

    # -- properties ----------------------------------------------------------
    def exists(self, spark: SparkSession) -> bool:
        return spark.catalog.tableExists(self.name)

    def properties(self, spark: SparkSession) -> dict[str, str]:
        rows = spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect() if self.exists(spark) else []
        return {row["key"]: row["value"] for row in rows}

    def set_property(self, spark: SparkSession, key: str, value: str) -> None:
        spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ('{key}' = '{value}')")

    def opened(self, spark: SparkSession) -> Table:
        """This table with the ranges it was created with; others than those are an error."""
        if self.leaves or not self.exists(spark):
            return self
        known = self.properties(spark)
        stored = Ranges(known[RANGE_COLUMN], int(known[RANGE_WIDTH])) if RANGE_COLUMN in known else None
        if self.ranges and self.ranges != stored:
            raise ValueError(f"{self.name} was created with {stored}, not {self.ranges}")
        return replace(self, ranges=stored)

    # -- reading -----------------------------------------------------------

    def read(self, spark: SparkSession, ranges: list[int] | None = None) -> DataFrame:
        """The table, or only the partitions of ``ranges``.

        A session remembers where a table's files were; another one, such as
        that of a streaming batch, may have moved them since.
        """
        spark.catalog.refreshTable(self.name)
        df = spark.table(self.name)
        if self.leaves:
            return self._with_leaves(spark).drop(LEAF)
        if ranges is not None:
            df = df.where(F.col(RANGE).isin(ranges))
        return df.drop(RANGE)

    def placed(self, spark: SparkSession, ranges: Sequence[int] | None = None) -> DataFrame:
        """The rows with the number of their range, of all ranges or some."""
        spark.catalog.refreshTable(self.name)
        df = spark.table(self.name)
        return df if ranges is None else df.where(F.col(RANGE).isin(list(ranges)))

    def held(self, spark: SparkSession, ranges: Sequence[int]) -> DataFrame:
        """The rows of ``ranges`` as they are now, also when the ranges have other files later: those of now stay."""
        now = self.read(spark, list(ranges))
        files = [unquote(file) for file in now.inputFiles()]
        return spark.read.schema(now.schema).parquet(*files) if files else now.where(F.lit(False))

    # -- layout ------------------------------------------------------------
    def _placed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(RANGE, self.ranges.of()) if self.ranges else df

    def _new_folder(self) -> str:
        return f"{self.root.rstrip('/')}/v-{uuid.uuid4().hex[:16]}"

    def _write_version(self, placed: DataFrame, finish: Finish | None = None) -> str:
        """Write to a new folder. ``rebalance`` evens out file sizes: it splits
        a range that holds most rows and joins tiny ones."""
        folder = self._new_folder()
        rows = placed.hint("rebalance", RANGE) if self.ranges else placed
        writer = (finish(rows) if finish else rows).write.option("compression", COMPRESSION)
        (writer.partitionBy(RANGE) if self.ranges else writer).parquet(folder)
        return folder

    def _finishing(self, current: DataFrame, finish: Finish) -> Finish:
        """``finish``, then the columns and types of the table, and the range."""

        def finished(rows: DataFrame) -> DataFrame:
            done = finish(rows)
            kept = [RANGE] if RANGE in done.columns else []
            return done.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in current.schema.fields), *kept)

        return finished

    def _point_ranges(self, spark: SparkSession, folder: str, ranges: list[int]) -> None:
        known = set(self._known_ranges(spark))

        def at(value: int) -> str:
            return f"'{folder}/{RANGE}={value}'"

        if new := [v for v in ranges if v not in known]:
            added = " ".join(f"PARTITION ({RANGE}={v}) LOCATION {at(v)}" for v in new)
            spark.sql(f"ALTER TABLE {self.name} ADD {added}")
        # catalogs move one partition a call
        with ThreadPoolExecutor(CATALOG_CALLS) as calls:
            moves = [calls.submit(self._move, spark, v, at(v)) for v in ranges if v in known]
        for move in moves:
            move.result()

    def _move(self, spark: SparkSession, value: int, folder: str) -> None:
        spark.sql(f"ALTER TABLE {self.name} PARTITION ({RANGE}={value}) SET LOCATION {folder}")

    def _known_ranges(self, spark: SparkSession) -> list[int]:
        rows = spark.sql(f"SHOW PARTITIONS {self.name}").collect()
        return [int(row["partition"].split("=", 1)[1]) for row in rows]

    # -- creating and replacing ---------------------------------------------
    def create_if_absent(self, spark: SparkSession, schema: StructType) -> None:
        """An empty table of ``schema``, unless there is one."""
        if self.exists(spark):
            return
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        layout = kept = ""
        if self.ranges:
            columns += f", {RANGE} bigint"
            layout = f"PARTITIONED BY ({RANGE})"
            kept = (
                f"TBLPROPERTIES ('{RANGE_COLUMN}' = '{self.ranges.column}', "
                f"'{RANGE_WIDTH}' = '{self.ranges.width}')"
            )
        elif self.leaves:
            columns += f", {LEAF} string"
            layout = f"PARTITIONED BY ({LEAF})"
        # another first run may have been quicker
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING {self.format} {layout} "
            f"LOCATION '{self._new_folder()}' {kept}"
        )

    def add(self, df: DataFrame) -> None:
        """Append rows as a partition of their own: files first, then one catalog call."""
        spark, leaf = df.sparkSession, uuid.uuid4().hex
        self.create_if_absent(spark, df.schema)
        folder = f"{self.root.rstrip('/')}/{LEAF}={leaf}"
        df.write.parquet(folder)
        spark.sql(f"ALTER TABLE {self.name} ADD PARTITION ({LEAF}='{leaf}') LOCATION '{folder}'")

    def _listed_leaves(self, spark: SparkSession) -> set[str]:
        return {row["partition"].split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {self.name}").collect()}

    def _joined_into(self, spark: SparkSession, listed: set[str]) -> list[tuple[str, str, datetime]]:
        """(leaf, the leaf that it was joined into, when) of the leaves that are still listed beside that one."""
        joined = [f"{self._joins()}/{name}" for name in sorted(listed) if name.startswith(JOINED)]
        rows = spark.read.schema(JOINS).parquet(*joined).collect() if joined else []
        return [(r[LEAF], r["into"], r["at"]) for r in rows if r[LEAF] in listed]

    def _joins(self) -> str:
        return f"{self.root.rstrip('/')}.joins"

    def _with_leaves(self, spark: SparkSession) -> DataFrame:
        """Every row once, with its leaf: of leaves that were joined only the joint one, as far as it is listed now."""
        listed = self._listed_leaves(spark)
        gone = sorted(leaf for leaf, _, _ in self._joined_into(spark, listed))
        joint = sorted(name for name in listed if name.startswith(JOINED))
        # one that is added while this reads would come on top of its leaves
        known = ~F.col(LEAF).startswith(JOINED) | F.col(LEAF).isin(joint)
        return spark.table(self.name).where(known & ~F.col(LEAF).isin(gone))

    def join_leaves(self, spark: SparkSession, by: Column, grace: timedelta = timedelta(hours=1)) -> dict[str, int]:
        """Join the leaves whose least value of ``by`` is the same into one; returns how many each took.

        Writers and readers may go on meanwhile. The joint leaf comes with a list of those in it, which readers pass over
        from the moment it is there. The catalog forgets them in a later call, ``grace`` after the join at the earliest, so
        that a reader that has just looked up the leaves still finds them. One call at a time. Files stay.
        """
        spark.catalog.refreshTable(self.name)
        listed = self._listed_leaves(spark)
        covered = self._joined_into(spark, listed)
        until = datetime.now(timezone.utc).replace(tzinfo=None) - grace
        # what was joined first goes first: a joint leaf stays as long as one of those in it
        for time in sorted({at for _, _, at in covered if at <= until}):
            dropped = ", ".join(f"PARTITION ({LEAF}='{leaf}')" for leaf, _, at in covered if at == time)
            spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {dropped}")
        rows = self._with_leaves(spark)
        groups: dict[str, list[str]] = {}
        for leaf, value in rows.groupBy(LEAF).agg(F.min(by).cast("string")).collect():  # names, not rows
            groups.setdefault(str(value), []).append(leaf)
        taken = {}
        for value, leaves in sorted(groups.items()):
            if len(leaves) < 2:
                continue
            name = f"{JOINED}{uuid.uuid4().hex}"
            folder = f"{self.root.rstrip('/')}/{LEAF}={name}"
            rows.where(F.col(LEAF).isin(leaves)).drop(LEAF).hint("rebalance").write.parquet(folder)
            now = datetime.now(timezone.utc).replace(tzinfo=None)
            spark.createDataFrame([(leaf, name, now) for leaf in leaves], JOINS).coalesce(1).write.parquet(f"{self._joins()}/{name}")
            spark.sql(f"ALTER TABLE {self.name} ADD PARTITION ({LEAF}='{name}') LOCATION '{folder}'")
            taken[value] = len(leaves)
        spark.catalog.refreshTable(self.name)
        return taken

    def replace(self, df: DataFrame, finish: Finish | None = None) -> int:
        """Full refresh: the table holds exactly ``df`` afterwards. Returns its rows.

        Columns are matched by name and must be the table's. The rows are
        counted in the written files, so ``df`` is computed once.

        finish: makes the table's columns of ``df``, row by row and keeping columns that it does not know. It is
                done where files are written, so that rows are shuffled to their files without what it adds.
        """
        spark = df.sparkSession
        self.create_if_absent(spark, (finish(df) if finish else df).schema)
        return self.opened(spark)._replace(df, finish)

    def _replace(self, df: DataFrame, finish: Finish | None = None) -> int:
        spark = df.sparkSession
        current = self.read(spark)
        columns = (finish(df) if finish else df).columns
        if extra := set(columns) ^ set(current.columns):
            raise ValueError(f"{self.name}: columns differ in {sorted(extra)}")
        if self.format in MERGING_FORMATS:
            m.conform(finish(df) if finish else df, current).write.insertInto(self.name, overwrite=True)
            return self.read(spark).count()
        if finish:
            folder = self._write_version(self._placed(df), self._finishing(current, finish))
        else:
            folder = self._write_version(self._placed(m.conform(df, current)))
        if self.ranges:
            before = self._known_ranges(spark)
            written = self._written_ranges(spark, folder)
            self._point_ranges(spark, folder, written)
            for value in set(before) - set(written):
                spark.sql(f"ALTER TABLE {self.name} DROP PARTITION ({RANGE}={value})")
        else:
            spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(self.name)
        return self.read(spark).count()

    def _written_ranges(self, spark: SparkSession, folder: str) -> list[int]:
        """The ranges in a folder: those of a partition column are listed, no data is read."""
        rows = spark.read.schema(f"{RANGE} bigint").parquet(folder).distinct().collect()
        return sorted(row[0] for row in rows)

    def replace_ranges(self, df: DataFrame, ranges: Sequence[int], finish: Finish | None = None) -> None:
        """The given ranges hold exactly ``df`` afterwards; others stay as they are and are not read. finish: see ``replace``."""
        spark = df.sparkSession
        if not ranges:
            return
        current = self.read(spark)
        if finish:
            folder = self._write_version(self._placed(df), self._finishing(current, finish))
        else:
            folder = self._write_version(self._placed(m.conform(df, current)))
        written = set(self._written_ranges(spark, folder))
        if beside := written - set(ranges):
            raise ValueError(f"{self.name}: rows of other ranges, {sorted(beside)[:5]}")
        known = set(self._known_ranges(spark))
        self._point_ranges(spark, folder, sorted(written))
        for value in sorted(known & set(ranges) - written):
            spark.sql(f"ALTER TABLE {self.name} DROP PARTITION ({RANGE}={value})")
        spark.catalog.refreshTable(self.name)

    # -- merging -------------------------------------------------------------
    def merge_statement(self, source_view: str, update_when: str | None, insert_only: bool) -> str:
        """The same merge as SQL, for a format that has ``MERGE INTO``."""
        on = " AND ".join(f"target.{k} = source.{k}" for k in self.keys)
        clauses = ["WHEN NOT MATCHED THEN INSERT *"]
        if not insert_only:
            extra = f" AND {update_when}" if update_when else ""
            clauses.insert(0, f"WHEN MATCHED{extra} THEN UPDATE SET *")
        return f"MERGE INTO {self.name} AS target USING {source_view} AS source ON {on} " + " ".join(
            clauses
        )

    def insert_new(self, batch: DataFrame, **options: bool) -> MergeCounts:
        """Insert-only merge: append rows whose key is new, touch nothing else."""
        return self._open_merge(batch, "false", insert_only=True, **options)

    def upsert(
        self, batch: DataFrame, update_when: str | None = None, **options: bool
    ) -> MergeCounts:
        """Replace matched rows where ``update_when`` holds, insert the others.

        source_is_unique: skip the duplicate-key check, for a batch that comes
                          out of ``latest_per_key``.
        count_target:     count the rows there were before, which opens every
                          file of the table, not just those of its ranges.
        stored:           the batch is read from files that stay, and is not
                          written once more.
        """
        return self._open_merge(batch, update_when, insert_only=False, **options)

    def _open_merge(self, batch: DataFrame, update_when: str | None, **options: bool) -> MergeCounts:
        self.create_if_absent(batch.sparkSession, batch.schema)
        return self.opened(batch.sparkSession)._merge(batch, update_when, **options)

    def _merge(
        self,
        batch: DataFrame,
        update_when: str | None,
        insert_only: bool,
        source_is_unique: bool = False,
        count_target: bool = True,
        stored: bool = False,
    ) -> MergeCounts:
        spark = batch.sparkSession
        keys = list(self.keys)
        whole = self.read(spark)
        placed = self._placed(m.conform(batch, whole))
        if source_is_unique and self.format not in MERGING_FORMATS and _empty(whole):
            return self._load_empty(placed, 0 if count_target else None)
        # computed once here; every later step reads these files
        staged = placed if stored else materialise(placed, "batch")
        if not source_is_unique and (twice := m.duplicate_keys(staged, keys).first()):
            raise ValueError(f"{self.name}: key {twice.asDict()} occurs more than once in the batch")

        before = whole.count() if count_target else None  # from the file footers
        incoming, ranges = self._size(staged)[()]
        if not incoming:
            return MergeCounts(before, 0, 0, 0)
        target = spark.table(self.name)
        if self.ranges:
            target = target.where(F.col(RANGE).isin(ranges))
        if before == 0 or (before is None and _empty(target)):
            self._append(staged, ranges)
            return MergeCounts(before, incoming, 0, incoming)
        if insert_only and _filtered(incoming):
            # nothing is replaced: one join tells the new rows, whatever the target's other columns
            actions = m.new_rows(target, staged, keys, incoming).withColumn(m.ACTION, F.lit("insert"))
        else:
            actions = m.classify(target, staged, keys, update_when, _filtered(incoming)).where(F.col(m.ACTION) != "none")
        merges = self.format in MERGING_FORMATS
        # a format that merges by itself joins again: there only the counts are taken here
        changes = actions.select(m.ACTION) if merges else materialise(actions, "changes")
        sizes = self._size(changes, m.ACTION)
        updated, changed = sizes.get(("update",), (0, []))
        inserted, grown = sizes.get(("insert",), (0, []))
        counts = MergeCounts(before, incoming, updated, inserted)

        if merges:
            view = f"merge_source_{uuid.uuid4().hex}"
            staged.createOrReplaceTempView(view)
            spark.sql(self.merge_statement(view, update_when, insert_only))
            spark.catalog.dropTempView(view)
            return counts

        updates = changes.where(F.col(m.ACTION) == "update").drop(m.ACTION)
        inserts = changes.where(F.col(m.ACTION) == "insert").drop(m.ACTION)
        if self.ranges and (updated or inserted):
            # ranges that only get rows are rewritten too: files added to a moved partition
            # would be renamed one by one by the driver
            here = sorted({*changed, *(set(grown) & set(self._known_ranges(spark)))})
            rewritten = target.where(F.col(RANGE).isin(here))
            if updated:
                rewritten = m.update_matched(rewritten, updates, keys, update_when, _filtered(updated))
            rewritten = rewritten.unionByName(inserts)
            folder = self._write_version(rewritten)
            self._point_ranges(spark, folder, sorted({*changed, *grown}))
        elif updated:
            rewritten = m.update_matched(target, updates, keys, update_when, _filtered(updated)).unionByName(inserts)
            folder = self._write_version(rewritten)
            spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{folder}'")
        elif inserted:
            self._append(inserts, [])
        spark.catalog.refreshTable(self.name)
        return counts

    def _size(self, rows: DataFrame, *by: str) -> dict[tuple, tuple[int, list[int]]]:
        """Row count, and the ranges (at most one per partition) in one pass, of all rows or by the values of ``by``."""
        sizes: dict[tuple, tuple[int, list[int]]] = {} if by else {(): (0, [])}
        ranged = self.ranges and RANGE in rows.columns
        counts = rows.groupBy(*by, *[RANGE] * bool(ranged)).agg(F.count(F.lit(1)).alias("n")).collect()
        for row in counts:
            group = tuple(row[: len(by)])
            count, ranges = sizes.get(group, (0, []))
            sizes[group] = (count + row["n"], ranges + ([row[RANGE]] if ranged else []))
        return sizes

    def _load_empty(self, placed: DataFrame, before: int | None) -> MergeCounts:
        """Rows with unique keys into a table without rows: they are written once, where they stay."""
        spark = placed.sparkSession
        folder = self._write_version(placed)
        incoming, ranges = self._size(spark.read.schema(placed.schema).parquet(folder))[()]
        if incoming and self.ranges:
            self._point_ranges(spark, folder, sorted(ranges))
        elif incoming:
            spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(self.name)
        return MergeCounts(before, incoming, 0, incoming)

    def _append(self, placed: DataFrame, ranges: list[int]) -> None:
        """Add rows whose ranges, if there are any, hold none yet."""
        spark = placed.sparkSession
        if self.ranges:
            self._point_ranges(spark, self._write_version(placed), ranges)
        else:
            placed.select(*spark.table(self.name).columns).write.insertInto(self.name)
        spark.catalog.refreshTable(self.name)


def _empty(df: DataFrame) -> bool:
    """As ``isEmpty``, which opens every file of a table; a first row mostly takes one."""
    return not df.take(1)


def _filtered(rows: int) -> int | None:
    """The rows of a batch that is worth a filter."""
    return rows if rows >= FILTERED_FROM else None
