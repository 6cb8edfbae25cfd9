"""Runnable jobs: bronze to silver per table, silver to gold."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.watermark import LOWEST_WATERMARK
from lakeloom.operators.kept_sums import KeptSums
from lakeloom.operators.quality import require_passed, run_checks
from lakeloom.operators.quarantine import sort_out
from lakeloom.operators.range_checks import CHECK_STATE, PARENT_STATE, RangeChecks
from lakeloom.operators.star import StarModel
from lakeloom.plans import gold
from lakeloom.plans.audit import AuditRecord, AuditSink, audited
from lakeloom.plans.lakehouse import Lakehouse
from lakeloom.plans.range_state import STATE, Changes, changes
from lakeloom.plans.silver import SILVER, Load, SilverTable
from lakeloom.sinks.tables import RANGE, MergeCounts, Ranges, Table, materialise
from lakeloom.sources.bronze import read_batch, read_full

Dims = tuple[DataFrame, DataFrame]


def silver_target(lakehouse: Lakehouse, table: SilverTable) -> Table:
    return lakehouse.table(lakehouse.silver, table.name, table.keys)


def load_silver(
    table: SilverTable, target: Table, rows: DataFrame, count_target: bool = True
) -> int | MergeCounts:
    """Write transformed rows the way the table is loaded."""
    options = {"source_is_unique": True, "count_target": count_target}
    match table.load:
        case Load.FULL_REFRESH:
            return target.replace(rows)
        case Load.INSERT_ONLY:
            return target.insert_new(rows, **options)
        case Load.UPSERT:
            return target.upsert(rows, table.update_when, **options)


def run_silver(
    spark: SparkSession,
    lakehouse: Lakehouse,
    name: str,
    run_date: str | None = None,
    record: AuditRecord | None = None,
    sink: AuditSink | None = None,
    strict: bool = False,
    quarantine: bool = False,
) -> int | MergeCounts:
    """One silver table: read bronze, clean, load, audit.

    quarantine: rows that the recipe turns away go to the table's ``rejected``
                table, which holds those of the last run, with all reasons.
    Returns the rows written by a full refresh, else the merge counts.
    """
    table = SILVER[name]
    if table.incremental and run_date is None:
        raise ValueError(f"{name} is loaded by batch: give a run_date")
    record = replace(
        record or AuditRecord("", "", "", orchestrator="lakeloom"),
        layer="Silver",
        source_name=name,
        activity_name=f"Data Transformation: {name}",
        load_type="INCREMENTAL" if table.incremental else "FULL_REFRESH",
        run_date=run_date if table.incremental else None,
    )
    with audited(sink or lakehouse.audit_sink(spark), record) as outcome:
        if table.incremental:
            bronze = read_batch(spark, lakehouse.bronze, name, run_date)
        else:
            bronze = read_full(spark, lakehouse.bronze, name)
        if quarantine and not strict:
            found = sort_out(table.recipe, bronze)
            lakehouse.rejected_table(name).replace(found.rejected)
            rows = table.dedupe(found.clean)
        else:
            rows = table.transform(bronze, strict)
        result = load_silver(table, silver_target(lakehouse, table), rows)
        outcome.row_count = result.changed if isinstance(result, MergeCounts) else result
    return result


class _FactSums:
    """The fact's kept groupings, in tables beside it, and the state of the fact that they are sums of.

    They are advanced by the difference of the ranges that a build replaces. A build
    writes the fact, then the groupings, then that state; where one died in between,
    the fact has other files than the state says and the next build sums it anew.
    """

    def __init__(self, spark: SparkSession, lakehouse: Lakehouse, groupings: Sequence[Sequence[str]]):
        self.spark, self.lakehouse = spark, lakehouse
        self.sums = KeptSums([tuple(sorted(g)) for g in groupings], gold.MEASURES, lambda df: materialise(df, "sums"))
        self.of = lakehouse.table(lakehouse.gold, "fact_sales_summed")

    def table(self, grouping: tuple[str, ...]) -> Table:
        return self.lakehouse.table(self.lakehouse.gold, f"fact_sales_by_{'_and_'.join(grouping) or 'nothing'}")

    def _now(self, fact: Table) -> Changes:
        self.of.create_if_absent(self.spark, self.spark.createDataFrame([], STATE).schema)
        return changes(self.spark, self.of.read(self.spark), {"fact_sales": fact})

    def fit(self, fact: Table) -> bool:
        """Whether all groupings are there and of the fact as it is."""
        there = all(self.table(g).exists(self.spark) for g in self.sums.groupings)
        return there and not self._now(fact).ranges

    def change(self, old: DataFrame, fact: Table, ranges: Sequence[int]) -> DataFrame:
        """What replacing ``ranges`` did, once it is done. old: the rows that they held before."""
        return materialise(self.sums.change(old, fact.read(self.spark, list(ranges))), "sums-change")

    def write(self, fact: Table, change: DataFrame | None) -> None:
        """Advance the groupings, or sum the whole fact."""
        if change is None:
            made = self.sums.built(fact.read(self.spark))
        else:
            made = self.sums.advanced({g: self.table(g).read(self.spark) for g in self.sums.groupings}, change)
        for grouping, df in made.items():
            self.table(grouping).replace(df)
        if fact.ranges:
            self.of.replace(self._now(fact).state)

    def read(self) -> dict[tuple[str, ...], DataFrame]:
        """The groupings, those of fewest rows first; rows are counted in the file footers."""
        made = {g: self.table(g).read(self.spark) for g in self.sums.groupings}
        rows = {g: df.count() for g, df in made.items()}
        return {g: made[g] for g in sorted(made, key=lambda g: (rows[g], g))}


def gold_model(spark: SparkSession, lakehouse: Lakehouse, groupings: Sequence[Sequence[str]] = ()) -> StarModel:
    """The stored star. groupings: those that its builds keep; queries that they cover don't read the fact."""
    tables = gold_tables(spark, lakehouse)
    kept = _FactSums(spark, lakehouse, groupings).read() if groupings else {}
    dims = (tables[n] for n in ("dim_customers", "dim_products", "dim_date"))
    return gold.sales_model(tables["fact_sales"], *dims, groupings=kept)


def gold_tables(spark: SparkSession, lakehouse: Lakehouse) -> dict[str, DataFrame]:
    names = ("dim_customers", "dim_products", "dim_date", "fact_sales")
    return {n: lakehouse.table(lakehouse.gold, n).read(spark) for n in names}


# The largest change time of an order whose rows are all in the fact, as a property of the fact.
FACT_MARK = "lakeloom.mark"


def _shared_ranges(fact: Table, orders: Table, items: Table) -> Ranges | None:
    """The ranges of ``order_id`` that all three tables have, if they have the same."""
    ranges = orders.ranges
    alike = ranges and ranges.column == "order_id" and items.ranges == ranges and fact.ranges == ranges
    return ranges if alike else None


def _newer(
    spark: SparkSession, fact: Table, orders: Table, items: Table, dims: Dims, mark: Column, lookback: Column | None
) -> DataFrame:
    """Fact rows of orders changed after the mark. Of tables that share their ranges of ``order_id``, only
    ranges with changed orders are read."""
    ranges = orders.ranges
    wanted = None
    if ranges and ranges.column == "order_id" and items.ranges == ranges:
        wanted = ranges.listed(gold.changed_orders(orders.read(spark), mark, lookback))
    known = fact.read(spark, wanted if fact.ranges == ranges else None)
    return gold.fact_sales_increment(
        known, items.read(spark, wanted), orders.read(spark, wanted), *dims, lookback=lookback, mark=mark
    )


class _FactState:
    """What the last build knew of the fact's sources and of its checks, in tables beside it."""

    def __init__(self, spark: SparkSession, lakehouse: Lakehouse):
        self.spark, self.checks = spark, RangeChecks("fact_sales", gold.GOLD_CHECKS)

        def state(name: str, schema: str) -> Table:
            table = lakehouse.table(lakehouse.gold, f"fact_sales_{name}")
            table.create_if_absent(spark, spark.createDataFrame([], schema).schema)
            return table

        self.sources = state("sources", STATE)
        self.checked, self.parents = state("checked", CHECK_STATE), state("parents", PARENT_STATE)
        self.built = state("built", STATE)

    def check(self, fact: Table, tables: dict[str, DataFrame]) -> DataFrame:
        """The fact's checks. Only ranges whose files are others than at the last check are checked again."""
        moved = changes(self.spark, self.built.read(self.spark), {"fact_sales": fact})
        parents = materialise(self.checks.parents(tables), "parents")

        def read(ranges: Sequence[int] | None) -> DataFrame:
            return fact.placed(self.spark, ranges).withColumnRenamed(RANGE, "number")

        state = self.checks.advanced(
            self.checked.read(self.spark), self.parents.read(self.spark), parents, read, moved.ranges
        )
        # the ranges come last: a build that dies before checks them again, which gives the same
        self.checked.replace(state)
        self.parents.replace(parents)
        self.built.replace(moved.state)
        return self.checks.results(self.checked.read(self.spark), parents)


def _first_changes(spark: SparkSession, lakehouse: Lakehouse, orders: Table, items: Table) -> Changes | None:
    """All ranges of both sources, for a fact that has the same."""
    fact = lakehouse.table(lakehouse.gold, "fact_sales")
    if not _shared_ranges(fact, orders, items):
        return None
    return changes(spark, spark.createDataFrame([], STATE), {"orders": orders, "order_items": items})


def build_gold(
    spark: SparkSession,
    lakehouse: Lakehouse,
    as_of: str | None = None,
    every_price: bool = False,
    catch_up: bool = True,
    check: bool = True,
    first_day: str | None = None,
    last_day: str | None = None,
    lookback: str | None = None,
    groupings: Sequence[Sequence[str]] = (),
) -> DataFrame:
    """Rebuild the dimensions, add to the fact, then check the star.

    The first run builds the whole fact. The mark from which the next run goes on
    is kept beside the fact and moved when the merge is done, so a run that died
    at any point is simply run again. Returns the check results; failures raise
    unless ``check`` is off.

    catch_up:  everything that changed in silver reaches the fact, whatever its change
               time. Of tables that share their ranges of ``order_id``, ranges that look as
               they did at the last build are not read, and only the others are checked
               again; without ranges, the whole fact is compared. Without ``catch_up`` only
               orders changed after the mark are looked at.
    lookback:  without ``catch_up``, how far to go back behind the mark, as ``7 days``.
    first_day, last_day: of the date dimension; by default it covers all orders.
    groupings: fact columns by which sums of the fact are kept, for ``gold_model``. With ranges they are
               advanced by what the build replaces; else they are summed anew.
    """

    def silver(name: str) -> Table:
        return silver_target(lakehouse, SILVER[name])

    def target(name: str, *keys: str) -> Table:
        return lakehouse.table(lakehouse.gold, name, keys)

    def read(name: str) -> DataFrame:
        return silver(name).read(spark)

    target("dim_customers").replace(gold.dim_customers(read("customers")))
    target("dim_products").replace(
        gold.dim_products(read("products"), read("supplier_price_list"), as_of, every_price)
    )
    days = gold.dim_date_covering(read("orders"), "order_date", first_day, last_day)
    target("dim_date").replace(days)
    dims = (target("dim_customers").read(spark), target("dim_products").read(spark))
    fact = target("fact_sales", "order_item_id")
    reached = fact.properties(spark).get(FACT_MARK)
    orders, items = silver("orders").opened(spark), silver("order_items").opened(spark)
    sums, change = _FactSums(spark, lakehouse, groupings) if groupings else None, None
    if not reached:  # there is none, or its first build did not end
        found = _first_changes(spark, lakehouse, orders, items)
        # written once, where it stays
        fact.replace(gold.short_fact(items.read(spark), orders.read(spark), *dims), gold.full_fact)
        rows = fact.read(spark)
    elif not catch_up:
        found, mark = None, F.lit(reached).cast("timestamp_ntz")
        back = F.expr(f"interval {lookback}") if lookback else None
        rows = materialise(_newer(spark, fact.opened(spark), orders, items, dims, mark, back), "increment")
        fact.upsert(rows, count_target=False, stored=True)
    elif _shared_ranges(fact.opened(spark), orders, items):
        found = changes(spark, _FactState(spark, lakehouse).sources.read(spark), {"orders": orders, "order_items": items})
        of = (items.read(spark, found.ranges), orders.read(spark, found.ranges))
        held = fact.opened(spark)
        old = held.held(spark, found.ranges) if sums and sums.fit(held) else None
        held.replace_ranges(gold.short_fact(*of, *dims), found.ranges, gold.full_fact)
        rows = held.read(spark, found.ranges)
        if old is not None:
            change = sums.change(old, held, found.ranges)
    else:
        found = None
        whole = gold.short_fact(items.read(spark), orders.read(spark), *dims)
        rows = materialise(gold.fact_sales_difference(whole, fact.read(spark)), "increment")
        fact.upsert(rows, count_target=False, stored=True)
    newest = rows.agg(F.max("updated_at").cast("string")).first()[0]
    fact.set_property(spark, FACT_MARK, max(filter(None, (reached, newest, LOWEST_WATERMARK))))
    if sums:
        sums.write(fact.opened(spark), change)
    if found:
        _FactState(spark, lakehouse).sources.replace(found.state)

    tables = gold_tables(spark, lakehouse)
    ranged = _shared_ranges(fact.opened(spark), orders, items)
    if ranged:
        of_dims = [c for c in gold.GOLD_CHECKS if c.table != "fact_sales"]
        results = run_checks(tables, of_dims).unionByName(_FactState(spark, lakehouse).check(fact.opened(spark), tables))
    else:
        results = run_checks(tables, gold.GOLD_CHECKS)
    results = materialise(results, "checks")
    if check:
        require_passed(results)
    return results
