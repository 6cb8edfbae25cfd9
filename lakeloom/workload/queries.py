"""Registered queries: one per operator or recipe, over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import high_water_mark, surrogate_key
from lakeloom.functions.calendar import calendar_columns
from lakeloom.operators import dedupe, merge, quality
from lakeloom.operators.quarantine import REASONS, RECORD, TIMES, replay
from lakeloom.plans import gold
from lakeloom.plans.audit import AuditRecord, compact
from lakeloom.plans.ingest import advanced, ingest, land_csv
from lakeloom.plans.jobs import build_gold, gold_model, load_silver, run_silver, silver_target
from lakeloom.plans.lakehouse import Lakehouse
from lakeloom.plans.silver import SILVER
from lakeloom.plans.staging import STAGED_COLUMNS, stage
from lakeloom.session import materialise, workspace
from lakeloom.sinks import write_batch, write_full, write_unmarked
from lakeloom.sinks.tables import COMPRESSION, Ranges, Table
from lakeloom.sources import control_rows, extract, read_batch, read_csv, read_full
from lakeloom.sources.control import CONTROL_SEED
from lakeloom.sources.delimited import CSV_COLUMNS, CSV_FORMAT
from lakeloom.sources.footers import statistics
from lakeloom.sources.splits import even_splits
from lakeloom.streaming import stream_silver
from lakeloom.workload.roles import CUTOFF, Roles

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ORDER_KEY, ITEM_KEY = ["order_id"], ["order_item_id"]
NEWER = "source.updated_at > target.updated_at"
FOOTER_COLUMNS = {"orders": ["o_orderkey", "o_custkey"], "lineitem": ["l_orderkey", "l_partkey", "l_linenumber"]}
RUN_DATE = "2026-01-31"
RUN_START = datetime(2026, 1, 31, 1, 0, 0)
# Orders of a partition; in production enough for some gigabytes.
RANGE_WIDTH = 10_000


def query(run: Callable[[Roles], DataFrame]) -> Callable[[Roles], DataFrame]:
    QUERIES[run.__name__] = lambda spark, sf_dir: run(Roles(spark, sf_dir))
    return run


def new_lakehouse(r: Roles, *partitioned: str) -> Lakehouse:
    """An empty lakehouse of its own for one run of a query.

    partitioned: silver tables and the fact that are split by ranges of ``order_id``.
    """
    tag = uuid.uuid4().hex[:10]
    silver, gold_schema = f"silver_{tag}", f"gold_{tag}"
    ranges = {
        f"{gold_schema if name == 'fact_sales' else silver}.{name}": Ranges("order_id", RANGE_WIDTH)
        for name in partitioned
    }
    lakehouse = Lakehouse(
        workspace(r.spark, "lakehouse"), silver, gold_schema, f"etl_{tag}", ranges
    )
    lakehouse.create_schemas(r.spark)
    return lakehouse


def counted(df: DataFrame, table: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(table).alias("table"), "rows")


def all_of(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# -- scans -------------------------------------------------------------------
@query
def bronze_full_scan(r: Roles) -> DataFrame:
    return read_full(r.spark, r.sf_dir, "lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"
    )


@query
def bronze_batch_scan(r: Roles) -> DataFrame:
    base = workspace(r.spark, "bronze")
    new = r.orders.where(F.col("order_date") >= F.lit(CUTOFF).cast("timestamp_ntz"))
    write_batch(r.orders_before, base, "orders", "2026-01-30")
    write_batch(r.orders, base, "orders", RUN_DATE)
    write_batch(new, base, "orders", RUN_DATE)  # run again: replaces this day only
    return all_of(
        [
            read_batch(r.spark, base, "orders", day).withColumn("batch", F.lit(day))
            for day in ("2026-01-30", RUN_DATE, "2026-02-01")
        ]
    )


@query
def bronze_mixed_layout(r: Roles) -> DataFrame:
    """Days written as a whole, as batches by their marks, and with rows that have no mark, read together and by day."""
    base, new = workspace(r.spark, "bronze"), F.col("order_date") >= F.lit(CUTOFF).cast("timestamp_ntz")
    write_batch(r.orders_before, base, "orders", "2026-01-30")
    for since, part in ((datetime(2026, 1, 30), F.col("order_id") % 2 == 0), (RUN_START, F.col("order_id") % 2 == 1)):
        write_batch(r.orders.where(new & part), base, "orders", RUN_DATE, since=since)
    write_unmarked(r.orders.where(F.col("order_date").isNull()), base, "orders", RUN_DATE)
    return all_of(
        [
            read_full(r.spark, base, "orders").withColumn("batch", F.lit("all")),
            *(read_batch(r.spark, base, "orders", day).withColumn("batch", F.lit(day)) for day in (RUN_DATE, "2026-02-01")),
        ]
    )


@query
def csv_source_scan(r: Roles) -> DataFrame:
    folder = workspace(r.spark, "csv")
    columns = [*r.marketing_spend.columns, "note"]
    noted = r.marketing_spend.withColumn(
        "note", F.concat(F.lit('say "'), F.col("channel"), F.lit('", please'))
    )
    noted.write.options(header=True, quote='"', escape="\\", ignoreLeadingWhiteSpace=False,
                        ignoreTrailingWhiteSpace=False).csv(f"{folder}/spend")
    return read_csv(r.spark, folder, "spend", columns)


@query
def catalog_table_scan(r: Roles) -> DataFrame:
    lakehouse = new_lakehouse(r)
    target = lakehouse.table(lakehouse.silver, "marketing_spend")
    target.replace(r.silver("marketing_spend").where(F.col("channel") == "view"))
    target.replace(r.silver("marketing_spend"))
    return target.read(r.spark)


def _control(r: Roles) -> DataFrame:
    """Control rows whose marks are those of the orders dated before the cutoff."""
    return _with_marks(r, [row[:4] for row in CONTROL_SEED])


def _with_marks(r: Roles, rows: list[tuple]) -> DataFrame:
    marks = r.orders_before.agg(F.max("updated_at").alias("last_loaded_at"))
    return marks.select(
        F.explode(
            F.array(
                *(
                    F.struct(
                        F.lit(name).alias("table_name"),
                        F.lit(schema).alias("source_schema"),
                        F.lit(load).alias("load_type"),
                        F.lit(column).cast("string").alias("watermark_column"),
                    )
                    for name, schema, load, column in rows
                )
            )
        ).alias("c"),
        "last_loaded_at",
    ).select("c.*", "last_loaded_at")


@query
def incremental_extract(r: Roles) -> DataFrame:
    rows = {row.table_name: row for row in control_rows(_control(r))}
    return extract(r.orders, rows["orders"])


@query
def control_lookup(r: Roles) -> DataFrame:
    return all_of(
        [
            counted(extract(getattr(r, row.table_name), row), row.table_name).withColumn(
                "load_type", F.lit(row.load_type)
            )
            for row in control_rows(_control(r))
        ]
    )


@query
def high_water_marks(r: Roles) -> DataFrame:
    """Mark of the older orders, and of a table with no rows."""
    mark = high_water_mark(r.orders_before, "updated_at")
    empty = high_water_mark(r.orders.where(F.lit(False)), "updated_at")
    flags = r.orders.select((F.col("updated_at") > mark).alias("past"),
                            (F.col("updated_at") > empty).alias("ever"))
    return flags.agg(F.count_if("past").alias("past_mark"), F.count_if("ever").alias("past_lowest"))


# -- silver ------------------------------------------------------------------
@query
def silver_customers(r: Roles) -> DataFrame:
    return r.silver("customers", r.customer_versions)


@query
def silver_products(r: Roles) -> DataFrame:
    return r.silver("products", r.product_versions)


@query
def silver_marketing_spend(r: Roles) -> DataFrame:
    return r.silver("marketing_spend")


@query
def silver_supplier_price_list(r: Roles) -> DataFrame:
    return r.silver("supplier_price_list")


@query
def silver_orders(r: Roles) -> DataFrame:
    both = r.orders.unionByName(r.order_changes)
    return r.silver("orders", both)


@query
def silver_order_items(r: Roles) -> DataFrame:
    return r.silver("order_items")


def _items_with_faults(r: Roles) -> DataFrame:
    """Items where small quantities became zero and some prices negative, and some
    order and product numbers those of none."""
    return r.order_items.withColumns(
        {
            "order_id": F.when(F.col("quantity") > 47, -F.col("order_id")).otherwise(F.col("order_id")),
            "product_id": F.when(F.col("quantity") == 40, -F.col("product_id")).otherwise(F.col("product_id")),
            "quantity": F.when(F.col("quantity") < 10, 0).otherwise(F.col("quantity")),
            "item_price": F.when(F.col("quantity") > 45, -F.col("item_price"))
            .otherwise(F.col("item_price"))
            .cast("decimal(10,2)"),
        }
    )


@query
def silver_order_items_clean_first(r: Roles) -> DataFrame:
    return SILVER["order_items"].transform(_items_with_faults(r))


@query
def silver_order_items_dedupe_first(r: Roles) -> DataFrame:
    return SILVER["order_items"].transform(_items_with_faults(r), clean_first=False)


@query
def silver_payments(r: Roles) -> DataFrame:
    return r.silver("payments")


@query
def cleaning_rejects(r: Roles) -> DataFrame:
    def of(name: str, bronze: DataFrame) -> DataFrame:
        rejected = SILVER[name].recipe.reject_counts(bronze)
        return rejected.select(F.lit(name).alias("table"), "rule", "rejected")

    return all_of(
        [of("marketing_spend", r.marketing_spend), of("order_items", _items_with_faults(r))]
    )


@query
def latest_per_key(r: Roles) -> DataFrame:
    """Latest shipment of each part."""
    shipments = r.read("lineitem").select(
        "l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"
    )
    return dedupe.latest_per_key(shipments, ["l_partkey"], ["l_shipdate"])


@query
def rank_equals_one(r: Roles) -> DataFrame:
    """Latest shipment of each supplier, by rank."""
    shipments = r.read("lineitem").select(
        "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"
    )
    return dedupe.first_ranked(shipments, ["l_suppkey"], ["l_shipdate"])


@query
def distinct_by_key(r: Roles) -> DataFrame:
    """One event per user and type, null types in a group of their own."""
    events = r.read("events").select(
        "user_id", F.nullif("event_type", F.lit("error")).alias("event_type"), "event_id", "value"
    )
    return dedupe.one_per_key(events, ["user_id", "event_type"])


# -- staging -----------------------------------------------------------------
def _staging_query(table: str) -> None:
    QUERIES[f"stg_{table}"] = lambda spark, sf_dir: stage(Roles(spark, sf_dir).silver(table), table)


for _table in STAGED_COLUMNS:
    _staging_query(_table)


@query
def staging_row_counts(r: Roles) -> DataFrame:
    return all_of([counted(stage(r.silver(t), t), t) for t in STAGED_COLUMNS])


# -- merges ------------------------------------------------------------------
def _merge_inputs(r: Roles) -> tuple[DataFrame, DataFrame]:
    return r.silver("orders", r.orders_before), r.silver("orders", r.order_changes)


def _item_batches(r: Roles) -> list[DataFrame]:
    before = F.col("created_at") < F.lit(CUTOFF).cast("timestamp_ntz")
    dearer = (F.col("item_price") + 1).cast("decimal(10,2)")
    return [r.order_items.where(before), r.order_items.withColumn("item_price", dearer)]


def _item_inputs(r: Roles) -> tuple[DataFrame, DataFrame]:
    """Items shipped before the cutoff, and a batch of all items at a new price."""
    before, batch = _item_batches(r)
    return r.silver("order_items", before), r.silver("order_items", batch)


@query
def upsert_orders(r: Roles) -> DataFrame:
    target, source = _merge_inputs(r)
    return merge.upsert(target, source, ORDER_KEY, NEWER, large_batch=True)


@query
def upsert_orders_small_batch(r: Roles) -> DataFrame:
    """The same with the joins that spare the target, meant for a small batch."""
    target, source = _merge_inputs(r)
    return merge.upsert(target, source, ORDER_KEY, NEWER)


@query
def upsert_replay(r: Roles) -> DataFrame:
    target, source = _merge_inputs(r)
    once = merge.upsert(target, source, ORDER_KEY, NEWER, large_batch=True)
    return merge.upsert(once, source, ORDER_KEY, NEWER, large_batch=True)


@query
def upsert_bloom(r: Roles) -> DataFrame:
    """The same with a filter of the batch's keys, which keeps orders without a change out of the joins."""
    target, source = _merge_inputs(r)
    return merge.upsert(target, source, ORDER_KEY, NEWER, batch_rows=source.count())


@query
def insert_only_bloom(r: Roles) -> DataFrame:
    target, source = _item_inputs(r)
    return merge.insert_only(target, source, ITEM_KEY, batch_rows=source.count())


@query
def upsert_null_keys(r: Roles) -> DataFrame:
    """Urgent orders lose their key on both sides: none of them matches."""
    target, source = _merge_inputs(r)

    def lose(df: DataFrame) -> DataFrame:
        return df.withColumn("order_id", F.when(F.col("order_amount") < 400000, F.col("order_id")))

    merged = merge.upsert(lose(target), lose(source), ORDER_KEY, NEWER)
    return merged.groupBy("status", F.col("order_id").isNull().alias("no_key")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("order_amount").cast("decimal(22,2)").alias("amount"),
    )


@query
def insert_only_items(r: Roles) -> DataFrame:
    target, source = _item_inputs(r)
    return merge.insert_only(target, source, ITEM_KEY)


@query
def update_candidates(r: Roles) -> DataFrame:
    target, source = _merge_inputs(r)
    return merge.update_candidates(target, source, ORDER_KEY, NEWER)


@query
def insert_candidates(r: Roles) -> DataFrame:
    target, source = _merge_inputs(r)
    return merge.unmatched(source, target, ORDER_KEY)


@query
def merge_actions(r: Roles) -> DataFrame:
    target, source = _merge_inputs(r)
    actions = merge.classify(target, source, ORDER_KEY, NEWER)
    return actions.select("order_id", merge.ACTION)


@query
def upsert_summary(r: Roles) -> DataFrame:
    target, source = _merge_inputs(r)
    return merge.upsert_summary(target, source, ORDER_KEY, NEWER)


@query
def insert_only_summary(r: Roles) -> DataFrame:
    target, source = _item_inputs(r)
    return merge.upsert_summary(target, source, ITEM_KEY, "false")


@query
def duplicate_source_keys(r: Roles) -> DataFrame:
    return merge.duplicate_keys(r.order_items, ITEM_KEY)


def _orders_table(lakehouse: Lakehouse) -> Table:
    return silver_target(lakehouse, SILVER["orders"])


@query
def table_upsert_orders(r: Roles) -> DataFrame:
    """First run, then the change batch, into a table split by key range."""
    lakehouse = new_lakehouse(r, "orders")
    table, (target, source) = _orders_table(lakehouse), _merge_inputs(r)
    load_silver(SILVER["orders"], table, target)
    load_silver(SILVER["orders"], table, source)
    return table.read(r.spark)


@query
def table_upsert_counts(r: Roles) -> DataFrame:
    """Counts of a first run, the change batch and its replay, plain layout."""
    lakehouse = new_lakehouse(r)
    table, (target, source) = _orders_table(lakehouse), _merge_inputs(r)
    runs = [load_silver(SILVER["orders"], table, df) for df in (target, source, source)]
    rows = [
        (n, c.before, c.incoming, c.updates, c.inserts, c.after, c.changed)
        for n, c in enumerate(runs, 1)
    ]
    return r.spark.createDataFrame(
        rows,
        "run int, before_count long, incoming_count long, update_count long, "
        "insert_count long, after_count long, row_count long",
    )


@query
def table_insert_only_items(r: Roles) -> DataFrame:
    lakehouse = new_lakehouse(r, "order_items")
    table = silver_target(lakehouse, SILVER["order_items"])
    for batch in _item_inputs(r):
        load_silver(SILVER["order_items"], table, batch)
    return table.read(r.spark)


@query
def table_created_if_absent(r: Roles) -> DataFrame:
    lakehouse = new_lakehouse(r)
    table = silver_target(lakehouse, SILVER["payments"])
    rows = r.silver("payments")
    table.create_if_absent(r.spark, rows.schema)
    table.create_if_absent(r.spark, rows.schema)
    found = r.spark.createDataFrame([("created", table.read(r.spark).count())], "table string, rows long")
    load_silver(SILVER["payments"], table, rows)
    return all_of([found, counted(table.read(r.spark), "loaded")])


# -- ingestion and audit -----------------------------------------------------
def _loaded_lakehouse(r: Roles) -> tuple[Lakehouse, Callable[[str, str], DataFrame]]:
    """A lakehouse whose sources were all loaded up to the cutoff's mark."""
    lakehouse = new_lakehouse(r)
    control = lakehouse.control_table()
    control.replace(_control(r))
    return lakehouse, lambda schema, table: getattr(r, table)


@query
def watermark_advance(r: Roles) -> DataFrame:
    lakehouse, _ = _loaded_lakehouse(r)
    control = lakehouse.control_table()
    control.replace(advanced(control.read(r.spark), "orders", RUN_START))
    return control.read(r.spark)


@query
def ingest_control_run(r: Roles) -> DataFrame:
    """Rows of each bronze table after a control-table run, and the new marks."""
    lakehouse, reader = _loaded_lakehouse(r)
    ingest(r.spark, lakehouse, reader, RUN_DATE, run_start=RUN_START)
    control = lakehouse.control_table().read(r.spark)
    bronze = [
        counted(read_full(r.spark, lakehouse.bronze, row.table_name), row.table_name)
        for row in control_rows(control)
    ]
    marks = control.select(F.col("table_name").alias("table"), "load_type", "last_loaded_at")
    return all_of(bronze).join(marks, "table")


@query
def ingest_twice_a_day(r: Roles) -> DataFrame:
    """Silver orders after two ingestions on one day, with what a failed one left between them."""
    lakehouse = new_lakehouse(r)
    first, opened = F.lit(CUTOFF).cast("timestamp_ntz"), datetime.fromisoformat(CUTOFF)
    early = {"orders": r.orders.where(F.col("updated_at") <= first)}
    ingest(r.spark, lakehouse, lambda _, t: early.get(t, getattr(r, t)), RUN_DATE, run_start=opened)
    left = r.orders.where((F.col("updated_at") > first) & (F.col("order_id") % 2 == 0))
    write_batch(left, lakehouse.bronze, "orders", RUN_DATE, since=opened)
    ingest(r.spark, lakehouse, lambda _, t: getattr(r, t), RUN_DATE, run_start=RUN_START)
    if read_batch(r.spark, lakehouse.bronze, "orders", RUN_DATE).count() != r.orders.count():
        raise AssertionError("an order was lost or came twice")
    run_silver(r.spark, lakehouse, "orders", RUN_DATE)
    return _orders_table(lakehouse).read(r.spark)


@query
def csv_to_silver_prices(r: Roles) -> DataFrame:
    """The price list from a CSV file over bronze to silver."""
    lakehouse, folder = new_lakehouse(r), workspace(r.spark, "csv")
    exact = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    r.supplier_price_list.write.options(header=True, **exact).csv(f"{folder}/prices")
    land_csv(r.spark, lakehouse, folder, "prices", "supplier_price_list")
    run_silver(r.spark, lakehouse, "supplier_price_list")
    table = silver_target(lakehouse, SILVER["supplier_price_list"])
    return table.read(r.spark).withColumn("product_id", F.col("product_id").cast("long"))


@query
def quarantine_prices(r: Roles) -> DataFrame:
    """Price lines with a field too many are mended and played again; cut lines and amounts that are no numbers stay."""
    lakehouse, folder, name = new_lakehouse(r), workspace(r.spark, "csv"), "supplier_price_list"
    columns, kind = CSV_COLUMNS[name], F.col("product_id") % 10
    cost = F.when(kind == 7, "n/a").otherwise(F.col("supplier_cost"))
    line = F.to_csv(F.struct(*columns), {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    line = F.when(kind == 3, F.concat(line, F.lit(",surplus"))).when(kind == 5, F.substring_index(line, ",", 2)).otherwise(line)
    lines = r.supplier_price_list.withColumn("supplier_cost", cost).select(line.alias(",".join(columns)))
    exact = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escapeQuotes": False}
    lines.write.options(header=True, sep="\u0001", quote="", **exact).csv(f"{folder}/prices")

    land_csv(r.spark, lakehouse, folder, "prices", name, quarantine=True)
    run_silver(r.spark, lakehouse, name, quarantine=True)
    broken = lakehouse.rejected_table(f"{name}_lines").read(r.spark)
    mended = broken.withColumn(RECORD, F.regexp_replace(RECORD, ",surplus$", ""))
    again = replay(SILVER[name].recipe, mended, CSV_FORMAT)

    def outcome(rows: DataFrame, what: str | Column) -> DataFrame:
        what = F.lit(what) if isinstance(what, str) else what
        times = F.col(TIMES) if TIMES in rows.columns else F.lit(1)
        paid = F.col("supplier_cost").try_cast("decimal(12,2)")
        return rows.select(F.col("product_id").cast("long"), what.alias("outcome"), times.alias("n"), paid.alias("cost"))

    each = all_of(
        [
            outcome(silver_target(lakehouse, SILVER[name]).read(r.spark), "clean"),
            outcome(again.clean, "replayed"),
            *(outcome(df, F.array_join(REASONS, "; ")) for df in (again.rejected, lakehouse.rejected_table(name).read(r.spark))),
        ]
    )
    return each.groupBy("product_id", "outcome").agg(
        F.sum("n").cast("long").alias("n"), F.sum("cost").cast("decimal(22,2)").alias("cost")
    )


@query
def marks_from_footers(r: Roles) -> DataFrame:
    """Rows and bounds of the whole-number columns of the orders' and the items' files."""
    files = {t: f"{r.sf_dir}/{t}.parquet" for t in FOOTER_COLUMNS}
    return all_of([statistics(r.spark, f, FOOTER_COLUMNS[t]).withColumn("table", F.lit(t)) for t, f in files.items()])


@query
def extract_splits(r: Roles) -> DataFrame:
    """How many of the readers' conditions each order meets, and whether its split has a fair share of all orders.

    The key is sparse, denser at its lower end, and missing on a part of the orders.
    """
    parts, meets = 8, "condition"
    key = F.when(F.col("order_id") % 11 != 0, F.col("order_id") * F.col("order_id"))
    keyed = r.orders.select("order_id", key.alias("key"))
    readers = [F.when(F.expr(p), F.lit(i)) for i, p in enumerate(even_splits(keyed, "key", parts))]
    met = keyed.select("order_id", F.array_compact(F.array(*readers)).alias(meets))
    split = F.get(meets, F.lit(0))
    shares = met.groupBy(split.alias("split")).agg(F.count(F.lit(1)).alias("n"))
    total = keyed.agg(F.count(F.lit(1))).scalar()
    fair = shares.select("split", (F.col("n") * parts <= total * 2).alias("fair"))
    placed = met.select("order_id", F.size(meets).alias("times"), split.alias("split"))
    return placed.join(fair, "split").select("order_id", "times", "fair")


def _audited_runs(r: Roles, between: Callable[[Lakehouse], object] = lambda _: None) -> DataFrame:
    """The audit log of three good runs and a failing one; ``between`` is called after each."""
    lakehouse = new_lakehouse(r)
    write_full(r.customer_versions, lakehouse.bronze, "customers")
    write_full(r.marketing_spend, lakehouse.bronze, "marketing_spend")
    write_batch(r.orders, lakehouse.bronze, "orders", RUN_DATE)
    record = AuditRecord("", "", "", orchestrator="lakeloom", pipeline_run_id="p-1")
    for table, run_date in (("customers", None), ("marketing_spend", None), ("orders", RUN_DATE)):
        run_silver(r.spark, lakehouse, table, run_date, record)
        between(lakehouse)
    try:
        run_silver(r.spark, lakehouse, "marketing_spend", record=record, strict=True)
    except Exception:
        pass  # text that does not convert; the log has it
    return lakehouse.audit_table().read(r.spark).select(
        "layer", "source_name", "activity_name", "load_type", "run_date", "pipeline_run_id",
        "status", "row_count",
        F.col("error_message").isNotNull().alias("has_error"),
        (F.col("end_time") >= F.col("start_time")).alias("timed"),
    )


@query
def audit_summary(r: Roles) -> DataFrame:
    """The audit log of three good runs and a failing one."""
    return _audited_runs(r)


@query
def audit_compacted(r: Roles) -> DataFrame:
    """The same of a log whose partitions are joined after each run, and forgotten at once."""
    return _audited_runs(r, lambda lakehouse: compact(r.spark, lakehouse.audit_table(), timedelta(0)))


# -- gold --------------------------------------------------------------------
@query
def dim_customers(r: Roles) -> DataFrame:
    return r.dim_customers


@query
def dim_products(r: Roles) -> DataFrame:
    return r.dim_products


@query
def dim_products_as_of(r: Roles) -> DataFrame:
    return gold.dim_products(r.silver("products"), r.silver("supplier_price_list"), as_of=CUTOFF)


@query
def dim_products_every_price(r: Roles) -> DataFrame:
    return gold.dim_products(
        r.silver("products"), r.silver("supplier_price_list"), every_price=True
    )


@query
def dim_products_unpriced(r: Roles) -> DataFrame:
    """Only suppliers with low numbers list prices: other products have no margin."""
    few = r.silver("supplier_price_list").where(F.col("supplier_cost") < 2000)
    return gold.dim_products(r.silver("products"), few)


@query
def dim_date(r: Roles) -> DataFrame:
    return r.dim_date


@query
def order_calendar(r: Roles) -> DataFrame:
    """Calendar attributes of every shipment day, week 53 and all."""
    days = r.read("lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("day"))
    return days.select("l_orderkey", "l_linenumber", "day", *calendar_columns(F.col("day")))


@query
def surrogate_keys(r: Roles) -> DataFrame:
    """Composite keys with null parts."""
    status = F.nullif("status", F.lit("O"))
    return r.orders.select(
        "order_id",
        surrogate_key("order_id").alias("order_key"),
        surrogate_key("customer_id", status).alias("customer_status_key"),
    )


@query
def fact_sales_full(r: Roles) -> DataFrame:
    return r.fact()


@query
def fact_sales_unknown_members(r: Roles) -> DataFrame:
    """Dimensions that lack members: facts stay, their keys are null."""
    customers = r.dim_customers.where(F.col("city").startswith("H"))
    products = r.dim_products.where(F.col("category") != "PROMO")
    return gold.fact_sales(r.silver("order_items"), r.silver("orders"), customers, products)


def _fact_increment(r: Roles, **options) -> tuple[DataFrame, DataFrame]:
    """The fact of yesterday's orders without its late items, and its increment
    once all orders and items are there."""
    on_time = r.order_items.where(F.col("created_at") < F.lit(CUTOFF).cast("timestamp_ntz"))
    fact = gold.fact_sales(
        r.silver("order_items", on_time),
        r.silver("orders", r.orders_before),
        r.dim_customers,
        r.dim_products,
    )
    fact = materialise(fact, "fact", COMPRESSION)  # a stored table, as the fact is
    increment = gold.fact_sales_increment(
        fact, r.silver("order_items"), r.silver("orders"), r.dim_customers, r.dim_products, **options
    )
    return fact, increment


def _merged_fact(r: Roles, **options) -> DataFrame:
    fact, increment = _fact_increment(r, **options)
    # the merge reads its batch more than once, so it is staged as in a table merge
    # what catching up finds may be most of the fact
    return gold.fact_sales_merged(fact, materialise(increment, "increment", COMPRESSION), large=options.get("catch_up", False))


@query
def fact_sales_increment(r: Roles) -> DataFrame:
    return _fact_increment(r)[1]


@query
def fact_sales_incremental(r: Roles) -> DataFrame:
    return _merged_fact(r)


@query
def fact_sales_catch_up(r: Roles) -> DataFrame:
    return _merged_fact(r, catch_up=True)


@query
def fact_sales_lookback(r: Roles) -> DataFrame:
    year = F.expr("interval 365 days")
    return _fact_increment(r, lookback=year)[1]


def _built_gold(
    r: Roles, lakehouse: Lakehouse | None = None, orders: DataFrame | None = None, **options
) -> tuple[Lakehouse, DataFrame]:
    """Silver loaded in two daily batches, gold built after each. orders: other ones for the second day."""
    lakehouse = lakehouse or new_lakehouse(r, "orders", "order_items", "fact_sales")
    for name in ("customers", "products", "supplier_price_list"):
        load_silver(SILVER[name], silver_target(lakehouse, SILVER[name]), r.silver(name))
    on_time = r.order_items.where(F.col("created_at") < F.lit(CUTOFF).cast("timestamp_ntz"))
    second = r.orders if orders is None else orders
    for placed, items in ((r.orders_before, on_time), (second, r.order_items)):
        for name, bronze in (("orders", placed), ("order_items", items)):
            load_silver(SILVER[name], silver_target(lakehouse, SILVER[name]), r.silver(name, bronze))
        results = build_gold(r.spark, lakehouse, check=False, **options)
    return lakehouse, results


def _fact_of(r: Roles, lakehouse: Lakehouse) -> DataFrame:
    return lakehouse.table(lakehouse.gold, "fact_sales").read(r.spark)


@query
def gold_fact_table(r: Roles) -> DataFrame:
    return _fact_of(r, _built_gold(r)[0])


def _late_update(r: Roles, lakehouse: Lakehouse) -> None:
    """Orders that change a second after their last change, far below the fact's mark."""
    late = r.orders.where((F.col("order_id") % 7 == 0) & F.col("updated_at").isNotNull())
    late = late.withColumns(
        {"status": F.concat(F.lit("late "), "status"), "updated_at": F.col("updated_at") + F.expr("interval 1 second")}
    )
    load_silver(SILVER["orders"], _orders_table(lakehouse), r.silver("orders", late))


@query
def gold_fact_late_update(r: Roles) -> DataFrame:
    lakehouse, _ = _built_gold(r)
    _late_update(r, lakehouse)
    build_gold(r.spark, lakehouse, check=False)
    return _fact_of(r, lakehouse)


@query
def gold_fact_late_update_unranged(r: Roles) -> DataFrame:
    """The same on tables without ranges, where the whole fact is compared."""
    lakehouse, _ = _built_gold(r, new_lakehouse(r))
    _late_update(r, lakehouse)
    build_gold(r.spark, lakehouse, check=False)
    return _fact_of(r, lakehouse)


@query
def gold_fact_with_orphans(r: Roles) -> DataFrame:
    """A tenth of the orders arrives only before the last of three builds; until then their items have none."""
    lakehouse = new_lakehouse(r, "orders", "order_items", "fact_sales")
    held = r.orders.where(F.col("order_id") % 10 != 3)
    _built_gold(r, lakehouse, orders=held)
    load_silver(SILVER["orders"], _orders_table(lakehouse), r.silver("orders"))
    build_gold(r.spark, lakehouse, check=False)
    return _fact_of(r, lakehouse)


@query
def gold_checks_incremental(r: Roles) -> DataFrame:
    """The checks of the third build, which takes most of them from what the two before left."""
    lakehouse, _ = _built_gold(r)
    _late_update(r, lakehouse)
    return build_gold(r.spark, lakehouse, check=False)


@query
def gold_fact_changed_only(r: Roles) -> DataFrame:
    """Without the items that came after their order was loaded."""
    return _fact_of(r, _built_gold(r, catch_up=False)[0])


class _Interrupted(Exception):
    pass


@dataclass(frozen=True)
class _DiesMoving(Table):
    """Its second merge dies when some of its partitions were moved."""

    moves: list[int] = field(default_factory=list, compare=False)

    def _point_ranges(self, spark: SparkSession, folder: str, ranges: list[int]) -> None:
        self.moves.append(len(ranges))
        if len(self.moves) == 2:
            super()._point_ranges(spark, folder, ranges[: (len(ranges) + 1) // 2])
            raise _Interrupted
        super()._point_ranges(spark, folder, ranges)


@dataclass(frozen=True)
class _DiesOnce(Lakehouse):
    moves: list[int] = field(default_factory=list, compare=False)

    def table(self, schema: str, name: str, keys: tuple[str, ...] = ()) -> Table:
        table = super().table(schema, name, keys)
        if name != "fact_sales":
            return table
        return _DiesMoving(table.name, table.root, keys, table.ranges, moves=self.moves)


@query
def gold_fact_after_retry(r: Roles) -> DataFrame:
    """The second build dies in the middle of its merge and is run again."""
    plain = new_lakehouse(r, "orders", "order_items", "fact_sales")
    lakehouse = _DiesOnce(plain.root, plain.silver, plain.gold, plain.control, plain.ranges)
    try:
        _built_gold(r, lakehouse)
    except _Interrupted:
        build_gold(r.spark, lakehouse, check=False)
    return _fact_of(r, lakehouse)


@query
def gold_build_checks(r: Roles) -> DataFrame:
    return _built_gold(r)[1]


# -- star model --------------------------------------------------------------
@query
def star_join(r: Roles) -> DataFrame:
    return r.model.joined().select(
        "order_item_id", "revenue", "status", "dim_customers_city", "dim_products_category",
        "dim_date_year", "dim_date_month_name",
    )


def _sums(df: DataFrame) -> DataFrame:
    """Sums in the types both engines agree on."""
    types = {"revenue": "decimal(31,2)", "item_price": "decimal(20,2)", "quantity": "bigint"}
    return df.withColumns({m: F.col(m).cast(t) for m, t in types.items() if m in df.columns})


@query
def star_revenue_by_category(r: Roles) -> DataFrame:
    return _sums(r.model.query(["revenue", "quantity"], ["dim_products.category", "status"]))


@query
def star_revenue_by_month_city(r: Roles) -> DataFrame:
    by = ["dim_date.year", "dim_date.month", "dim_customers.city"]
    return _sums(r.model.query(["revenue"], by))


@query
def star_quantity_by_status(r: Roles) -> DataFrame:
    return _sums(r.model.query(["quantity", "item_price"], ["status"]))


@query
def star_filtered(r: Roles) -> DataFrame:
    """Delivered and open orders of 1997 and 1998, by quarter and product."""
    return _sums(
        r.model.query(
            ["revenue", "quantity"],
            ["dim_date.quarter", "dim_products.product_name"],
            where={"status": ["F", "O"], "dim_date.year": [1997, 1998]},
        )
    )


@query
def star_all_dimensions(r: Roles) -> DataFrame:
    by = ["dim_date.day_name", "dim_customers.city", "dim_products.category"]
    return _sums(r.model.query(["revenue", "quantity", "item_price"], by))


@query
def star_grand_total(r: Roles) -> DataFrame:
    return _sums(r.model.query(["revenue", "quantity"]))


#: Sums that the gold builds below keep.
KEPT = (("product_id", "status"), ("order_date", "status"), ("status",))


@query
def star_from_aggregate(r: Roles) -> DataFrame:
    """After late updates, from sums by product and status that the builds advanced; the fact isn't read."""
    lakehouse, _ = _built_gold(r, groupings=KEPT)
    _late_update(r, lakehouse)
    build_gold(r.spark, lakehouse, check=False, groupings=KEPT)
    model = gold_model(r.spark, lakehouse, KEPT)
    return _sums(model.query(["revenue", "quantity"], ["dim_products.category", "status"]))


# -- data quality ------------------------------------------------------------
def _gold_frames(r: Roles, every_price: bool = False) -> dict[str, DataFrame]:
    products = (
        gold.dim_products(r.silver("products"), r.silver("supplier_price_list"), every_price=True)
        if every_price
        else r.dim_products
    )
    return {
        "dim_customers": r.dim_customers.withColumn(
            "customer_id", F.when(F.col("city").startswith("M"), -1).otherwise(F.col("customer_id"))
        ),
        "dim_products": products,
        "dim_date": r.dim_date,
        "fact_sales": r.fact().withColumn(
            "product_key", F.when(F.col("quantity") < 40, F.col("product_key"))
        ),
    }


def _checks_of(kind: type, checks: tuple) -> list:
    return [c for c in checks if isinstance(c, kind)]


@query
def dq_unique(r: Roles) -> DataFrame:
    frames = _gold_frames(r, every_price=True)
    return quality.run_checks(frames, _checks_of(quality.Unique, gold.GOLD_CHECKS))


@query
def dq_not_null(r: Roles) -> DataFrame:
    return quality.run_checks(_gold_frames(r), _checks_of(quality.NotNull, gold.GOLD_CHECKS))


@query
def dq_relationships(r: Roles) -> DataFrame:
    """Against the customers of some cities and the days up to the cutoff only."""
    frames = _gold_frames(r)
    frames["dim_customers"] = frames["dim_customers"].where(F.col("city").startswith("H"))
    frames["dim_date"] = frames["dim_date"].where(F.col("date_day") < F.lit(CUTOFF).cast("date"))
    return quality.run_checks(frames, _checks_of(quality.Relationship, gold.GOLD_CHECKS))


@query
def dq_source_checks(r: Roles) -> DataFrame:
    frames = {
        "customers": r.customers,
        "products": r.products,
        "orders": r.orders,
        "order_items": _items_with_faults(r),
        "payments": r.payments,
    }
    return quality.run_checks(frames, gold.SOURCE_CHECKS)


@query
def dq_control_table(r: Roles) -> DataFrame:
    """A stored control table that got a source twice and a load type that there is none of."""
    control = new_lakehouse(r).control_table()
    wrong = [("orders", "dbo", "full", None), ("refunds", "dbo", "sometimes", None)]
    control.replace(_control(r).unionByName(_with_marks(r, wrong)))
    return quality.run_checks({"control_table": control.read(r.spark)}, gold.CONTROL_CHECKS)


@query
def orphan_rows(r: Roles) -> DataFrame:
    return quality.orphans(r.order_items, "order_id", r.orders_before, "order_id")


# -- streaming ---------------------------------------------------------------
def _streamed(r: Roles, name: str, batches: list[DataFrame], *partitioned: str, **options) -> DataFrame:
    """Each batch arrives in its own folder and is streamed before the next."""
    lakehouse = new_lakehouse(r, *partitioned)
    table, target = SILVER[name], silver_target(lakehouse, SILVER[name])
    checkpoint = workspace(r.spark, "stream")
    for day, batch in enumerate(batches, 1):
        write_batch(batch, lakehouse.bronze, name, f"2026-01-{day:02d}")
        stream_silver(
            r.spark, table, target, f"{lakehouse.bronze}/{name}", batch.schema, checkpoint, **options
        ).awaitTermination()
    return target.read(r.spark)


@query
def stream_orders_upsert(r: Roles) -> DataFrame:
    return _streamed(r, "orders", [r.orders_before, r.order_changes])


@query
def stream_items_insert_only(r: Roles) -> DataFrame:
    return _streamed(r, "order_items", _item_batches(r), "order_items")


@query
def stream_items_stateful(r: Roles) -> DataFrame:
    """Items that come twice in a batch and again in later ones; the stream's state stops them before the merge."""
    first, second = _item_batches(r)
    batches = [first.unionByName(first), second.unionByName(first), second]
    return _streamed(r, "order_items", batches, "order_items", remember="7 days")
