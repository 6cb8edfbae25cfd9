from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from lakeloom import cli
from lakeloom.operators.quality import QualityError
from lakeloom.plans import audit, jobs, range_state
from lakeloom.plans.audit import AuditRecord, audited
from lakeloom.plans.ingest import ingest, land_csv
from lakeloom.plans.jobs import build_gold, run_silver, silver_target
from lakeloom.plans.silver import SILVER
from lakeloom.sinks import write_batch, write_full
from lakeloom.sinks.tables import MergeCounts, Ranges, Table
from lakeloom.sources import JdbcSource, read_batch, read_full

START = datetime(2025, 2, 1, 1, 0, 0, 123456)


def log(spark, lakehouse):
    return lakehouse.audit_table().read(spark).orderBy("start_time").collect()


# -- audit -------------------------------------------------------------------
def test_success_is_recorded(spark, lakehouse):
    with audited(lakehouse.audit_sink(spark), AuditRecord("Silver", "t", "a")) as outcome:
        outcome.row_count = 2**40
    (row,) = log(spark, lakehouse)
    assert (row.status, row.row_count, row.error_message) == ("SUCCESS", 2**40, None)
    assert row.start_time <= row.end_time
    assert len(row) == 17


def test_failure_is_recorded_and_raised(spark, lakehouse):
    with pytest.raises(ValueError), audited(
        lakehouse.audit_sink(spark), AuditRecord("Silver", "t", "a")
    ):
        raise ValueError("x" * 50_000 + " root cause")
    (row,) = log(spark, lakehouse)
    assert (row.status, row.row_count) == ("FAIL", None)
    assert row.error_message == "x" * 50_000 + " root cause"


def test_parallel_tasks_all_leave_their_row(spark, lakehouse):
    def task(n):
        with audited(lakehouse.audit_sink(spark), AuditRecord("Silver", f"t{n}", "a")) as outcome:
            outcome.row_count = n

    for after in (7, 14, 21):
        with ThreadPoolExecutor(7) as pool:
            list(pool.map(task, range(7)))
        found = log(spark, lakehouse)
        assert len(found) == after and {r.source_name for r in found} == {f"t{n}" for n in range(7)}


def test_a_broken_log_does_not_hide_the_error():
    def broken(record):
        raise OSError("log is down")

    with pytest.raises(KeyError), audited(broken, AuditRecord("Silver", "t", "a")):
        raise KeyError("the error")
    with pytest.raises(OSError), audited(broken, AuditRecord("Silver", "t", "a")):
        pass


def test_missing_times_become_now(spark):
    row = audit.audit_frame(spark, [AuditRecord("Bronze", "t", "a")]).first()
    assert row.start_time == row.end_time is not None


# -- silver ------------------------------------------------------------------
def test_full_refresh_job(spark, lakehouse, rows):
    write_full(fx.customers(spark, (1, 2, 3)), lakehouse.bronze, "customers")
    record = AuditRecord("", "", "", pipeline_run_id="p", task_name="t")
    assert run_silver(spark, lakehouse, "customers", "2025-01-01", record) == 3
    write_full(fx.customers(spark, (4,)), lakehouse.bronze, "customers")
    assert run_silver(spark, lakehouse, "customers") == 1
    first, _ = log(spark, lakehouse)
    assert (first.layer, first.source_name, first.load_type, first.row_count) == (
        "Silver", "customers", "FULL_REFRESH", 3,
    )
    assert (first.pipeline_run_id, first.task_name, first.run_date) == ("p", "t", None)


def test_upsert_job_and_late_replay(spark, lakehouse, rows):
    days = {
        "2025-01-01": [(1, 1, "Placed", fx.day(1)), (1, 1, "Shipped", fx.day(2)), (2, 1, "Placed", None)],
        "2025-01-02": [(1, 1, "Delivered", fx.day(5)), (3, 1, "Placed", fx.day(5)), (None, 1, "x", None)],
    }
    for run_date, batch in days.items():
        write_batch(fx.orders(spark, *batch), lakehouse.bronze, "orders", run_date)
    assert run_silver(spark, lakehouse, "orders", "2025-01-01") == MergeCounts(0, 2, 0, 2)
    assert run_silver(spark, lakehouse, "orders", "2025-01-02") == MergeCounts(2, 2, 1, 1)
    # an old batch again, and a day without a batch: nothing changes
    assert run_silver(spark, lakehouse, "orders", "2025-01-01") == MergeCounts(3, 2, 0, 0)
    assert run_silver(spark, lakehouse, "orders", "2025-01-03") == MergeCounts(3, 0, 0, 0)
    table = silver_target(lakehouse, SILVER["orders"]).read(spark)
    assert rows(table.select("order_id", "status")) == [
        (1, "Delivered"), (2, "Placed"), (3, "Placed"),
    ]
    assert [r.row_count for r in log(spark, lakehouse)] == [2, 2, 0, 0]


def test_insert_only_job(spark, lakehouse, rows):
    write_batch(
        fx.items(spark, (1, 1, 1, 1, "5"), (1, 1, 1, 0, "9"), (2, 1, 1, 0, "5")),
        lakehouse.bronze, "order_items", "2025-01-01",
    )
    write_batch(
        fx.items(spark, (1, 1, 1, 7, "7"), (3, 1, 1, 1, "7")),
        lakehouse.bronze, "order_items", "2025-01-02",
    )
    assert run_silver(spark, lakehouse, "order_items", "2025-01-01") == MergeCounts(0, 1, 0, 1)
    assert run_silver(spark, lakehouse, "order_items", "2025-01-02") == MergeCounts(1, 2, 0, 1)
    table = silver_target(lakehouse, SILVER["order_items"]).read(spark)
    assert rows(table.select("order_item_id", "quantity")) == [(1, 1), (3, 1)]


def test_batch_tables_need_a_run_date(spark, lakehouse):
    with pytest.raises(ValueError, match="run_date"):
        run_silver(spark, lakehouse, "orders")


def test_failing_job(spark, lakehouse):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_silver(spark, lakehouse, "payments", "2025-01-01")
    (row,) = log(spark, lakehouse)
    assert (row.status, row.source_name) == ("FAIL", "payments")
    assert "payments" in row.activity_name


# -- gold --------------------------------------------------------------------
def load(spark, lakehouse, name, df):
    target = silver_target(lakehouse, SILVER[name])
    if SILVER[name].incremental:
        target.upsert(df)
    else:
        target.replace(df)


@pytest.mark.parametrize("ranged", [False, True])
def test_gold_is_built_and_added_to(spark, lakehouse, rows, ranged):
    if ranged:
        split = {
            f"{lakehouse.silver}.orders": Ranges("order_id", 1),
            f"{lakehouse.silver}.order_items": Ranges("order_id", 1),
            f"{lakehouse.gold}.fact_sales": Ranges("order_id", 1),
        }
        lakehouse = replace(lakehouse, ranges=split)
    load(spark, lakehouse, "customers", fx.customers(spark))
    load(spark, lakehouse, "products", fx.products(spark))
    load(spark, lakehouse, "supplier_price_list", fx.prices(spark))
    load(spark, lakehouse, "orders", fx.orders(spark, (1, 1, "Placed", fx.day(1)), (2, 2, "Placed", fx.day(2))))
    load(spark, lakehouse, "order_items", fx.items(spark, (10, 1, 1, 2, "5"), (20, 2, 2, 1, "3")))
    assert build_gold(spark, lakehouse).count() == 19

    fact = lakehouse.table(lakehouse.gold, "fact_sales")
    assert rows(fact.read(spark).select("order_item_id", "revenue")) == [(10, D(10)), (20, D(3))]

    load(spark, lakehouse, "orders", fx.orders(spark, (1, 1, "Shipped", fx.day(3)), (3, 2, "Placed", fx.day(4))))
    load(
        spark, lakehouse, "order_items",
        fx.items(spark, (11, 1, 1, 1, "5"), (21, 2, 2, 1, "3"), (30, 3, 2, 1, "3")),
    )
    build_gold(spark, lakehouse, catch_up=False)
    loaded = [(10, "Shipped"), (11, "Shipped"), (20, "Placed"), (30, "Placed")]
    assert rows(fact.read(spark).select("order_item_id", "status")) == loaded
    build_gold(spark, lakehouse, catch_up=False)
    assert rows(fact.read(spark).select("order_item_id", "status")) == loaded
    build_gold(spark, lakehouse)  # finds the item that came after its order
    assert [r[0] for r in rows(fact.read(spark).select("order_item_id"))] == [10, 11, 20, 21, 30]


def two_days(spark, lakehouse):
    """A lake whose gold was built once; since then an order changed, one is new, and an item came late."""
    ranges = {
        f"{schema}.{name}": Ranges("order_id", 1)
        for schema, name in ((lakehouse.silver, "orders"), (lakehouse.silver, "order_items"), (lakehouse.gold, "fact_sales"))
    }
    lakehouse = replace(lakehouse, ranges=ranges)
    load(spark, lakehouse, "customers", fx.customers(spark))
    load(spark, lakehouse, "products", fx.products(spark))
    load(spark, lakehouse, "supplier_price_list", fx.prices(spark))
    load(spark, lakehouse, "orders", fx.orders(spark, (1, 1, "Placed", fx.day(1)), (2, 2, "Placed", fx.day(2))))
    load(spark, lakehouse, "order_items", fx.items(spark, (10, 1, 1, 2, "5"), (20, 2, 2, 1, "3")))
    build_gold(spark, lakehouse)
    load(
        spark, lakehouse, "orders",
        fx.orders(spark, (1, 1, "Shipped", fx.day(9)), (2, 2, "Shipped", fx.day(8)), (3, 2, "Placed", fx.day(4))),
    )
    load(spark, lakehouse, "order_items", fx.items(spark, (30, 3, 2, 1, "3"), (11, 1, 1, 1, "5")))
    return lakehouse


@pytest.mark.parametrize("dies_in", ["_write_version", "_move", "_point_ranges", "set_property"])
@pytest.mark.parametrize("catch_up", [True, False])
def test_a_build_that_died_is_run_again(spark, lakehouse, rows, monkeypatch, dies_in, catch_up):
    lakehouse = two_days(spark, lakehouse)
    whole, calls = getattr(Table, dies_in), []

    def dying(self, *args):
        if not self.name.endswith("fact_sales"):
            return whole(self, *args)
        calls.append(args)
        if len(calls) == (2 if dies_in == "_move" else 1):  # the first of several partitions is moved
            raise OSError("executor lost")
        return whole(self, *args)

    monkeypatch.setattr(Table, dies_in, dying)
    with pytest.raises(OSError):
        build_gold(spark, lakehouse, catch_up=catch_up)
    monkeypatch.undo()
    build_gold(spark, lakehouse, catch_up=catch_up)
    fact = lakehouse.table(lakehouse.gold, "fact_sales").read(spark)
    assert rows(fact.select("order_item_id", "status")) == [
        (10, "Shipped"), (11, "Shipped"), (20, "Shipped"), (30, "Placed"),
    ]


def test_a_first_build_that_died_starts_anew(spark, lakehouse, rows, monkeypatch):
    monkeypatch.setattr(Table, "set_property", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        two_days(spark, lakehouse)
    monkeypatch.undo()
    build_gold(spark, lakehouse)
    fact = lakehouse.table(lakehouse.gold, "fact_sales").read(spark)
    assert rows(fact.select("order_item_id")) == [(10,), (20,)]


def changed(spark, lakehouse):
    """The ranges that the next build will read."""
    known = lakehouse.table(lakehouse.gold, "fact_sales_sources").read(spark)
    sources = {name: silver_target(lakehouse, SILVER[name]).opened(spark) for name in ("orders", "order_items")}
    return range_state.changes(spark, known, sources).ranges


@pytest.mark.parametrize("ranged", [True, False])
def test_a_change_below_the_mark_reaches_the_fact(spark, lakehouse, rows, ranged):
    plain = lakehouse
    lakehouse = two_days(spark, lakehouse)
    build_gold(spark, lakehouse)
    if ranged:
        assert changed(spark, lakehouse) == []
    else:
        lakehouse = replace(plain, gold=f"{plain.gold}_plain")
        lakehouse.create_schemas(spark)
        build_gold(spark, lakehouse)
    # the mark is the ninth: this change is older, though newer than the order's last
    load(spark, lakehouse, "orders", fx.orders(spark, (3, 2, "Delivered", fx.day(5))))
    if ranged:
        assert changed(spark, lakehouse) == [3]
    build_gold(spark, lakehouse)
    fact = lakehouse.table(lakehouse.gold, "fact_sales").read(spark)
    assert rows(fact.select("order_item_id", "status")) == [
        (10, "Shipped"), (11, "Shipped"), (20, "Shipped"), (30, "Delivered"),
    ]


def test_orphans_do_not_make_a_range_late(spark, lakehouse, rows):
    lakehouse = two_days(spark, lakehouse)
    load(spark, lakehouse, "order_items", fx.items(spark, *((k * 10, k, 1, 1, "5") for k in range(50, 60))))
    load(spark, lakehouse, "orders", fx.orders(spark, *((k, 1, "Placed", fx.day(1)) for k in range(50, 60, 2))))
    build_gold(spark, lakehouse)
    assert changed(spark, lakehouse) == []
    load(spark, lakehouse, "orders", fx.orders(spark, (51, 1, "Placed", fx.day(1))))
    assert changed(spark, lakehouse) == [51]
    build_gold(spark, lakehouse)
    fact = lakehouse.table(lakehouse.gold, "fact_sales").read(spark)
    assert [r[0] for r in rows(fact.where("order_id >= 50").select("order_id"))] == [50, 51, 52, 54, 56, 58]


def test_only_ranges_with_something_new_are_read(spark, lakehouse):
    lakehouse = two_days(spark, lakehouse)
    many = [(k, 1, "Placed", fx.day(1)) for k in range(100, 120)]
    load(spark, lakehouse, "orders", fx.orders(spark, *many))
    load(spark, lakehouse, "order_items", fx.items(spark, *((k * 10, k, 1, 1, "5") for k in range(100, 119))))
    build_gold(spark, lakehouse)
    load(spark, lakehouse, "order_items", fx.items(spark, (1190, 119, 1, 1, "5")))
    fact = lakehouse.table(lakehouse.gold, "fact_sales", ("order_item_id",))
    assert changed(spark, lakehouse) == [119]
    build_gold(spark, lakehouse)
    assert fact.read(spark).where("order_item_id = 1190").count() == 1


def test_calendar_covers_the_orders_or_what_is_asked(spark, lakehouse):
    lakehouse = two_days(spark, lakehouse)
    days = lambda: lakehouse.table(lakehouse.gold, "dim_date").read(spark).agg(F.min("date_day"), F.max("date_day")).first()
    assert tuple(map(str, days())) == ("2024-01-01", "2026-12-31")
    with pytest.raises(QualityError, match="relationships.fact_sales.order_date."):
        build_gold(spark, lakehouse, first_day="2026-06-01", last_day="2027-02-01")
    assert tuple(map(str, days())) == ("2026-06-01", "2027-02-01")
    late = fx.orders(spark, (5, 1, "Placed", fx.day(20)))
    load(spark, lakehouse, "orders", late.withColumn("order_date", F.lit("2031-05-05").cast("date")))
    build_gold(spark, lakehouse)
    assert tuple(map(str, days())) == ("2024-01-01", "2031-05-05")


def test_failed_checks_stop_the_build(spark, lakehouse):
    load(spark, lakehouse, "customers", fx.customers(spark, (1,)))
    load(spark, lakehouse, "products", fx.products(spark, (2,)))
    load(spark, lakehouse, "supplier_price_list", fx.prices(spark))
    load(spark, lakehouse, "orders", fx.orders(spark, (1, 1, "Placed", fx.day(1))))
    load(spark, lakehouse, "order_items", fx.items(spark, (10, 1, 1, 2, "5")))
    with pytest.raises(QualityError, match="not_null.fact_sales.product_key.=1"):
        build_gold(spark, lakehouse)
    results = build_gold(spark, lakehouse, check=False)
    assert results.where("failures > 0").count() == 1


# -- ingestion ---------------------------------------------------------------
def seeded(spark, lakehouse):
    low = datetime(1900, 1, 1)
    lakehouse.seed_control(
        spark,
        [
            ("customers", "dbo", "full", None, low),
            ("orders", "dbo", "incremental", "updated_at", low),
        ],
    )


def marks(spark, lakehouse):
    control = lakehouse.control_table().read(spark).collect()
    return {r.table_name: r.last_loaded_at for r in control}


def test_ingestion_copies_only_what_is_new(spark, lakehouse):
    seeded(spark, lakehouse)
    seeded(spark, lakehouse)  # keeps the rows there are
    sources = {
        "customers": fx.customers(spark),
        "orders": fx.orders(spark, (1, 1, "a", fx.day(1)), (2, 1, "b", datetime(2025, 2, 1, 1))),
    }
    run = lambda day, start: ingest(
        spark, lakehouse, lambda schema, table: sources[table], day, run_start=start
    )
    assert run("2025-02-01", START) == {"customers": 2, "orders": 2}
    assert set(marks(spark, lakehouse).values()) == {datetime(2025, 2, 1, 1)}
    # the row at the mark is not copied again
    sources["orders"] = sources["orders"].unionByName(
        fx.orders(spark, (3, 1, "c", datetime(2025, 2, 1, 2)))
    )
    assert run("2025-02-02", datetime(2025, 2, 2)) == {"customers": 2, "orders": 1}
    assert read_batch(spark, lakehouse.bronze, "orders", "2025-02-01").count() == 2
    assert read_full(spark, lakehouse.bronze, "customers").count() == 2
    assert [r.status for r in log(spark, lakehouse)] == ["SUCCESS"] * 4
    assert {r.run_date for r in log(spark, lakehouse)} == {None}


def test_a_failing_source_keeps_its_mark_and_the_others_run(spark, lakehouse):
    seeded(spark, lakehouse)

    def reader(schema, table):
        if table == "customers":
            raise ConnectionError("no route")
        return fx.orders(spark, (1, 1, "a", fx.day(1)))

    with pytest.raises(ConnectionError):
        ingest(spark, lakehouse, reader, "2025-02-01", run_start=START)
    assert marks(spark, lakehouse) == {
        "customers": datetime(1900, 1, 1), "orders": datetime(2025, 2, 1, 1),
    }
    assert {(r.source_name, r.status) for r in log(spark, lakehouse)} == {
        ("customers", "FAIL"), ("orders", "SUCCESS"),
    }


def test_two_runs_on_a_day_and_a_failed_one(spark, lakehouse, rows):
    source = [(k, 1, "a", fx.day(k)) for k in (1, 2)]
    run = lambda start: ingest(
        spark, lakehouse, lambda schema, table: fx.orders(spark, *source), "2025-02-01", run_start=start
    )
    lakehouse.seed_control(spark, [("orders", "dbo", "incremental", "updated_at", None)])
    assert run(fx.day(2)) == {"orders": 2}
    source += [(3, 1, "b", fx.day(3)), (4, 1, "b", fx.day(4))]
    # a run that died after it had written some of its rows, before the mark was moved
    write_batch(fx.orders(spark, source[2]), lakehouse.bronze, "orders", "2025-02-01", since=fx.day(2))
    assert run(fx.day(4)) == {"orders": 2}
    assert run(fx.day(5)) == {"orders": 0}
    batch = read_batch(spark, lakehouse.bronze, "orders", "2025-02-01")
    assert rows(batch.select("order_id")) == [(1,), (2,), (3,), (4,)]
    assert batch.columns == fx.orders(spark, source[0]).columns
    assert run_silver(spark, lakehouse, "orders", "2025-02-01").inserts == 4


def test_rows_without_a_mark_arrive_and_are_counted(spark, lakehouse, rows):
    source = [(1, 1, "a", fx.day(1)), (2, 1, "b", None)]
    run = lambda start: ingest(
        spark, lakehouse, lambda schema, table: fx.orders(spark, *source), "2025-02-01", run_start=start
    )
    lakehouse.seed_control(spark, [("orders", "dbo", "incremental", "updated_at", None)])
    assert run(fx.day(2)) == {"orders": 2}
    source[1:] = [(2, 1, "c", None), (3, 1, "d", None)]
    assert run(fx.day(4)) == {"orders": 2}
    batch = read_batch(spark, lakehouse.bronze, "orders", "2025-02-01")
    assert rows(batch.select("order_id", "status")) == [(1, "a"), (2, "c"), (3, "d")]
    counted = [(r.activity_name, r.row_count) for r in log(spark, lakehouse) if "without" in r.activity_name]
    assert sorted(counted) == [("Rows without updated_at: orders", n) for n in (1, 2)]


def test_ingestion_into_an_empty_lake(spark, lakehouse):
    sources = {
        "customers": fx.customers(spark), "products": fx.products(spark),
        "orders": fx.orders(spark, (1, 1, "a", fx.day(1))), "order_items": fx.items(spark, (1, 1, 1, 1, "5")),
        "payments": fx.orders(spark, (1, 1, "a", fx.day(1))),
    }
    copied = ingest(spark, lakehouse, lambda schema, table: sources[table], "2025-02-01", run_start=START)
    assert set(copied) == set(sources) and min(copied.values()) >= 1
    assert set(marks(spark, lakehouse).values()) == {datetime(2025, 2, 1, 1)}


def test_from_csv_and_bronze_to_gold(spark, lakehouse, tmp_path):
    prices = tmp_path / "prices.csv"
    prices.write_text("product_id,product_name,supplier_name,supplier_cost,effective_date\n1,A, S ,2.50,2025-01-01\n2,B,S,x,2025-01-01\n")
    assert land_csv(spark, lakehouse, str(tmp_path), "prices.csv", "supplier_price_list") == 2
    spend = tmp_path / "spend.csv"
    spend.write_text("spend_date,channel,campaign,spend_amount,clicks\n2025-01-01,Mail,M_1,10.00,3\n")
    assert land_csv(spark, lakehouse, str(tmp_path), "spend.csv", "marketing_spend") == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        land_csv(spark, lakehouse, str(tmp_path), "none.csv", "marketing_spend")
    write_full(fx.customers(spark), lakehouse.bronze, "customers")
    write_full(fx.products(spark), lakehouse.bronze, "products")
    write_batch(fx.orders(spark, (1, 1, "a", fx.day(1))), lakehouse.bronze, "orders", "2025-01-01")
    write_batch(fx.items(spark, (1, 1, 1, 1, "5")), lakehouse.bronze, "order_items", "2025-01-01")
    for name in ("customers", "products", "supplier_price_list", "marketing_spend", "orders", "order_items"):
        run_silver(spark, lakehouse, name, "2025-01-01")
    build_gold(spark, lakehouse)
    dim = lakehouse.table(lakehouse.gold, "dim_products").read(spark)
    assert {r.product_id: r.supplier_cost for r in dim.collect()} == {1: D("2.50"), 2: None}
    landed = [(r.layer, r.source_name, r.status, r.row_count) for r in log(spark, lakehouse)][:3]
    assert landed == [
        ("Bronze", "supplier_price_list", "SUCCESS", 2), ("Bronze", "marketing_spend", "SUCCESS", 1),
        ("Bronze", "marketing_spend", "FAIL", None),
    ]


# -- command line ------------------------------------------------------------
def test_command_line(spark, lakehouse, capsys):
    write_full(fx.customers(spark), lakehouse.bronze, "customers")
    write_full(fx.products(spark), lakehouse.bronze, "products")
    write_full(fx.prices(spark), lakehouse.bronze, "supplier_price_list")
    write_batch(fx.orders(spark, (1, 1, "a", fx.day(1))), lakehouse.bronze, "orders", "2025-01-01")
    write_batch(fx.items(spark, (1, 1, 1, 1, "5")), lakehouse.bronze, "order_items", "2025-01-01")
    where = [
        "--root", lakehouse.root, "--silver_schema", lakehouse.silver, "--gold_schema", lakehouse.gold,
        "--in_memory_catalog",
    ]
    with pytest.raises(SystemExit, match="metastore"):
        cli.main(["gold", *where[:-1]])
    cli.main(["seed", *where])
    assert lakehouse.control_table().name == f"{lakehouse.control}.control_table"
    for name in ("customers", "products", "supplier_price_list", "orders", "order_items"):
        dated = ["--run_date", "2025-01-01"] if SILVER[name].incremental else []
        cli.main(["silver", name, *where, *dated, "--job_name", "nightly"])
    cli.main(["gold", *where])
    shown = capsys.readouterr().out
    assert "MergeCounts(before=0, incoming=1, updates=0, inserts=1)" in shown
    assert "relationships" in shown


def test_ingestion_arguments():
    args = cli.parser().parse_args(
        ["ingest", "--root", "r", "--run_date", "2025-01-01", "--jdbc_url", "jdbc:x",
         "--jdbc_option", "password=a=b", "--split", "orders:order_id:1:100:4"]
    )
    source = cli.jdbc_source(args)
    assert source.options == {"password": "a=b"}
    assert source.reader_options("dbo", "orders")["numPartitions"] == "4"


def folders(spark, name):
    out = {}
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
        detail = spark.sql(f"DESCRIBE EXTENDED {name} PARTITION ({row[0]})")
        out[row[0]] = detail.where("col_name = 'Location'").first().data_type
    return out


def test_ranges_from_the_command_line_are_remembered(spark, lakehouse):
    name = f"{lakehouse.silver}.orders"
    where = ["--root", lakehouse.root, "--silver_schema", lakehouse.silver, "--in_memory_catalog"]
    first = fx.orders(spark, *((k, 1, "a", fx.day(1)) for k in range(40)))
    write_batch(first, lakehouse.bronze, "orders", "2025-01-01")
    cli.main(["silver", "orders", *where, "--run_date", "2025-01-01", "--ranges", f"{name}:order_id:10"])
    before = folders(spark, name)
    assert len(before) == 4
    write_batch(fx.orders(spark, (15, 1, "b", fx.day(2))), lakehouse.bronze, "orders", "2025-01-02")
    cli.main(["silver", "orders", *where, "--run_date", "2025-01-02"])  # not named again
    after = folders(spark, name)
    assert {k for k in before if before[k] != after[k]} == {"key_range=1"}
    with pytest.raises(ValueError, match="was created with"):
        cli.main(["silver", "orders", *where, "--run_date", "2025-01-02", "--ranges", f"{name}:order_id:20"])


def test_audit_database_arguments(spark):
    args = cli.parser().parse_args(
        ["silver", "orders", "--root", "r", "--audit_jdbc_url", "jdbc:x", "--audit_table", "a.log", "--audit_jdbc_option", "user=me"]
    )
    assert cli.audit_sink(args, spark) is not None
    source = JdbcSource(args.audit_jdbc_url, cli.named(args.audit_jdbc_option))
    assert source.writer_options(args.audit_table) == {"url": "jdbc:x", "dbtable": "a.log", "user": "me"}
    assert cli.audit_sink(cli.parser().parse_args(["silver", "orders", "--root", "r"]), spark) is None


def test_the_fact_is_written_once_and_ranges_listed_in_few_tasks(spark, lakehouse, rows, monkeypatch):
    purposes = []
    written = jobs.materialise
    monkeypatch.setattr(jobs, "materialise", lambda df, purpose: purposes.append(purpose) or written(df, purpose))
    ranged = two_days(spark, lakehouse)
    build_gold(spark, ranged, check=False)
    fact = rows(jobs.gold_tables(spark, ranged)["fact_sales"].select("order_item_id", "status"))
    build_gold(spark, ranged, check=False)
    assert fact and rows(jobs.gold_tables(spark, ranged)["fact_sales"].select("order_item_id", "status")) == fact
    assert not {"fact", "increment"} & set(purposes)
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) < 100
