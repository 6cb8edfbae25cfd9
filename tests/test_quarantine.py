from decimal import Decimal as D

from pyspark.sql import functions as F

import fixtures as fx
from lakeloom.operators.quarantine import MALFORMED, REASONS, RECORD, SOURCE, TIMES, replay, sort_out
from lakeloom.plans.ingest import land_csv
from lakeloom.plans.jobs import run_silver, silver_target
from lakeloom.plans.silver import SILVER
from lakeloom.sinks import write_batch
from lakeloom.sources.delimited import CSV_COLUMNS, CSV_FORMAT, read_csv_lines

PRICES = SILVER["supplier_price_list"].recipe
HEADER = "product_id,product_name,supplier_name,supplier_cost,effective_date"
LINES = [
    '1,"A, b",S,1.50,2025-01-01',
    "2,B,S,2",
    "3,C,S,3,2025-01-01,more",
    "4,D,S,none,2025-01-01",
    ",E,S,,2025-01-01",
    ",E,S,,2025-01-01",
    "6,F,S,6,no day",
]


def folder(tmp_path, lines):
    (tmp_path / "p.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    return str(tmp_path)


def sizes(found):
    return found.clean.count(), found.rejected.agg(F.coalesce(F.sum(TIMES), F.lit(0))).first()[0]


def test_all_rows_go_one_way_with_all_reasons(spark, tmp_path, rows):
    read = read_csv_lines(spark, folder(tmp_path, LINES), "p.csv", CSV_COLUMNS["supplier_price_list"])
    found = sort_out(PRICES, read)
    assert rows(found.clean.select("product_id", "product_name", "supplier_cost")) == [("1", "A, b", D("1.50")), ("6", "F", D(6))]
    assert sizes(found) == (2, 5)
    assert rows(found.rejected.select("product_name", RECORD, REASONS, TIMES)) == sorted(
        [
            ("B", LINES[1], [MALFORMED], 1),
            ("C", LINES[2], [MALFORMED], 1),
            ("D", None, ["supplier_cost is not null"], 1),
            ("E", None, ["product_id is not null", "supplier_cost is not null"], 2),
        ],
        key=repr,
    )
    assert all(r[0].endswith("p.csv") for r in found.rejected.select(SOURCE).collect())
    assert rows(found.rejected.where("product_name = 'D'").select("supplier_cost")) == [("none",)]  # as it was read


def test_mended_rows_are_clean_and_others_stay(spark, tmp_path, rows):
    read = read_csv_lines(spark, folder(tmp_path, LINES), "p.csv", CSV_COLUMNS["supplier_price_list"])
    rejected = sort_out(PRICES, read).rejected
    mended = rejected.withColumn(RECORD, F.regexp_replace(RECORD, ",more$", ""))
    mended = mended.withColumn("product_id", F.when(F.col("product_name") == "E", "5").otherwise(F.col("product_id")))
    mended = mended.withColumn("supplier_cost", F.when(F.col("product_name") == "E", "5").otherwise(F.col("supplier_cost")))
    again = replay(PRICES, mended, CSV_FORMAT)
    assert rows(again.clean.select("product_id", "supplier_cost")) == [("3", D(3)), ("5", D(5)), ("5", D(5))]
    assert rows(again.rejected.select("product_name", RECORD, TIMES)) == [("B", LINES[1], 1), ("D", None, 1)]
    assert again.rejected.columns == rejected.columns


def test_empty_file_and_rows_without_a_source(spark, tmp_path, rows):
    read = read_csv_lines(spark, folder(tmp_path, []), "p.csv", CSV_COLUMNS["supplier_price_list"])
    assert sizes(sort_out(PRICES, read)) == (0, 0)
    found = sort_out(SILVER["order_items"].recipe, fx.items(spark, (1, 1, 1, 0, "-1"), (2, 1, 1, 1, "1")))
    assert rows(found.rejected.select("order_item_id", REASONS, SOURCE)) == [(1, ["quantity > 0", "item_price >= 0"], None)]


def test_jobs_keep_what_they_turn_away(spark, lakehouse, tmp_path, rows):
    land_csv(spark, lakehouse, folder(tmp_path, LINES), "p.csv", "supplier_price_list", quarantine=True)
    for _ in range(2):  # run again: the same rows, not twice
        run_silver(spark, lakehouse, "supplier_price_list", quarantine=True)
    lines, turned = (lakehouse.rejected_table(n).read(spark) for n in ("supplier_price_list_lines", "supplier_price_list"))
    assert (lines.count(), rows(turned.select("product_name", TIMES))) == (2, [("D", 1), ("E", 2)])
    assert silver_target(lakehouse, SILVER["supplier_price_list"]).read(spark).count() == 2
    write_batch(fx.orders(spark, (1, 1, "a", fx.day(1)), (1, 1, "b", fx.day(2)), (None, 1, "c", None)), lakehouse.bronze, "orders", "2025-01-01")
    run_silver(spark, lakehouse, "orders", "2025-01-01", quarantine=True)
    assert rows(silver_target(lakehouse, SILVER["orders"]).read(spark).select("order_id", "status")) == [(1, "b")]
    assert rows(lakehouse.rejected_table("orders").read(spark).select("status", REASONS)) == [("c", ["order_id is not null"])]
