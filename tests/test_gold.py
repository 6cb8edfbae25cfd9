import re
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from lakeloom.operators import quality as q
from lakeloom.plans import gold
from lakeloom.session import materialise

ORDERS = ((1, 1, "Placed", fx.day(1)), (2, 2, "Cancelled", fx.day(2)))
ITEMS = ((10, 1, 1, 2, "5.00"), (11, 1, 2, 1, "3.00"), (20, 2, 1, 1, "5.00"))


def star(spark, orders=ORDERS, items=ITEMS, customer_ids=(1, 2), product_ids=(1, 2)):
    return (
        fx.items(spark, *items),
        fx.orders(spark, *orders),
        gold.dim_customers(fx.customers(spark, customer_ids)),
        gold.dim_products(fx.products(spark, product_ids), fx.prices(spark)),
    )


def test_dimension_schemas(spark):
    _, _, customers, products = star(spark)
    assert customers.columns == [
        "customer_key", "customer_id", "customer_name", "email", "city", "signup_date",
    ]
    assert products.dtypes[-2:] == [
        ("supplier_cost", "decimal(12,2)"), ("unit_margin", "decimal(13,2)"),
    ]
    margins = {r.product_id: r.unit_margin for r in products.collect()}
    assert margins == {1: D("5.50"), 2: None}


def test_price_list_is_cut_to_one_price(spark, rows):
    prices = fx.prices(
        spark,
        (1, D("4.00"), date(2025, 1, 1)),
        (1, D("6.00"), date(2025, 6, 1)),
        (1, D("9.00"), None),
    )

    def cost(**options):
        dim = gold.dim_products(fx.products(spark, (1,)), prices, **options)
        return rows(dim.select("supplier_cost"))

    assert cost() == [(D("6.00"),)]
    assert cost(as_of="2025-03-01") == [(D("4.00"),)]
    assert cost(as_of="2024-03-01") == [(None,)]
    assert len(cost(every_price=True)) == 3
    every = gold.dim_products(fx.products(spark, (1,)), prices, every_price=True)
    found = q.run_checks({"dim_products": every}, [q.Unique("dim_products", "product_id")])
    assert found.first().failures == 1


def test_date_dimension(spark):
    days = gold.dim_date(spark)
    assert days.count() == 1096
    by_day = {r.date_day: r for r in gold.dim_date(spark, "2024-12-30", "2027-01-01").collect()}
    first, last = by_day[date(2024, 12, 30)], by_day[date(2027, 1, 1)]
    assert tuple(first)[1:] == (20241230, 2024, 4, 12, "Dec", 1, 30, 2, "Mon")
    assert (last.date_key, last.week_of_year, last.day_of_week) == (20270101, 53, 6)
    assert [t for _, t in days.dtypes[:2]] == ["date", "int"]


def test_date_dimension_covers_all_days(spark):
    days = spark.createDataFrame([(date(2020, 1, 1),), (None,), (date(2026, 5, 5),)], "d date")
    span = lambda *a: tuple(map(str, gold.dim_date_covering(*a).agg(F.min("date_day"), F.max("date_day")).first()))
    assert span(days, "d") == ("2020-01-01", "2026-12-31")
    assert span(days.where("d is null"), "d") == ("2024-01-01", "2026-12-31")
    assert span(days, "d", "2021-01-01", "2021-02-01") == ("2021-01-01", "2021-02-01")


def test_fact_rows(spark, rows):
    fact = gold.fact_sales(*star(spark))
    assert rows(fact.select("order_item_id", "order_id", "revenue", "status")) == [
        (10, 1, D("10.00"), "Placed"), (11, 1, D("3.00"), "Placed"), (20, 2, D("5.00"), "Cancelled"),
    ]
    assert dict(fact.dtypes)["revenue"] == "decimal(21,2)"
    assert fact.columns == [
        "order_item_id", "order_id", "customer_key", "product_key", "customer_id", "product_id",
        "order_date", "quantity", "item_price", "revenue", "status", "updated_at",
    ]


def test_dimensions_are_joined_before_items_meet_orders(spark):
    plan = gold.fact_sales(*star(spark))._jdf.queryExecution().optimizedPlan().toString()
    kinds = re.findall(r"Join (Inner|LeftOuter)", plan)
    assert kinds == ["Inner", "LeftOuter", "LeftOuter"]  # from the outermost on


def test_missing_members_keep_the_fact_row(spark, rows):
    tables = star(spark, product_ids=(1,), items=(*ITEMS, (90, 9, 1, 1, "1.00")))
    fact = gold.fact_sales(*tables)
    assert rows(fact.select("order_item_id", F.col("product_key").isNull())) == [
        (10, False), (11, True), (20, False),
    ]
    found = q.run_checks({"fact_sales": fact}, [q.NotNull("fact_sales", "product_key")])
    assert found.first().failures == 1


def test_increment_takes_newer_orders_only(spark, rows):
    old, _, customers, products = star(spark)
    fact = gold.fact_sales(old, fx.orders(spark, *ORDERS), customers, products)
    orders = fx.orders(
        spark, (1, 1, "Shipped", fx.day(3)), (2, 2, "Cancelled", fx.day(2)), (3, 1, "Placed", fx.day(4))
    )
    # 12 and 21 arrive late; 21 belongs to an order loaded before
    items = fx.items(
        spark, *ITEMS, (12, 1, 1, 1, "1.00"), (21, 2, 2, 1, "1.00"), (30, 3, 2, 1, "3.00")
    )
    increment = gold.fact_sales_increment(fact, items, orders, customers, products)
    assert [r[0] for r in rows(increment.select("order_item_id"))] == [10, 11, 12, 30]
    merged = gold.fact_sales_merged(fact, increment)
    assert rows(merged.select("order_item_id", "status")) == [
        (10, "Shipped"), (11, "Shipped"), (12, "Shipped"), (20, "Cancelled"), (30, "Placed"),
    ]
    caught = gold.fact_sales_increment(fact, items, orders, customers, products, catch_up=True)
    whole = gold.fact_sales(items, orders, customers, products)
    assert rows(gold.fact_sales_merged(fact, caught)) == rows(whole)
    back = gold.fact_sales_increment(
        fact, items, orders, customers, products, lookback=F.expr("interval 1 day")
    )
    assert rows(gold.fact_sales_merged(fact, back)) == rows(whole)


def test_surrogate_keys_are_in_no_shuffle(spark, rows):
    tables = star(spark, items=(*ITEMS, (12, 1, 77, 4, "2.00")))
    odd = tables[3].withColumn("product_key", F.when(F.col("product_id") == 1, F.lit("own")).otherwise(F.col("product_key")))
    for products in (tables[3], odd, odd.unionByName(odd), odd.withColumn("product_key", F.lit(None).cast("string"))):
        items, orders, customers = tables[:3]
        fact = gold.fact_sales(items, orders, customers, products)
        joined = items.join(orders.drop("updated_at"), "order_id").join(customers, "customer_id", "left").join(products, "product_id", "left")
        assert rows(fact.select("order_item_id", "customer_key", "product_key")) == rows(
            joined.select("order_item_id", "customer_key", "product_key")
        )
        merged = gold.fact_sales_merged(fact.limit(0), fact)
        assert rows(merged) == rows(fact) and merged.schema == fact.schema
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = gold.fact_sales(*tables)
        for df in (fact, gold.fact_sales_merged(materialise(fact, "fact"), materialise(fact, "increment"))):
            plan = df._jdf.queryExecution().executedPlan().toString()
            # digests are made above the joins, and asked for where the dimensions or the tables are scanned
            assert "md5" in plan[: plan.index("Exchange")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_caught_up_rows_of_orders_that_come_twice(spark, rows):
    """Of an order with a changed version the unchanged one adds nothing; late items of others are taken once."""
    items, orders, customers, products = star(spark)
    fact = gold.fact_sales(items, orders, customers, products)
    twice = fx.orders(spark, *ORDERS, (1, 1, "Shipped", fx.day(9)))
    late = fx.items(spark, *ITEMS, (12, 1, 1, 1, "1.00"), (21, 2, 2, 1, "1.00"))
    got = gold.fact_sales_increment(fact, late, twice, customers, products, catch_up=True)
    assert rows(got.select("order_item_id", "status")) == [(10, "Shipped"), (11, "Shipped"), (12, "Shipped"), (21, "Cancelled")]


def test_catching_up_shuffles_rows_once_for_each_join(spark, rows):
    """Items meet the products only where they are taken, orders are told from their other versions without a join, and a
    large increment is merged in one join."""
    stored = [materialise(df, "star") for df in star(spark, items=(*ITEMS, (12, 1, None, 1, "1.00")))]
    items, orders, customers, products = stored
    fact = materialise(gold.fact_sales(items.where("order_item_id <> 11"), orders, customers, products), "fact")
    fact = fact.unionByName(fact.where("order_item_id = 20"))  # a key that comes twice is known all the same
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        caught = gold.fact_sales_increment(fact, *stored, catch_up=True)
        merged = gold.fact_sales_merged(materialise(fact, "fact"), materialise(caught, "increment"), large=True)
        shuffles = [df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for df in (caught, merged)]
        assert [r[0] for r in rows(caught.select("order_item_id"))] == [11]
        assert [r[0] for r in rows(merged.select("order_item_id"))] == [10, 11, 12, 20, 20]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shuffles[0] <= 9 and shuffles[1] == 2


def test_increment_of_an_empty_fact_is_the_whole_fact(spark, rows):
    tables = star(spark)
    whole = gold.fact_sales(*tables)
    assert rows(gold.fact_sales_increment(whole.limit(0), *tables)) == rows(whole)


def test_rebuilding_from_no_change_is_empty(spark):
    tables = star(spark)
    assert gold.fact_sales_increment(gold.fact_sales(*tables), *tables).count() == 0


@pytest.fixture
def model(spark):
    items, orders, customers, products = star(
        spark, items=(*ITEMS, (12, 1, 77, 4, "2.00")), product_ids=(1, 2)
    )
    fact = gold.fact_sales(items, orders, customers, products)
    return gold.sales_model(fact, customers, products, gold.dim_date(spark))


@pytest.mark.parametrize("eager", [True, False])
def test_model_sums(model, rows, eager):
    by_category = model.query(["revenue", "quantity"], ["dim_products.category"], eager=eager)
    assert rows(by_category) == [
        ("Books", D("15.00"), 3), ("Toys", D("3.00"), 1), (None, D("8.00"), 4),
    ]
    kept = model.query(
        ["revenue"],
        ["dim_customers.city", "dim_date.month_name"],
        where={"status": ["Placed"], "dim_products.category": "Books"},
        eager=eager,
    )
    assert rows(kept) == [("Pune", "Jan", D("10.00"))]
    assert rows(model.query(["quantity"], eager=eager)) == [(8,)]


def test_model_refuses(model):
    for measures, by in (
        (["order_id"], []),
        (["revenue"], ["order_item_id"]),
        (["revenue"], ["dim_products.nothing"]),
        (["revenue"], ["dim_products.product_id", "product_id"]),
    ):
        with pytest.raises(ValueError):
            model.query(measures, by)


def test_natural_and_surrogate_keys_give_the_same_sums(spark, rows):
    tables = star(spark)
    fact, products = gold.fact_sales(*tables), tables[3]
    natural = gold.sales_model(fact, tables[2], products, gold.dim_date(spark)).query(
        ["revenue"], ["dim_products.category"]
    )
    surrogate = fact.join(products, "product_key").groupBy("category").agg(F.sum("revenue"))
    assert rows(natural) == rows(surrogate)


def test_model_keeps_all_columns(model):
    joined = model.joined()
    assert joined.count() == 4
    assert {"dim_customers_city", "dim_products_category", "dim_date_year"} <= set(joined.columns)
