"""Tiny silver tables of one shop."""

from datetime import date, datetime
from decimal import Decimal as D


def day(n: int) -> datetime:
    return datetime(2025, 1, n)


def customers(spark, ids=(1, 2)):
    return spark.createDataFrame(
        [(i, f"C{i}", f"c{i}@example.com", "Pune" if i % 2 else "Surat", date(2024, 1, i), day(i))
         for i in ids],
        "customer_id int, customer_name string, email string, city string, "
        "signup_date date, updated_at timestamp_ntz",
    )


def products(spark, ids=(1, 2)):
    return spark.createDataFrame(
        [(i, f"P{i}", "Books" if i % 2 else "Toys", D(10 * i), day(i)) for i in ids],
        "product_id int, product_name string, category string, "
        "unit_price decimal(10,2), updated_at timestamp_ntz",
    )


def prices(spark, *rows):
    rows = rows or ((1, D("4.50"), date(2025, 1, 1)),)
    return spark.createDataFrame(
        [(p, f"P{p}", "S", cost, since) for p, cost, since in rows],
        "product_id int, product_name string, supplier_name string, "
        "supplier_cost decimal(12,2), effective_date date",
    )


def orders(spark, *rows):
    """(order_id, customer_id, status, updated_at)"""
    return spark.createDataFrame(
        [(o, c, date(2025, 1, 1), s, D(1), day(1), u) for o, c, s, u in rows],
        "order_id int, customer_id int, order_date date, status string, "
        "order_amount decimal(12,2), created_at timestamp_ntz, updated_at timestamp_ntz",
    )


def items(spark, *rows):
    """(order_item_id, order_id, product_id, quantity, item_price)"""
    return spark.createDataFrame(
        [(i, o, p, q, D(price), day(1)) for i, o, p, q, price in rows],
        "order_item_id int, order_id int, product_id int, quantity int, "
        "item_price decimal(10,2), created_at timestamp_ntz",
    )
