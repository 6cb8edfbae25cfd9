"""Staging: the columns of each silver table that gold reads."""

from __future__ import annotations

from pyspark.sql import DataFrame

# What each staged table consists of.
STAGED_COLUMNS = {
    "customers": ("customer_id", "customer_name", "email", "city", "signup_date"),
    "products": ("product_id", "product_name", "category", "unit_price"),
    "orders": ("order_id", "customer_id", "order_date", "status", "order_amount", "updated_at"),
    "order_items": ("order_item_id", "order_id", "product_id", "quantity", "item_price"),
    "payments": ("payment_id", "order_id", "amount", "method"),
    "supplier_price_list": (
        "product_id", "product_name", "supplier_name", "supplier_cost", "effective_date",
    ),
}


def stage(silver: DataFrame, table: str) -> DataFrame:
    """A lazy narrowing; Catalyst carries it down to the scan."""
    return silver.select(*STAGED_COLUMNS[table])
