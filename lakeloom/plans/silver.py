"""The seven silver tables: how each is cleaned, deduplicated and loaded."""

from __future__ import annotations

from dataclasses import dataclass
from enum import Enum

from pyspark.sql import DataFrame

from lakeloom.functions import as_date, as_money, as_timestamp, title_case, trimmed
from lakeloom.operators.cleaning import CleaningRecipe
from lakeloom.operators.dedupe import latest_per_key


class Load(Enum):
    FULL_REFRESH = "full refresh"
    INSERT_ONLY = "insert-only merge"
    UPSERT = "conditional upsert"


@dataclass(frozen=True)
class SilverTable:
    """One silver table.

    key:         natural key, or None where rows are not deduplicated.
    changed_at:  column that tells versions of a key apart.
    """

    name: str
    recipe: CleaningRecipe
    load: Load
    key: str | None = None
    changed_at: str | None = None

    @property
    def keys(self) -> tuple[str, ...]:
        return (self.key,) if self.key else ()

    @property
    def update_when(self) -> str | None:
        if self.load is not Load.UPSERT:
            return None
        return f"source.{self.changed_at} > target.{self.changed_at}"

    @property
    def incremental(self) -> bool:
        return self.load is not Load.FULL_REFRESH

    def transform(
        self, bronze: DataFrame, strict: bool = False, clean_first: bool = True
    ) -> DataFrame:
        """Bronze rows to silver rows. ``strict`` raises on text that does not
        convert; ``clean_first=False`` deduplicates before validating."""

        converted = self.recipe.convert(bronze, strict)
        if clean_first:
            return self.dedupe(self.recipe.keep_valid(converted))
        return self.recipe.keep_valid(self.dedupe(converted))

    def dedupe(self, rows: DataFrame) -> DataFrame:
        """The latest version per key, of a table that has one."""
        if self.key is None:
            return rows
        order = [self.changed_at] if self.changed_at in rows.columns else []
        return latest_per_key(rows, [self.key], order)


# The columns that each table converts and requires.
SILVER = {
    table.name: table
    for table in (
        SilverTable(
            "customers",
            CleaningRecipe({"city": title_case, "signup_date": as_date}, ("customer_id",)),
            Load.FULL_REFRESH, "customer_id", "updated_at",
        ),
        SilverTable(
            "products",
            CleaningRecipe({"product_name": trimmed, "category": trimmed}, ("product_id",)),
            Load.FULL_REFRESH, "product_id", "updated_at",
        ),
        SilverTable(
            "marketing_spend",
            CleaningRecipe(
                {
                    "spend_date": as_date, "channel": trimmed, "campaign": trimmed,
                    "spend_amount": as_money,
                },
                ("spend_date", "spend_amount", "clicks"),
            ),
            Load.FULL_REFRESH,
        ),
        SilverTable(
            "supplier_price_list",
            CleaningRecipe(
                {
                    "product_name": trimmed, "supplier_name": trimmed,
                    "supplier_cost": as_money, "effective_date": as_date,
                },
                ("product_id", "supplier_cost"),
            ),
            Load.FULL_REFRESH,
        ),
        SilverTable(
            "orders",
            CleaningRecipe({"order_date": as_date, "order_amount": as_money}, ("order_id",)),
            Load.UPSERT, "order_id", "updated_at",
        ),
        SilverTable(
            "order_items",
            CleaningRecipe(
                {}, ("order_item_id", "order_id", "product_id"), ("quantity > 0", "item_price >= 0")
            ),
            Load.INSERT_ONLY, "order_item_id", "created_at",
        ),
        SilverTable(
            "payments",
            CleaningRecipe(
                {
                    "amount": as_money, "method": trimmed,
                    "paid_at": as_timestamp, "updated_at": as_timestamp,
                },
                ("payment_id", "order_id"),
            ),
            Load.UPSERT, "payment_id", "updated_at",
        ),
    )
}
