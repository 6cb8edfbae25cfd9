"""The generic test tables in the roles of the commerce tables.

Each role is the raw, bronze form: text to trim, amounts and dates as text,
several versions per key where the test tables give them naturally.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.operators.spread import spread_join
from lakeloom.plans import gold
from lakeloom.plans.silver import SILVER
from lakeloom.session import tune

# Orders dated before this day are "yesterday's" table, the later ones are new.
CUTOFF = "2000-01-01"


def _padded(column: str | Column) -> Column:
    return F.concat(F.lit("  "), F.col(column) if isinstance(column, str) else column, F.lit(" "))


def _versions(entities: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Each entity once per change, or once without. Not a left join from the
    entities: an entity with most of the changes could not be split there."""
    changed = spread_join(changes, entities, [key], "inner", by=changes.columns)
    unchanged = entities.join(changes.select(key).distinct(), key, "left_anti")
    columns = [*entities.columns, "updated_at"]
    return changed.unionByName(unchanged, allowMissingColumns=True).select(*columns)


class Roles:
    """Lazy bronze, silver and gold frames over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}
        self._silver: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        """A test table; its footer is read once."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    # -- bronze --------------------------------------------------------------
    @cached_property
    def customers(self) -> DataFrame:
        opened = F.date_add(F.lit("2015-01-01").cast("date"), F.floor(F.abs("c_acctbal") / 10).cast("int"))
        return (
            self.read("customer")
            .join(self.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.col("c_name").alias("customer_name"),
                F.lower(F.concat("c_name", F.lit("@example.com"))).alias("email"),
                _padded(F.concat_ws(" ", "c_mktsegment", "n_name")).alias("city"),
                F.date_format(opened, "yyyy-MM-dd").alias("signup_date"),
            )
        )

    @cached_property
    def customer_versions(self) -> DataFrame:
        """One copy of a customer per order placed: daily full extracts pile up."""
        orders = self.read("orders").select(
            F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("updated_at")
        )
        return _versions(self.customers, orders, "customer_id")

    @cached_property
    def products(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").alias("product_id"),
            _padded("p_name").alias("product_name"),
            _padded("p_type").alias("category"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
        )

    @cached_property
    def product_versions(self) -> DataFrame:
        """One copy of a product per shipment."""
        shipped = self.read("lineitem").select(
            F.col("l_partkey").alias("product_id"), F.col("l_shipdate").alias("updated_at")
        )
        return _versions(self.products, shipped, "product_id")

    @cached_property
    def _orders(self) -> DataFrame:
        lag = F.make_dt_interval(F.substring("o_orderpriority", 1, 1).cast("int"))
        return self.read("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_date"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").alias("order_amount"),
            F.col("o_orderdate").alias("created_at"),
            (F.col("o_orderdate") + lag).alias("updated_at"),
            F.col("o_orderpriority").alias("priority"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self._orders.drop("priority")

    @cached_property
    def orders_before(self) -> DataFrame:
        return self.orders.where(F.col("order_date") < F.lit(CUTOFF).cast("timestamp_ntz"))

    @cached_property
    def order_changes(self) -> DataFrame:
        """A re-extract of the orders with every case a merge must tell apart.

        Orders from the cutoff on are new. Of the older ones, F are newer than
        the target, or of unknown age with priority 4; O are as old and P older.
        Orders of priority 5 were not extracted.
        """
        shift = (
            F.when((F.col("status") == "F") & F.col("priority").startswith("4"), F.lit(None))
            .when(F.col("status") == "F", F.expr("interval 30 days"))
            .when(F.col("status") == "P", F.expr("interval -1 days"))
            .otherwise(F.expr("interval 0 days"))
        )
        return (
            self._orders.where(~F.col("priority").startswith("5"))
            .withColumn("updated_at", F.col("updated_at") + shift)
            .withColumn("status", F.concat(F.lit("new "), "status"))
            .drop("priority")
        )

    @cached_property
    def order_items(self) -> DataFrame:
        """Line numbers repeat within an order: a quarter of the rows are duplicates."""
        return self.read("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("item_price"),
            F.col("l_shipdate").alias("created_at"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        """Events as versions of one payment per user, their type as its method."""
        text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return self.read("events").select(
            F.col("user_id").alias("payment_id"),
            F.col("user_id").alias("order_id"),
            F.col("value").cast("string").alias("amount"),
            _padded("event_type").alias("method"),
            text.alias("paid_at"),
            text.alias("updated_at"),
        )

    @cached_property
    def marketing_spend(self) -> DataFrame:
        """Events as text; errors have no amount, signups no valid date."""
        kind = F.col("event_type")
        clicks = F.get_json_object("props", "$.k")
        return self.read("events").select(
            F.when(kind == "signup", F.lit("2024-13-45"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd"))
            .alias("spend_date"),
            _padded("event_type").alias("channel"),
            _padded(F.concat_ws("_", "event_type", F.date_format("ts", "MM"))).alias("campaign"),
            F.when(kind == "error", F.lit("n/a"))
            .otherwise(F.col("value").cast("string"))
            .alias("spend_amount"),
            F.when(clicks != "0", clicks).alias("clicks"),
        )

    @cached_property
    def supplier_price_list(self) -> DataFrame:
        """The lowest price per product and supplier: many prices per product."""
        prices = self.read("lineitem").groupBy("l_partkey", "l_suppkey").agg(
            F.min(F.col("l_extendedprice").cast("decimal(10,2)")).alias("price"),
            F.max("l_shipdate").alias("since"),
        )
        # products last: the rows then lie by product, as those who take one price per product want them
        return (
            prices.join(self.read("supplier").select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(self.read("part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.col("l_partkey").alias("product_id"),
                _padded("p_name").alias("product_name"),
                _padded("s_name").alias("supplier_name"),
                F.col("price").cast("string").alias("supplier_cost"),
                F.date_format("since", "yyyy-MM-dd").alias("effective_date"),
            )
        )

    # -- silver --------------------------------------------------------------
    def silver(self, name: str, bronze: DataFrame | None = None) -> DataFrame:
        """The silver form of a table, or of other bronze rows for it."""
        if bronze is not None:
            return SILVER[name].transform(bronze)
        if name not in self._silver:
            self._silver[name] = SILVER[name].transform(getattr(self, name))
        return self._silver[name]

    # -- gold ----------------------------------------------------------------
    @cached_property
    def dim_customers(self) -> DataFrame:
        return gold.dim_customers(self.silver("customers"))

    @cached_property
    def dim_products(self) -> DataFrame:
        return gold.dim_products(self.silver("products"), self.silver("supplier_price_list"))

    @cached_property
    def dim_date(self) -> DataFrame:
        # the span of the raw dates holds that of the silver ones, and needs no deduplication
        return gold.dim_date_covering(self.orders, "order_date")

    def fact(self, orders: DataFrame | None = None) -> DataFrame:
        return gold.fact_sales(
            self.silver("order_items"),
            self.silver("orders") if orders is None else orders,
            self.dim_customers,
            self.dim_products,
        )

    @cached_property
    def model(self):
        return gold.sales_model(self.fact(), self.dim_customers, self.dim_products, self.dim_date)
