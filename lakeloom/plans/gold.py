"""The star schema: three dimensions, one fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.functions import calendar_columns, high_water_mark, surrogate_key
from lakeloom.operators.dedupe import latest_per_key
from lakeloom.operators.merge import conform, upsert
from lakeloom.operators.quality import Check, Condition, NotNull, Relationship, Unique
from lakeloom.operators.spread import spread_join
from lakeloom.operators.star import Link, StarModel
from lakeloom.plans.staging import stage

# The days the date dimension covers at least, unless told otherwise.
FIRST_DAY, LAST_DAY = "2024-01-01", "2026-12-31"


def dim_customers(customers: DataFrame) -> DataFrame:
    staged = stage(customers, "customers")
    return staged.select(surrogate_key("customer_id").alias("customer_key"), *staged.columns)


def current_prices(prices: DataFrame, as_of: str | date | None = None) -> DataFrame:
    """One price per product: the latest in effect on ``as_of`` (default: ever)."""
    staged = stage(prices, "supplier_price_list")
    if as_of is not None:
        staged = staged.where(F.col("effective_date") <= F.lit(as_of).cast("date"))
    return latest_per_key(staged, ["product_id"], ["effective_date"])


def dim_products(
    products: DataFrame,
    prices: DataFrame,
    as_of: str | date | None = None,
    every_price: bool = False,
) -> DataFrame:
    """Products with supplier cost and margin, null without a price.

    ``every_price`` joins the price list as it is: a product with several
    prices then gets several rows, and its key is no longer unique.
    """
    staged = stage(products, "products")
    if every_price:
        costs = stage(prices, "supplier_price_list").select("product_id", "supplier_cost")
        # not a left join: a product with most of the prices could not be split there
        priced = spread_join(costs, staged, ["product_id"], "inner", by=["product_id"])
        unpriced = staged.join(costs.select("product_id").distinct(), "product_id", "left_anti")
        joined = priced.unionByName(unpriced, allowMissingColumns=True)
    else:
        costs = current_prices(prices, as_of).select("product_id", "supplier_cost")
        joined = staged.join(costs, "product_id", "left")
    return joined.select(
        surrogate_key("product_id").alias("product_key"),
        *staged.columns,
        "supplier_cost",
        (F.col("unit_price") - F.col("supplier_cost")).alias("unit_margin"),
    )


def dim_date(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    """One row per day from ``first`` to ``last``."""
    span = spark.range(1).select(
        F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last")
    )
    return days_between(span)


def dim_date_covering(
    df: DataFrame, column: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """The date dimension from ``first`` to ``last``; by default the fixed days and
    every day of ``column``, so that no row of ``df`` is without one."""
    low = F.lit(first or FIRST_DAY).cast("date")
    high = F.lit(last or LAST_DAY).cast("date")
    days = F.col(column).cast("date")
    span = df.agg(
        (low if first else F.least(low, F.min(days))).alias("first"),
        (high if last else F.greatest(high, F.max(days))).alias("last"),
    )
    return days_between(span)


def days_between(span: DataFrame) -> DataFrame:
    """One row per day of each ``(first, last)`` row."""
    step = F.expr("interval 1 day")
    days = span.select(F.explode(F.sequence("first", "last", step)).alias("date_day"))
    return days.select("date_day", *calendar_columns(F.col("date_day")))


FACT_COLUMNS = (
    "order_item_id", "order_id", "customer_key", "product_key", "customer_id", "product_id",
    "order_date", "quantity", "item_price", "revenue", "status", "updated_at",
)
_NATURAL = {"customer_key": "customer_id", "product_key": "product_id"}
_DERIVED = "__derived_{}"
_HELD, _MOVED, _ANY_MOVED = "__held", "__moved", "__any_moved"


def _short_keys(members: DataFrame, rows: DataFrame, natural: str, key: str) -> DataFrame:
    """The natural keys of a dimension and what tells their surrogate keys: a flag where the key is that of the
    natural one, which ``full_fact`` computes again, else the key itself. The 32 digits then are in no shuffle."""
    flag, kind = _DERIVED.format(key), members.schema[natural].dataType
    # equal values must read alike on both sides
    same = kind == rows.schema[natural].dataType and (isinstance(kind, T.IntegralType) or kind == T.StringType())
    derived = F.lit(False)
    if same and members.schema[key].dataType == T.StringType():
        derived = F.col(key).eqNullSafe(surrogate_key(natural))
    return members.select(natural, derived.alias(flag), F.when(~derived, F.col(key)).alias(key))


def short_fact(order_items: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Fact rows as they are shuffled: without revenue and without the keys that ``full_fact`` computes.

    Of items and orders staged columns are read. The dimensions bring only their keys, left to Spark to broadcast if
    they are small enough. Customers meet the orders and products the items, before the two are joined: what is
    shuffled for them is narrow, and an order once, not once for each of its items."""
    items = stage(order_items, "order_items")
    return spread_join(_supplied(items, products), _placed(orders, customers), ["order_id"], "inner", ["order_item_id"])


def _placed(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with what tells their customer's key."""
    order_columns = orders.select("order_id", "customer_id", "order_date", "status", "updated_at")
    keys = _short_keys(customers, order_columns, "customer_id", "customer_key")
    return spread_join(order_columns, keys, ["customer_id"], "left", ["order_id"])


def _supplied(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items, or rows made of them, with what tells their product's key."""
    keys = _short_keys(products, items, "product_id", "product_key")
    return spread_join(items, keys, ["product_id"], "left", ["order_item_id"])


def _full_key(key: str) -> Column:
    return F.when(F.col(_DERIVED.format(key)), surrogate_key(_NATURAL[key])).otherwise(F.col(key))


def full_columns() -> dict[str, Column]:
    """The fact's columns of rows of ``short_fact``."""

    computed = {key: _full_key(key) for key in _NATURAL} | {"revenue": F.col("quantity") * F.col("item_price")}
    return {c: computed.get(c, F.col(c)) for c in FACT_COLUMNS}


def full_fact(rows: DataFrame) -> DataFrame:
    """Rows of ``short_fact`` with the fact's columns; any others stay behind them."""
    known = {*FACT_COLUMNS, *map(_DERIVED.format, _NATURAL)}
    others = [c for c in rows.columns if c not in known]
    return rows.select(*(value.alias(c) for c, value in full_columns().items()), *others)


def fact_sales(
    order_items: DataFrame, orders: DataFrame, dim_customers: DataFrame, dim_products: DataFrame
) -> DataFrame:
    """One row per order item. Items without an order are left out; items whose
    customer or product is unknown stay, with a null key."""
    return full_fact(short_fact(order_items, orders, dim_customers, dim_products))


def changed_orders(orders: DataFrame, mark: Column, lookback: Column | None = None) -> DataFrame:
    """Orders changed after the fact's mark, less ``lookback``."""
    return orders.where(_changed(mark, lookback))


def _changed(mark: Column, lookback: Column | None) -> Column:
    return F.col("updated_at") > (mark if lookback is None else mark - lookback)


def fact_sales_increment(
    fact: DataFrame,
    order_items: DataFrame,
    orders: DataFrame,
    dim_customers: DataFrame,
    dim_products: DataFrame,
    lookback: Column | None = None,
    catch_up: bool = False,
    mark: Column | None = None,
) -> DataFrame:
    """Fact rows of orders changed after the fact's mark.

    lookback: interval to move the mark back by, for changes that arrive late.
    catch_up: also items the fact lacks, whatever their order's change time; an
              item that arrives after its order was loaded is found only so.
    mark:     by default the largest change time in the fact. A build that writes
              the fact in steps keeps its mark elsewhere: a half-written fact
              has a mark that is too high.
    """
    all_orders = stage(orders, "orders")
    mark = high_water_mark(fact, "updated_at") if mark is None else mark
    changed = changed_orders(all_orders, mark, lookback)
    if not catch_up:
        return fact_sales(order_items, changed, dim_customers, dim_products)
    # items meet all orders once, and products only where the row is taken: that of a changed order, or one the fact lacks
    current = _one_state(all_orders, mark, lookback)
    held = fact.select("order_item_id").distinct().withColumn(_HELD, F.lit(True))
    # a plain join: items that come from their deduplication lie by this key, and stay where they are
    items = stage(order_items, "order_items").join(held, "order_item_id", "left")
    rows = spread_join(items, _placed(current, dim_customers), ["order_id"], "inner", ["order_item_id"])
    taken = rows.where(F.coalesce(_changed(mark, lookback), F.lit(False)) | F.col(_HELD).isNull()).drop(_HELD)
    return full_fact(_supplied(taken, dim_products))


def _one_state(orders: DataFrame, mark: Column, lookback: Column | None) -> DataFrame:
    """Orders without rows of before the mark, if the same order has one of after it. Orders without an id have no items."""
    moved = orders.where(F.col("order_id").isNotNull()).withColumn(_MOVED, F.coalesce(_changed(mark, lookback), F.lit(False)))
    some = moved.withColumn(_ANY_MOVED, F.max(_MOVED).over(Window.partitionBy("order_id")))
    return some.where(F.col(_MOVED) | ~F.col(_ANY_MOVED)).drop(_MOVED, _ANY_MOVED)


def fact_sales_difference(whole: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows of the whole fact, as ``short_fact`` has them, that the stored one lacks or holds otherwise, by key and a
    hash of the row."""

    def keyed(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
        return df.withColumn("__row", F.xxhash64(*(F.struct(values[c].cast(fact.schema[c].dataType)) for c in sorted(values))))

    held = keyed(fact, {c: F.col(c) for c in FACT_COLUMNS}).select("order_item_id", "__row")
    rows = keyed(whole, full_columns())
    return full_fact(spread_join(rows, held, ["order_item_id", "__row"], "left_anti", by=["__row"]).drop("__row"))


def _shortened(fact: DataFrame) -> DataFrame:
    """A fact with flags where keys and revenue are as ``full_fact`` computes them; ``_lengthened`` gives them back."""
    for c, value in _derivable(fact).items():
        fact = fact.withColumn(_DERIVED.format(c), F.col(c).eqNullSafe(value))
        fact = fact.withColumn(c, F.when(~F.col(_DERIVED.format(c)), F.col(c)))
    return fact


def _lengthened(short: DataFrame, fact: DataFrame) -> DataFrame:
    derived = _derivable(fact)
    full = {c: F.when(F.col(_DERIVED.format(c)), v).otherwise(F.col(c)).cast(fact.schema[c].dataType) for c, v in derived.items()}
    return short.select(*(full.get(c, F.col(c)).alias(c) for c in fact.columns))


def _derivable(fact: DataFrame) -> dict[str, Column]:
    """Columns that follow from others, unless their type has two writings of a value."""
    computed = {key: surrogate_key(natural) for key, natural in _NATURAL.items()}
    kinds = {key: T.StringType for key in _NATURAL} | {"revenue": T.DecimalType}
    computed["revenue"] = F.col("quantity") * F.col("item_price")
    return {c: v for c, v in computed.items() if isinstance(fact.schema[c].dataType, kinds[c])}


def fact_sales_merged(fact: DataFrame, increment: DataFrame, large: bool = False) -> DataFrame:
    """The fact after an increment: matched rows replaced, new ones added. large: the increment is of about the
    fact's size, and either is shuffled once (see ``upsert``)."""
    merged = upsert(_shortened(fact), _shortened(conform(increment, fact)), ["order_item_id"], large_batch=large)
    return _lengthened(merged, fact)


MEASURES = ("quantity", "item_price", "revenue")


def sales_model(
    fact: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    dates: DataFrame,
    measures: Sequence[str] = MEASURES,
    groupings: Mapping[tuple[str, ...], DataFrame] | None = None,
) -> StarModel:
    """What reports may ask: sums of the fact by any attribute. Sums of ids mean
    nothing, so ids are not measures unless named."""
    return StarModel(
        fact=fact,
        dimensions={"dim_customers": customers, "dim_products": products, "dim_date": dates},
        links=(
            Link("customer_id", "dim_customers", "customer_id"),
            Link("product_id", "dim_products", "product_id"),
            Link("order_date", "dim_date", "date_day", small=True),
        ),
        measures=measures,
        groupings=groupings or {},
        attributes=("customer_id", "product_id", "order_date", "status"),
    )


# Fixed values, with the two lists below: what is checked of which column.
GOLD_CHECKS: tuple[Check, ...] = (
    Unique("dim_customers", "customer_key"),
    NotNull("dim_customers", "customer_key"),
    Unique("dim_customers", "customer_id"),
    NotNull("dim_customers", "customer_id"),
    Unique("dim_products", "product_key"),
    NotNull("dim_products", "product_key"),
    Unique("dim_products", "product_id"),
    NotNull("dim_products", "product_id"),
    Unique("fact_sales", "order_item_id"),
    NotNull("fact_sales", "order_item_id"),
    NotNull("fact_sales", "customer_key"),
    Relationship("fact_sales", "customer_key", "dim_customers", "customer_key"),
    NotNull("fact_sales", "product_key"),
    Relationship("fact_sales", "product_key", "dim_products", "product_key"),
    Unique("dim_date", "date_key"),
    NotNull("dim_date", "date_key"),
    Unique("dim_date", "date_day"),
    NotNull("dim_date", "date_day"),
    Relationship("fact_sales", "order_date", "dim_date", "date_day"),
)

SOURCE_CHECKS: tuple[Check, ...] = (
    Unique("customers", "customer_id"),
    Unique("customers", "email"),
    Unique("products", "product_id"),
    Condition("products", "unit_price", "unit_price >= 0"),
    Unique("orders", "order_id"),
    Relationship("orders", "customer_id", "customers", "customer_id"),
    Unique("order_items", "order_item_id"),
    Condition("order_items", "quantity", "quantity > 0"),
    Relationship("order_items", "order_id", "orders", "order_id"),
    Relationship("order_items", "product_id", "products", "product_id"),
    Unique("payments", "payment_id"),
    Relationship("payments", "order_id", "orders", "order_id"),
)

CONTROL_CHECKS: tuple[Check, ...] = (
    Unique("control_table", "table_name"),
    Condition("control_table", "load_type", "load_type in ('full', 'incremental')"),
)
