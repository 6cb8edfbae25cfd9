"""The registered queries again, as SQL over the plain test tables.

``PARTS`` holds named subqueries; ``_sql`` puts those a statement uses, and
those they use, into its WITH clause.
"""

from __future__ import annotations

import re

from lakeloom.workload.roles import CUTOFF

CUT = f"TIMESTAMP '{CUTOFF} 00:00:00'"


def _padded(column: str) -> str:
    return f"'  ' || {column} || ' '"


def _title(column: str) -> str:
    words = f"string_split(lower(trim({column}, ' ')), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || w[2:]), ' ')"


def _latest(source: str, keys: str, order: str, columns: str = "*") -> str:
    return (
        f"SELECT {columns} FROM {source} "
        f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"
    )


def _desc(*columns: str) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in columns)


ITEM_ORDER = _desc("created_at", "order_id", "product_id", "quantity", "item_price")
ORDER_ORDER = _desc(
    "updated_at", "customer_id", "order_date", "status", "order_amount", "created_at"
)
ORDER_COLUMNS = "order_id, customer_id, order_date, status, order_amount, created_at, updated_at"
ITEM_COLUMNS = "order_item_id, order_id, product_id, quantity, item_price, created_at"
SILVER_ORDER_COLUMNS = (
    "order_id, customer_id, CAST(order_date AS DATE) AS order_date, status, "
    "CAST(order_amount AS DECIMAL(12,2)) AS order_amount, created_at, updated_at"
)

VALID_ITEM = (
    "order_item_id IS NOT NULL AND order_id IS NOT NULL AND product_id IS NOT NULL "
    "AND quantity > 0 AND item_price >= 0"
)

PARTS: dict[str, str] = {
    # bronze
    "b_customers": f"""
        SELECT c_custkey AS customer_id, c_name AS customer_name,
               lower(c_name || '@example.com') AS email,
               {_padded("c_mktsegment || ' ' || n_name")} AS city,
               strftime(DATE '2015-01-01' + CAST(floor(abs(c_acctbal) / 10) AS INT), '%Y-%m-%d')
                 AS signup_date
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "b_products": f"""
        SELECT p_partkey AS product_id, {_padded("p_name")} AS product_name,
               {_padded("p_type")} AS category,
               CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price
        FROM part""",
    "b_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
               o_orderstatus AS status, o_totalprice AS order_amount, o_orderdate AS created_at,
               o_orderdate + to_days(CAST(substr(o_orderpriority, 1, 1) AS INT)) AS updated_at
        FROM orders""",
    "b_orders_before": f"SELECT * FROM b_orders WHERE order_date < {CUT}",
    "b_order_changes": """
        SELECT order_id, customer_id, order_date, 'new ' || status AS status, order_amount,
               b.created_at,
               CASE WHEN status = 'F' AND o_orderpriority LIKE '4%' THEN NULL
                    WHEN status = 'F' THEN updated_at + to_days(30)
                    WHEN status = 'P' THEN updated_at - to_days(1)
                    ELSE updated_at END AS updated_at
        FROM b_orders b JOIN orders ON order_id = o_orderkey
        WHERE o_orderpriority NOT LIKE '5%'""",
    "b_items": """
        SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id,
               l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS item_price, l_shipdate AS created_at
        FROM lineitem""",
    "b_items_before": f"SELECT * FROM b_items WHERE created_at < {CUT}",
    "b_items_dearer": """
        SELECT * REPLACE (CAST(item_price + 1 AS DECIMAL(10,2)) AS item_price) FROM b_items""",
    "b_items_faulty": """
        SELECT * REPLACE (CASE WHEN quantity < 10 THEN 0 ELSE quantity END AS quantity,
               CASE WHEN quantity > 47 THEN -order_id ELSE order_id END AS order_id,
               CASE WHEN quantity = 40 THEN -product_id ELSE product_id END AS product_id,
               CAST(CASE WHEN quantity > 45 THEN -item_price ELSE item_price END
                    AS DECIMAL(10,2)) AS item_price)
        FROM b_items""",
    "b_payments": f"""
        SELECT user_id AS payment_id, user_id AS order_id, CAST(value AS VARCHAR) AS amount,
               {_padded("event_type")} AS method,
               strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS paid_at,
               strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS updated_at
        FROM events""",
    "b_spend": f"""
        SELECT CASE WHEN event_type = 'signup' THEN '2024-13-45'
                    ELSE strftime(ts, '%Y-%m-%d') END AS spend_date,
               {_padded("event_type")} AS channel,
               {_padded("event_type || '_' || strftime(ts, '%m')")} AS campaign,
               CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END
                 AS spend_amount,
               nullif(regexp_extract(props, '"k": *([0-9]+)', 1), '0') AS clicks
        FROM events""",
    "b_prices": f"""
        SELECT l_partkey AS product_id, {_padded("p_name")} AS product_name,
               {_padded("s_name")} AS supplier_name, CAST(price AS VARCHAR) AS supplier_cost,
               strftime(since, '%Y-%m-%d') AS effective_date
        FROM (SELECT l_partkey, l_suppkey, min(CAST(l_extendedprice AS DECIMAL(10,2))) AS price,
                     max(l_shipdate) AS since
              FROM lineitem GROUP BY ALL)
        JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""",
    # silver
    "customers_s": f"""
        SELECT customer_id, customer_name, email, {_title("city")} AS city,
               CAST(signup_date AS DATE) AS signup_date
        FROM b_customers WHERE customer_id IS NOT NULL""",
    "products_s": """
        SELECT product_id, trim(product_name, ' ') AS product_name,
               trim(category, ' ') AS category, unit_price
        FROM b_products WHERE product_id IS NOT NULL""",
    "orders_s": f"SELECT {SILVER_ORDER_COLUMNS} FROM b_orders WHERE order_id IS NOT NULL",
    "orders_before_s": f"SELECT {SILVER_ORDER_COLUMNS} FROM b_orders_before WHERE order_id IS NOT NULL",
    "changes_s": f"SELECT {SILVER_ORDER_COLUMNS} FROM b_order_changes WHERE order_id IS NOT NULL",
    "items_s": _latest(f"b_items WHERE {VALID_ITEM}", "order_item_id", ITEM_ORDER),
    "items_before_s": _latest(f"b_items_before WHERE {VALID_ITEM}", "order_item_id", ITEM_ORDER),
    "items_dearer_s": _latest(f"b_items_dearer WHERE {VALID_ITEM}", "order_item_id", ITEM_ORDER),
    "payments_s": """
        SELECT payment_id, order_id, amount, method, paid_at, updated_at FROM (
          SELECT payment_id, order_id, TRY_CAST(amount AS DECIMAL(12,2)) AS amount,
                 trim(method, ' ') AS method, TRY_CAST(paid_at AS TIMESTAMP) AS paid_at,
                 TRY_CAST(updated_at AS TIMESTAMP) AS updated_at
          FROM b_payments)
        WHERE payment_id IS NOT NULL AND order_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY payment_id
          ORDER BY updated_at DESC NULLS LAST, order_id DESC NULLS LAST, amount DESC NULLS LAST,
                   method DESC NULLS LAST, paid_at DESC NULLS LAST) = 1""",
    "spend_s": """
        SELECT * FROM (
          SELECT TRY_CAST(spend_date AS DATE) AS spend_date, trim(channel, ' ') AS channel,
                 trim(campaign, ' ') AS campaign,
                 TRY_CAST(spend_amount AS DECIMAL(12,2)) AS spend_amount, clicks
          FROM b_spend)
        WHERE spend_date IS NOT NULL AND spend_amount IS NOT NULL AND clicks IS NOT NULL""",
    "prices_s": """
        SELECT product_id, trim(product_name, ' ') AS product_name,
               trim(supplier_name, ' ') AS supplier_name,
               TRY_CAST(supplier_cost AS DECIMAL(12,2)) AS supplier_cost,
               TRY_CAST(effective_date AS DATE) AS effective_date
        FROM b_prices WHERE product_id IS NOT NULL AND TRY_CAST(supplier_cost AS DECIMAL(12,2)) IS NOT NULL""",
    # merges
    "merged_orders": """
        SELECT coalesce(t.order_id, s.order_id) AS order_id,
               CASE WHEN take THEN s.customer_id ELSE t.customer_id END AS customer_id,
               CASE WHEN take THEN s.order_date ELSE t.order_date END AS order_date,
               CASE WHEN take THEN s.status ELSE t.status END AS status,
               CASE WHEN take THEN s.order_amount ELSE t.order_amount END AS order_amount,
               CASE WHEN take THEN s.created_at ELSE t.created_at END AS created_at,
               CASE WHEN take THEN s.updated_at ELSE t.updated_at END AS updated_at
        FROM (SELECT t, s, t.order_id IS NULL OR coalesce(s.updated_at > t.updated_at, false) AS take
              FROM orders_before_s t FULL JOIN changes_s s ON t.order_id = s.order_id)""",
    "merged_items": """
        SELECT * FROM items_before_s
        UNION ALL
        SELECT * FROM items_dearer_s
        WHERE order_item_id NOT IN (SELECT order_item_id FROM items_before_s)""",
    "actions": """
        SELECT s.order_id,
               CASE WHEN t.order_id IS NULL THEN 'insert'
                    WHEN s.updated_at > t.updated_at THEN 'update' ELSE 'none' END AS merge_action
        FROM changes_s s LEFT JOIN orders_before_s t ON s.order_id = t.order_id""",
    "mark": "SELECT max(updated_at) AS mark FROM b_orders_before",
    # gold
    "dim_c": """
        SELECT md5(CAST(customer_id AS VARCHAR)) AS customer_key, customer_id, customer_name,
               email, city, signup_date FROM customers_s""",
    "price_now": _latest(
        "prices_s", "product_id",
        _desc("effective_date", "product_name", "supplier_name", "supplier_cost"),
    ),
    "dim_p": """
        SELECT md5(CAST(p.product_id AS VARCHAR)) AS product_key, p.product_id, p.product_name,
               p.category, p.unit_price, n.supplier_cost,
               CAST(p.unit_price - n.supplier_cost AS DECIMAL(13,2)) AS unit_margin
        FROM products_s p LEFT JOIN price_now n ON p.product_id = n.product_id""",
    "dim_p_every": """
        SELECT md5(CAST(p.product_id AS VARCHAR)) AS product_key, p.product_id, p.product_name,
               p.category, p.unit_price, n.supplier_cost,
               CAST(p.unit_price - n.supplier_cost AS DECIMAL(13,2)) AS unit_margin
        FROM products_s p LEFT JOIN prices_s n ON p.product_id = n.product_id""",
    "dim_d": """
        SELECT date_day, CAST(strftime(date_day, '%Y%m%d') AS INT) AS date_key,
               CAST(year(date_day) AS INT) AS year, CAST(quarter(date_day) AS INT) AS quarter,
               CAST(month(date_day) AS INT) AS month, strftime(date_day, '%b') AS month_name,
               CAST(weekofyear(date_day) AS INT) AS week_of_year,
               CAST(day(date_day) AS INT) AS day_of_month,
               CAST(dayofweek(date_day) + 1 AS INT) AS day_of_week,
               strftime(date_day, '%a') AS day_name
        FROM (SELECT CAST(unnest(generate_series(least(min(order_date), DATE '2024-01-01'),
                     greatest(max(order_date), DATE '2026-12-31'), INTERVAL 1 DAY)) AS DATE)
                     AS date_day FROM orders_s)""",
    "fact": """
        SELECT i.order_item_id, o.order_id, c.customer_key, p.product_key, o.customer_id,
               i.product_id, o.order_date, i.quantity, i.item_price,
               CAST(i.quantity * i.item_price AS DECIMAL(21,2)) AS revenue, o.status, o.updated_at
        FROM items_s i JOIN orders_s o ON i.order_id = o.order_id
        LEFT JOIN dim_c c ON o.customer_id = c.customer_id
        LEFT JOIN dim_p p ON i.product_id = p.product_id""",
    "fact_yesterday": """
        SELECT i.order_item_id, o.order_id, c.customer_key, p.product_key, o.customer_id,
               i.product_id, o.order_date, i.quantity, i.item_price,
               CAST(i.quantity * i.item_price AS DECIMAL(21,2)) AS revenue, o.status, o.updated_at
        FROM items_before_s i JOIN orders_before_s o ON i.order_id = o.order_id
        LEFT JOIN dim_c c ON o.customer_id = c.customer_id
        LEFT JOIN dim_p p ON i.product_id = p.product_id""",
    "fact_mark": """
        SELECT coalesce(max(updated_at), TIMESTAMP '1900-01-01') AS mark FROM fact_yesterday""",
    "fact_new": "SELECT * FROM fact WHERE updated_at > (SELECT mark FROM fact_mark)",
    "fact_merged": """
        SELECT * FROM fact_new
        UNION ALL
        SELECT * FROM fact_yesterday
        WHERE order_item_id NOT IN (SELECT order_item_id FROM fact_new)""",
    "fact_caught_up": """
        SELECT * FROM fact_merged
        UNION ALL
        SELECT * FROM fact WHERE order_item_id NOT IN (SELECT order_item_id FROM fact_merged)""",
    # the tables a gold build over insert-only items ends with: an item keeps its first load
    "items_loaded": """
        SELECT * FROM items_before_s
        UNION ALL
        SELECT * FROM items_s
        WHERE order_item_id NOT IN (SELECT order_item_id FROM items_before_s)""",
    "fact_loaded": """
        SELECT i.order_item_id, o.order_id, c.customer_key, p.product_key, o.customer_id,
               i.product_id, o.order_date, i.quantity, i.item_price,
               CAST(i.quantity * i.item_price AS DECIMAL(21,2)) AS revenue, o.status, o.updated_at
        FROM items_loaded i JOIN orders_s o ON i.order_id = o.order_id
        LEFT JOIN dim_c c ON o.customer_id = c.customer_id
        LEFT JOIN dim_p p ON i.product_id = p.product_id""",
    # without the items that came after their order was loaded
    "fact_changed_new": "SELECT * FROM fact_loaded WHERE updated_at > (SELECT mark FROM fact_mark)",
    "fact_changed_only": """
        SELECT * FROM fact_changed_new
        UNION ALL
        SELECT * FROM fact_yesterday
        WHERE order_item_id NOT IN (SELECT order_item_id FROM fact_changed_new)""",
    "star": """
        SELECT f.*, c.city, p.category, p.product_name, d.year, d.quarter, d.month,
               d.month_name, d.day_name
        FROM fact f LEFT JOIN dim_c c ON f.customer_id = c.customer_id
        LEFT JOIN dim_p p ON f.product_id = p.product_id
        LEFT JOIN dim_d d ON f.order_date = d.date_day""",
    "control": """
        SELECT t.*, (SELECT mark FROM mark) AS last_loaded_at
        FROM (VALUES ('customers', 'dbo', 'full', NULL), ('products', 'dbo', 'full', NULL),
                     ('orders', 'dbo', 'incremental', 'updated_at'),
                     ('order_items', 'dbo', 'incremental', 'created_at'),
                     ('payments', 'dbo', 'incremental', 'updated_at'))
          AS t(table_name, source_schema, load_type, watermark_column)""",
    "extracted": """
        SELECT 'customers' AS "table", count(*) AS "rows" FROM b_customers
        UNION ALL SELECT 'products', count(*) FROM b_products
        UNION ALL SELECT 'orders', count(*) FROM b_orders
          WHERE updated_at > (SELECT mark FROM mark)
        UNION ALL SELECT 'order_items', count(*) FROM b_items
          WHERE created_at > (SELECT mark FROM mark)
        UNION ALL SELECT 'payments', count(*) FROM b_payments
          WHERE updated_at > (SELECT strftime(mark, '%Y-%m-%d %H:%M:%S') FROM mark)""",
    "control_wrong": """
        SELECT * FROM control
        UNION ALL SELECT 'orders', 'dbo', 'full', NULL, mark FROM mark
        UNION ALL SELECT 'refunds', 'dbo', 'sometimes', NULL, mark FROM mark""",
    # quality
    "fact_dq": """
        SELECT * REPLACE (CASE WHEN quantity < 40 THEN product_key END AS product_key) FROM fact""",
    "dim_c_dq": """
        SELECT * REPLACE (CASE WHEN city LIKE 'M%' THEN -1 ELSE customer_id END AS customer_id)
        FROM dim_c""",
    "dim_c_some": "SELECT * FROM dim_c WHERE city LIKE 'H%'",
    "dim_d_some": f"SELECT * FROM dim_d WHERE date_day < DATE '{CUTOFF}'",
}


def _sql(body: str) -> str:
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, part in PARTS.items():
            if name not in needed and re.search(rf"(?:FROM|JOIN)\s+{name}\b", text):
                visit(part)
                needed.append(name)

    visit(body)
    parts = ",\n".join(f"{name} AS ({PARTS[name]})" for name in needed)
    return f"WITH {parts}\n{body}" if parts else body


def _checks(*rows: tuple[str, str, str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", '{column}' AS \"column\", "
        f"CAST(({failures}) AS BIGINT) AS failures"
        for check, table, column, failures in rows
    )


def _twice(source: str, column: str) -> str:
    return (
        f"SELECT count(*) FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING count(*) > 1)"
    )


def _nulls(source: str, column: str) -> str:
    return f"SELECT count(*) FROM {source} WHERE {column} IS NULL"


def _lost(source: str, column: str, parent: str, parent_column: str) -> str:
    return (
        f"SELECT count(*) FROM {source} WHERE {column} IS NOT NULL "
        f"AND {column} NOT IN (SELECT {parent_column} FROM {parent})"
    )


def _breaks(source: str, condition: str) -> str:
    return f"SELECT count(*) FROM {source} WHERE NOT ({condition})"


def _star(by: str, sums: str, where: str = "") -> str:
    head = f"{by}, " if by else ""
    return f"SELECT {head}{sums} FROM star {where} {f'GROUP BY {by}' if by else ''}"


REVENUE = "CAST(sum(revenue) AS DECIMAL(31,2)) AS revenue"
QUANTITY = "CAST(sum(quantity) AS BIGINT) AS quantity"
PRICE = "CAST(sum(item_price) AS DECIMAL(20,2)) AS item_price"

NOT_NULL_COLUMNS = (
    ("dim_customers", "customer_key"), ("dim_customers", "customer_id"),
    ("dim_products", "product_key"), ("dim_products", "product_id"),
    ("fact_sales", "order_item_id"), ("fact_sales", "customer_key"),
    ("fact_sales", "product_key"), ("dim_date", "date_key"), ("dim_date", "date_day"),
)
UNIQUE_COLUMNS = tuple(c for c in NOT_NULL_COLUMNS if c not in NOT_NULL_COLUMNS[5:7])
# column, the parent in the checks on test frames, in the checks of a build, its column
RELATED_COLUMNS = (
    ("customer_key", "dim_c_some", "dim_c", "customer_key"),
    ("product_key", "dim_p", "dim_p", "product_key"),
    ("order_date", "dim_d_some", "dim_d", "date_day"),
)
CHECKED = {"dim_customers": "dim_c_dq", "dim_products": "dim_p", "dim_date": "dim_d",
           "fact_sales": "fact_dq"}
CHECKED_EVERY = {**CHECKED, "dim_products": "dim_p_every"}
BUILT = {"dim_customers": "dim_c", "dim_products": "dim_p", "dim_date": "dim_d",
         "fact_sales": "fact_loaded"}


def _built_failures(kind: str, table: str, column: str) -> str:
    return (_twice if kind == "unique" else _nulls)(BUILT[table], column)


_SHIPPED = "l_orderkey, l_linenumber"
_LATE = """
    SELECT * REPLACE (
        CASE WHEN order_id % 7 = 0 AND updated_at IS NOT NULL THEN 'late ' || status ELSE status END AS status,
        CASE WHEN order_id % 7 = 0 THEN updated_at + INTERVAL 1 SECOND ELSE updated_at END AS updated_at)
    FROM fact_loaded"""
_MERGE_COUNTS = """
    SELECT (SELECT count(*) FROM {target}) AS before_count, {incoming} AS incoming_count,
           {updates} AS update_count, {inserts} AS insert_count,
           (SELECT count(*) FROM {target}) + {inserts} AS after_count,
           {inserts} + {updates} AS row_count"""

STATEMENTS: dict[str, str] = {
    "bronze_full_scan": "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem",
    "bronze_batch_scan": f"""
        SELECT *, CASE WHEN order_date < {CUT} THEN '2026-01-30' ELSE '2026-01-31' END AS batch
        FROM b_orders WHERE order_date IS NOT NULL""",
    "csv_source_scan": """
        SELECT *, 'say "' || channel || '", please' AS note FROM b_spend""",
    "catalog_table_scan": "SELECT * FROM spend_s",
    "incremental_extract": """
        SELECT * FROM b_orders WHERE updated_at > (SELECT mark FROM mark)""",
    "control_lookup": """
        SELECT "table", "rows", load_type FROM extracted JOIN control ON table_name = "table" """,
    "high_water_marks": """
        SELECT count(*) FILTER (updated_at > (SELECT mark FROM mark)) AS past_mark,
               count(*) FILTER (updated_at > TIMESTAMP '1900-01-01') AS past_lowest
        FROM b_orders""",
    "silver_customers": """
        SELECT c.*, max(o_orderdate) AS updated_at
        FROM customers_s c LEFT JOIN orders ON o_custkey = customer_id GROUP BY ALL""",
    "silver_products": """
        SELECT p.*, max(l_shipdate) AS updated_at
        FROM products_s p LEFT JOIN lineitem ON l_partkey = product_id GROUP BY ALL""",
    "silver_marketing_spend": "SELECT * FROM spend_s",
    "silver_supplier_price_list": "SELECT * FROM prices_s",
    "silver_orders": _latest(
        "(SELECT * FROM orders_s UNION ALL SELECT * FROM changes_s)", "order_id", ORDER_ORDER
    ),
    "silver_order_items": "SELECT * FROM items_s",
    "silver_order_items_clean_first": _latest(
        f"(SELECT * FROM b_items_faulty WHERE {VALID_ITEM})",
        "order_item_id", ITEM_ORDER,
    ),
    "silver_order_items_dedupe_first": (
        f"SELECT * FROM ({_latest('b_items_faulty', 'order_item_id', ITEM_ORDER)}) "
        f"WHERE {VALID_ITEM}"
    ),
    "silver_payments": "SELECT * FROM payments_s",
    "cleaning_rejects": """
        SELECT 'marketing_spend' AS "table", 'spend_date is not null' AS rule,
               count(*) FILTER (TRY_CAST(spend_date AS DATE) IS NULL) AS rejected FROM b_spend
        UNION ALL SELECT 'marketing_spend', 'spend_amount is not null',
               count(*) FILTER (TRY_CAST(spend_amount AS DECIMAL(12,2)) IS NULL) FROM b_spend
        UNION ALL SELECT 'marketing_spend', 'clicks is not null',
               count(*) FILTER (clicks IS NULL) FROM b_spend
        UNION ALL SELECT 'order_items', 'order_item_id is not null',
               count(*) FILTER (order_item_id IS NULL) FROM b_items_faulty
        UNION ALL SELECT 'order_items', 'order_id is not null',
               count(*) FILTER (order_id IS NULL) FROM b_items_faulty
        UNION ALL SELECT 'order_items', 'product_id is not null',
               count(*) FILTER (product_id IS NULL) FROM b_items_faulty
        UNION ALL SELECT 'order_items', 'quantity > 0',
               count(*) FILTER (quantity > 0 IS NOT TRUE) FROM b_items_faulty
        UNION ALL SELECT 'order_items', 'item_price >= 0',
               count(*) FILTER (item_price >= 0 IS NOT TRUE) FROM b_items_faulty""",
    "latest_per_key": _latest(
        "lineitem", "l_partkey",
        _desc("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"),
        "l_partkey, l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity",
    ),
    "rank_equals_one": _latest(
        "lineitem", "l_suppkey",
        _desc("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"),
        "l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity",
    ),
    "distinct_by_key": """
        SELECT user_id, nullif(event_type, 'error') AS event_type, event_id, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, nullif(event_type, 'error')
                                   ORDER BY event_id DESC) = 1""",
    "stg_customers": "SELECT customer_id, customer_name, email, city, signup_date FROM customers_s",
    "stg_products": "SELECT product_id, product_name, category, unit_price FROM products_s",
    "stg_orders": """
        SELECT order_id, customer_id, order_date, status, order_amount, updated_at FROM orders_s""",
    "stg_order_items": """
        SELECT order_item_id, order_id, product_id, quantity, item_price FROM items_s""",
    "stg_payments": "SELECT payment_id, order_id, amount, method FROM payments_s",
    "stg_supplier_price_list": """
        SELECT product_id, product_name, supplier_name, supplier_cost, effective_date
        FROM prices_s""",
    "staging_row_counts": """
        SELECT 'customers' AS "table", count(*) AS "rows" FROM customers_s
        UNION ALL SELECT 'products', count(*) FROM products_s
        UNION ALL SELECT 'orders', count(*) FROM orders_s
        UNION ALL SELECT 'order_items', count(*) FROM items_s
        UNION ALL SELECT 'payments', count(*) FROM payments_s
        UNION ALL SELECT 'supplier_price_list', count(*) FROM prices_s""",
    "upsert_orders": "SELECT * FROM merged_orders",
    "upsert_orders_small_batch": "SELECT * FROM merged_orders",
    "upsert_replay": "SELECT * FROM merged_orders",
    "upsert_bloom": "SELECT * FROM merged_orders",
    "table_upsert_orders": "SELECT * FROM merged_orders",
    "stream_orders_upsert": "SELECT * FROM merged_orders",
    "upsert_null_keys": """
        SELECT status, no_key, count(*) AS orders,
               CAST(sum(order_amount) AS DECIMAL(22,2)) AS amount
        FROM (SELECT status, order_amount, false AS no_key FROM merged_orders
              WHERE order_amount < 400000
              UNION ALL SELECT status, order_amount, true FROM orders_before_s
              WHERE order_amount >= 400000
              UNION ALL SELECT status, order_amount, true FROM changes_s
              WHERE order_amount >= 400000)
        GROUP BY status, no_key""",
    "insert_only_items": "SELECT * FROM merged_items",
    "insert_only_bloom": "SELECT * FROM merged_items",
    "table_insert_only_items": "SELECT * FROM merged_items",
    "stream_items_insert_only": "SELECT * FROM merged_items",
    "stream_items_stateful": "SELECT * FROM merged_items",
    "update_candidates": """
        SELECT s.* FROM changes_s s JOIN orders_before_s t ON s.order_id = t.order_id
        WHERE s.updated_at > t.updated_at""",
    "insert_candidates": """
        SELECT * FROM changes_s WHERE order_id NOT IN (SELECT order_id FROM orders_before_s)""",
    "merge_actions": "SELECT * FROM actions",
    "upsert_summary": _MERGE_COUNTS.format(
        target="orders_before_s",
        incoming="(SELECT count(*) FROM changes_s)",
        updates="(SELECT count(*) FROM actions WHERE merge_action = 'update')",
        inserts="(SELECT count(*) FROM actions WHERE merge_action = 'insert')",
    ),
    "insert_only_summary": _MERGE_COUNTS.format(
        target="items_before_s",
        incoming="(SELECT count(*) FROM items_dearer_s)",
        updates="0::BIGINT",
        inserts="(SELECT count(*) FROM items_dearer_s WHERE order_item_id NOT IN "
        "(SELECT order_item_id FROM items_before_s))",
    ),
    "duplicate_source_keys": """
        SELECT order_item_id, count(*) AS occurrences FROM b_items
        WHERE order_item_id IS NOT NULL GROUP BY order_item_id HAVING count(*) > 1""",
    "table_upsert_counts": """
        SELECT CAST(1 AS INT) AS run, 0::BIGINT AS before_count, b AS incoming_count,
               0::BIGINT AS update_count, b AS insert_count, b AS after_count, b AS row_count
        FROM (SELECT count(*) AS b FROM orders_before_s)
        UNION ALL
        SELECT 2, b, n, u, i, b + i, u + i
        FROM (SELECT (SELECT count(*) FROM orders_before_s) AS b, count(*) AS n,
                     count(*) FILTER (merge_action = 'update') AS u,
                     count(*) FILTER (merge_action = 'insert') AS i FROM actions)
        UNION ALL
        SELECT 3, m, n, 0, 0, m, 0
        FROM (SELECT (SELECT count(*) FROM merged_orders) AS m, count(*) AS n FROM changes_s)""",
    "table_created_if_absent": """
        SELECT 'created' AS "table", 0::BIGINT AS "rows"
        UNION ALL SELECT 'loaded', count(*) FROM payments_s""",
    "watermark_advance": """
        SELECT * REPLACE (CASE WHEN table_name = 'orders' THEN TIMESTAMP '2026-01-31 01:00:00'
                               ELSE last_loaded_at END AS last_loaded_at)
        FROM control""",
    "ingest_control_run": """
        SELECT "table", "rows" + coalesce(unmarked, 0) AS "rows", load_type, TIMESTAMP '2026-01-31 01:00:00' AS last_loaded_at
        FROM extracted JOIN control ON table_name = "table" LEFT JOIN (
          SELECT 'orders' AS "table", count(*) AS unmarked FROM b_orders WHERE updated_at IS NULL
          UNION ALL SELECT 'order_items', count(*) FROM b_items WHERE created_at IS NULL) USING ("table")""",
    "marks_from_footers": " UNION ALL ".join(
        f"""
        SELECT '{table}' AS "table", '{column}' AS "column", count(*) AS n_rows, count({column}) AS n_values,
               CAST(min({column}) AS VARCHAR) AS least, CAST(max({column}) AS VARCHAR) AS greatest FROM {table}"""
        for table, columns in (("orders", ("o_orderkey", "o_custkey")), ("lineitem", ("l_orderkey", "l_partkey", "l_linenumber")))
        for column in columns
    ),
    "extract_splits": "SELECT order_id, 1 AS times, true AS fair FROM b_orders",
    "audit_summary": """
        SELECT 'Silver' AS layer, source_name, 'Data Transformation: ' || source_name
                 AS activity_name,
               load_type, run_date, 'p-1' AS pipeline_run_id, status, row_count,
               status = 'FAIL' AS has_error, true AS timed
        FROM (SELECT 'customers' AS source_name, 'FULL_REFRESH' AS load_type,
                     CAST(NULL AS VARCHAR) AS run_date, 'SUCCESS' AS status,
                     (SELECT count(*) FROM customers_s) AS row_count
              UNION ALL SELECT 'marketing_spend', 'FULL_REFRESH', NULL, 'SUCCESS',
                     (SELECT count(*) FROM spend_s)
              UNION ALL SELECT 'orders', 'INCREMENTAL', '2026-01-31', 'SUCCESS',
                     (SELECT count(*) FROM orders_s)
              UNION ALL SELECT 'marketing_spend', 'FULL_REFRESH', NULL, 'FAIL', NULL)""",
    "ingest_twice_a_day": "SELECT * FROM orders_s",
    "bronze_mixed_layout": f"""
        SELECT *, 'all' AS batch FROM b_orders
        UNION ALL
        SELECT *, '2026-01-31' FROM b_orders WHERE order_date >= {CUT} OR order_date IS NULL""",
    "csv_to_silver_prices": "SELECT * FROM prices_s",
    "quarantine_prices": """
        SELECT product_id, CASE product_id % 10 WHEN 3 THEN 'replayed' WHEN 5 THEN 'line does not parse'
                    WHEN 7 THEN 'supplier_cost is not null' ELSE 'clean' END AS outcome, count(*) AS n,
               CAST(sum(CASE WHEN product_id % 10 NOT IN (5, 7) THEN supplier_cost END) AS DECIMAL(22,2)) AS cost
        FROM prices_s GROUP BY ALL""",
    "dim_customers": "SELECT * FROM dim_c",
    "dim_products": "SELECT * FROM dim_p",
    "dim_products_as_of": f"""
        SELECT d.* REPLACE (n.supplier_cost AS supplier_cost,
               CAST(d.unit_price - n.supplier_cost AS DECIMAL(13,2)) AS unit_margin)
        FROM dim_p d LEFT JOIN (
          {_latest(f"prices_s WHERE effective_date <= DATE '{CUTOFF}'", "product_id",
                   _desc("effective_date", "product_name", "supplier_name", "supplier_cost"))}
        ) n ON d.product_id = n.product_id""",
    "dim_products_every_price": "SELECT * FROM dim_p_every",
    "dim_products_unpriced": f"""
        SELECT d.* REPLACE (n.supplier_cost AS supplier_cost,
               CAST(d.unit_price - n.supplier_cost AS DECIMAL(13,2)) AS unit_margin)
        FROM dim_p d LEFT JOIN (
          {_latest("prices_s WHERE supplier_cost < 2000", "product_id",
                   _desc("effective_date", "product_name", "supplier_name", "supplier_cost"))}
        ) n ON d.product_id = n.product_id""",
    "dim_date": "SELECT * FROM dim_d",
    "order_calendar": f"""
        SELECT {_SHIPPED}, day, CAST(strftime(day, '%Y%m%d') AS INT) AS date_key,
               CAST(year(day) AS INT) AS year, CAST(quarter(day) AS INT) AS quarter,
               CAST(month(day) AS INT) AS month, strftime(day, '%b') AS month_name,
               CAST(weekofyear(day) AS INT) AS week_of_year,
               CAST(extract(day FROM day) AS INT) AS day_of_month,
               CAST(dayofweek(day) + 1 AS INT) AS day_of_week, strftime(day, '%a') AS day_name
        FROM (SELECT {_SHIPPED}, CAST(l_shipdate AS DATE) AS day FROM lineitem)""",
    "surrogate_keys": """
        SELECT order_id, md5(CAST(order_id AS VARCHAR)) AS order_key,
               md5(coalesce(CAST(customer_id AS VARCHAR), '~null~') || '-' ||
                   coalesce(nullif(status, 'O'), '~null~')) AS customer_status_key
        FROM b_orders""",
    "fact_sales_full": "SELECT * FROM fact",
    "fact_sales_unknown_members": """
        SELECT f.* REPLACE (CASE WHEN c.city LIKE 'H%' THEN f.customer_key END AS customer_key,
               CASE WHEN p.category <> 'PROMO' THEN f.product_key END AS product_key)
        FROM fact f LEFT JOIN dim_c c ON f.customer_id = c.customer_id
        LEFT JOIN dim_p p ON f.product_id = p.product_id""",
    "fact_sales_increment": "SELECT * FROM fact_new",
    "fact_sales_incremental": "SELECT * FROM fact_merged",
    "fact_sales_catch_up": "SELECT * FROM fact_caught_up",
    "fact_sales_lookback": """
        SELECT * FROM fact WHERE updated_at > (SELECT mark FROM fact_mark) - to_days(365)""",
    "gold_fact_table": "SELECT * FROM fact_loaded",
    "gold_fact_after_retry": "SELECT * FROM fact_loaded",
    "gold_fact_changed_only": "SELECT * FROM fact_changed_only",
    "gold_fact_late_update": _LATE,
    "gold_fact_late_update_unranged": _LATE,
    "gold_fact_with_orphans": "SELECT * FROM fact_loaded",
    "gold_checks_incremental": _checks(
        *(("unique", t, c, _built_failures("unique", t, c)) for t, c in UNIQUE_COLUMNS),
        *(("not_null", t, c, _built_failures("not_null", t, c)) for t, c in NOT_NULL_COLUMNS),
        *(
            ("relationships", "fact_sales", c, _lost("fact_loaded", c, built, key))
            for c, _, built, key in RELATED_COLUMNS
        ),
    ),
    "gold_build_checks": _checks(
        *(("unique", t, c, _built_failures("unique", t, c)) for t, c in UNIQUE_COLUMNS),
        *(("not_null", t, c, _built_failures("not_null", t, c)) for t, c in NOT_NULL_COLUMNS),
        *(
            ("relationships", "fact_sales", c, _lost("fact_loaded", c, built, key))
            for c, _, built, key in RELATED_COLUMNS
        ),
    ),
    "star_join": """
        SELECT order_item_id, revenue, status, city AS dim_customers_city,
               category AS dim_products_category, year AS dim_date_year,
               month_name AS dim_date_month_name FROM star""",
    "star_revenue_by_category": _star("category, status", f"{REVENUE}, {QUANTITY}"),
    "star_revenue_by_month_city": _star("year, month, city", REVENUE),
    "star_quantity_by_status": _star("status", f"{QUANTITY}, {PRICE}"),
    "star_filtered": _star(
        "quarter, product_name", f"{REVENUE}, {QUANTITY}",
        "WHERE status IN ('F', 'O') AND year IN (1997, 1998)",
    ),
    "star_all_dimensions": _star("day_name, city, category", f"{REVENUE}, {QUANTITY}, {PRICE}"),
    "star_from_aggregate": f"""
        SELECT category, status, {REVENUE}, {QUANTITY}
        FROM ({_LATE}) f LEFT JOIN dim_p p ON f.product_id = p.product_id GROUP BY category, status""",
    "star_grand_total": _star("", f"{REVENUE}, {QUANTITY}"),
    "dq_unique": _checks(
        *(("unique", t, c, _twice(CHECKED_EVERY[t], c)) for t, c in UNIQUE_COLUMNS)
    ),
    "dq_not_null": _checks(
        *(("not_null", t, c, _nulls(CHECKED[t], c)) for t, c in NOT_NULL_COLUMNS)
    ),
    "dq_relationships": _checks(
        *(
            ("relationships", "fact_sales", c, _lost("fact_dq", c, parent, key))
            for c, parent, _, key in RELATED_COLUMNS
        )
    ),
    "dq_source_checks": _checks(
        ("unique", "customers", "customer_id", _twice("b_customers", "customer_id")),
        ("unique", "customers", "email", _twice("b_customers", "email")),
        ("unique", "products", "product_id", _twice("b_products", "product_id")),
        ("condition", "products", "unit_price", _breaks("b_products", "unit_price >= 0")),
        ("unique", "orders", "order_id", _twice("b_orders", "order_id")),
        ("relationships", "orders", "customer_id",
         _lost("b_orders", "customer_id", "b_customers", "customer_id")),
        ("unique", "order_items", "order_item_id", _twice("b_items_faulty", "order_item_id")),
        ("condition", "order_items", "quantity", _breaks("b_items_faulty", "quantity > 0")),
        ("relationships", "order_items", "order_id",
         _lost("b_items_faulty", "order_id", "b_orders", "order_id")),
        ("relationships", "order_items", "product_id",
         _lost("b_items_faulty", "product_id", "b_products", "product_id")),
        ("unique", "payments", "payment_id", _twice("b_payments", "payment_id")),
        ("relationships", "payments", "order_id",
         _lost("b_payments", "order_id", "b_orders", "order_id")),
    ),
    "dq_control_table": _checks(
        ("unique", "control_table", "table_name", _twice("control_wrong", "table_name")),
        ("condition", "control_table", "load_type",
         _breaks("control_wrong", "load_type IN ('full', 'incremental')")),
    ),
    "orphan_rows": """
        SELECT order_id AS value, count(*) AS "rows" FROM b_items
        WHERE order_id IS NOT NULL AND order_id NOT IN (SELECT order_id FROM b_orders_before) GROUP BY order_id""",
}

STATEMENTS["audit_compacted"] = STATEMENTS["audit_summary"]

ORACLES: dict[str, str] = {name: _sql(body) for name, body in STATEMENTS.items()}
