from datetime import date, datetime
from decimal import Decimal

import pytest

from lakeloom.functions import surrogate_key
from lakeloom.plans.silver import SILVER


def only(df):
    (row,) = df.collect()
    return row


def customers(spark, *rows):
    return spark.createDataFrame(
        rows, "customer_id int, city string, signup_date string, updated_at timestamp_ntz"
    )


@pytest.mark.parametrize(
    ("city", "cleaned"),
    [
        ("  new delhi ", "New Delhi"),
        ("MUMBAI", "Mumbai"),
        ("new-delhi", "New-delhi"),
        ("o'neil mcDONALD", "O'neil Mcdonald"),
        ("\tpune", "\tpune"),  # only spaces are stripped, and capitals follow spaces
        (None, None),
    ],
)
def test_city(spark, city, cleaned):
    df = SILVER["customers"].transform(customers(spark, (1, city, "2025-01-02", None)))
    assert only(df).city == cleaned


def test_null_ids_are_dropped_and_other_columns_pass(spark):
    bronze = customers(
        spark,
        (None, "a", "2025-01-02", None),
        (None, "b", "2025-01-02", None),
        (7, "c", "2025-01-02", datetime(2025, 1, 3)),
    )
    row = only(SILVER["customers"].transform(bronze))
    assert (row.customer_id, row.signup_date) == (7, date(2025, 1, 2))
    assert row.updated_at == datetime(2025, 1, 3)


def spend(spark, *rows):
    return spark.createDataFrame(
        rows,
        "spend_date string, channel string, campaign string, spend_amount string, clicks string",
    )


BAD_SPEND = [
    ("2024-13-45", " Email ", "a", "1", "5"),
    ("2024-01-05", "Email", "b", "abc", "5"),
    ("2024-01-05", "Email", "c", "1", None),
    ("2024-01-05", " Email ", " d ", "1.005", "5"),
]


def test_bad_text_is_dropped_and_counted(spark, rows):
    table = SILVER["marketing_spend"]
    bronze = spend(spark, *BAD_SPEND)
    row = only(table.transform(bronze))
    assert tuple(row) == (date(2024, 1, 5), "Email", "d", Decimal("1.01"), "5")
    assert rows(table.recipe.reject_counts(bronze)) == [
        ("clicks is not null", 1),
        ("spend_amount is not null", 1),
        ("spend_date is not null", 1),
    ]


@pytest.mark.parametrize("bad", BAD_SPEND[:2])
def test_strict_raises(spark, bad):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        SILVER["marketing_spend"].transform(spend(spark, bad), strict=True).collect()


def test_spend_is_not_deduplicated(spark):
    assert SILVER["marketing_spend"].transform(spend(spark, *BAD_SPEND[3:] * 2)).count() == 2


def test_price_list_keeps_rows_without_a_date(spark):
    bronze = spark.createDataFrame(
        [("1", " p ", " s ", "2.345", "soon"), (None, "p", "s", "1", "2024-01-01")],
        "product_id string, product_name string, supplier_name string, "
        "supplier_cost string, effective_date string",
    )
    row = only(SILVER["supplier_price_list"].transform(bronze))
    assert tuple(row) == ("1", "p", "s", Decimal("2.35"), None)


def items(spark, *rows):
    return spark.createDataFrame(
        rows,
        "order_item_id int, order_id int, product_id int, quantity int, "
        "item_price decimal(10,2), created_at timestamp_ntz",
    )


def test_item_rules(spark):
    good = (1, 1, 1, 1, Decimal(0), None)
    faults = {0: None, 1: None, 2: None, 3: 0, 4: Decimal(-1)}
    bad = [tuple(v if i == j else good[j] for j in range(6)) for i, v in faults.items()]
    bad += [(2, 1, 1, None, Decimal(1), None), (3, 1, 1, 1, None, None)]
    assert only(SILVER["order_items"].transform(items(spark, good, *bad))).item_price == 0


def test_invalid_duplicate_does_not_displace_a_valid_one(spark):
    early, late = datetime(2025, 1, 1), datetime(2025, 1, 2)
    bronze = items(spark, (1, 1, 1, 2, Decimal(5), early), (1, 1, 1, 0, Decimal(5), late))
    table = SILVER["order_items"]
    assert only(table.transform(bronze)).quantity == 2
    assert table.transform(bronze, clean_first=False).count() == 0


def test_payments_compare_times_not_text(spark):
    bronze = spark.createDataFrame(
        [
            (1, 1, "5", " UPI ", "2025-01-09 10:00:00", "2025-1-9 10:00:00"),
            (1, 1, "6", " UPI ", "2025-01-10 10:00:00", "2025-01-10 10:00:00"),
            (1, None, "7", "UPI", "2025-01-11 10:00:00", "2025-01-11 10:00:00"),
        ],
        "payment_id int, order_id int, amount string, method string, "
        "paid_at string, updated_at string",
    )
    row = only(SILVER["payments"].transform(bronze))
    assert (row.amount, row.method) == (Decimal("6.00"), "UPI")
    assert row.updated_at == datetime(2025, 1, 10, 10)


def test_surrogate_key(spark):
    df = spark.createDataFrame([(1, None), (1, ""), (1, None)], "a int, b string")
    null, empty, again = (r[0] for r in df.select(surrogate_key("a", "b")).collect())
    assert null == again != empty
    assert only(df.limit(1).select(surrogate_key("a").alias("k"))).k == (
        "c4ca4238a0b923820dcc509a6f75849b"
    )
