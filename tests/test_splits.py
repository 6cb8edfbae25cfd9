from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeloom.sources.splits import equi_depth, even_splits, literal, predicates


def met(df, conditions):
    """How many rows meet each condition; every row must meet exactly one."""
    flags = [F.coalesce(F.expr(c), F.lit(False)).cast("int") for c in conditions]
    sums = df.agg(*(F.sum(f) for f in flags), F.count_if(sum(flags[1:], flags[0]) != 1)).first()
    assert not sums[-1]
    return [n or 0 for n in sums[:-1]]


@pytest.mark.parametrize(
    "key",
    [
        "CAST(id AS INT)",
        "id * id * id",  # gaps that grow
        "IF(id < 9000, id, id + 1000000000)",
        "CAST(pow(1.001, id) AS DOUBLE)",
        "CAST(id AS DECIMAL(12,2)) / 7",
        "DATE'2000-01-01' + CAST(id AS INT)",
        "TIMESTAMP_NTZ'2000-01-01 00:00:00.25' + id * INTERVAL '7' SECOND",
    ],
)
def test_shares_are_even_whatever_the_gaps(spark, key):
    df = spark.range(10_000).select(F.expr(key).alias("k"))
    counts = met(df, even_splits(df, "k", 16))
    assert len(counts) == 17 and counts[-1] == 0
    assert max(counts[:-1]) <= 2 * 10_000 / 16 and min(counts[:-1]) >= 10_000 / 16 / 2


def test_nulls_a_hot_value_and_rows_that_came_later(spark):
    df = spark.range(9000).select(F.expr("CASE WHEN id < 3000 THEN NULL WHEN id < 6000 THEN 5000 ELSE id END").alias("k"))
    conditions = even_splits(df, "k", 6)
    counts = met(df, conditions)
    assert counts[-1] == 3000 and sum(counts) == 9000
    # a value is never cut, and those beside it are still split
    assert sorted(counts)[-3:][0] < 3000 and len(conditions) > 3
    later = df.union(spark.sql("SELECT explode(array(-10L, 0L, 99999L))"))
    assert sum(met(later, conditions)) == 9003


def test_few_rows(spark):
    none = spark.range(0).select(F.col("id").alias("k"))
    assert equi_depth(none, "k", 8) == [] and equi_depth(none, "k", 1) == []
    assert predicates("k", []) == ["k IS NOT NULL", "k IS NULL"]
    nulls = spark.range(3).select(F.lit(None).cast("int").alias("k"))
    assert met(nulls, even_splits(nulls, "k", 4)) == [0, 3]
    one = spark.range(1).select(F.col("id").alias("k"))
    assert sum(met(one, even_splits(one, "k", 4))) == 1
    with pytest.raises(ValueError):
        equi_depth(one, "k", 0)


def test_literals():
    assert [literal(v) for v in (-3, Decimal("1.50"), date(2025, 1, 2), datetime(2025, 1, 2, 3, 4, 5, 600))] == [
        "-3", "1.50", "'2025-01-02'", "'2025-01-02 03:04:05.000600'",
    ]
    for bad in (True, "x", None):
        with pytest.raises(TypeError):
            literal(bad)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.none() | st.integers(-5, 5), max_size=20), st.integers(1, 6))
def test_every_row_meets_one_condition(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "k int")
    assert sum(met(df, even_splits(df, "k", parts))) == len(values)
