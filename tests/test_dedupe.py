import pytest

from lakeloom.operators.dedupe import first_ranked, latest_per_key, one_per_key

BOTH = pytest.mark.parametrize("pick", [latest_per_key, first_ranked])


@BOTH
def test_newest_survives_and_nulls_lose(spark, rows, pick):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 3, "b"), (1, 2, "c"), (2, None, "x"), (2, 0, "y")],
        "k int, t int, v string",
    )
    assert rows(pick(df, ["k"], ["t"])) == [(1, 3, "b"), (2, 0, "y")]


@BOTH
def test_ties_go_to_the_tie_breaker(spark, rows, pick):
    df = spark.createDataFrame([(1, 1, 5, "z"), (1, 1, 9, "a")], "k int, t int, n int, v string")
    assert rows(pick(df, ["k"], ["t"])) == [(1, 1, 9, "a")]
    assert rows(pick(df, ["k"], ["t"], ["v"])) == [(1, 1, 5, "z")]


@BOTH
def test_null_keys_form_one_group(spark, pick):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 1), (1, 2)], "k int, t int")
    assert pick(df, ["k"], ["t"]).count() == 2


def test_maps_follow_the_chosen_row(spark):
    df = spark.createDataFrame([(1, 1, {"a": 1}), (1, 2, {"b": 2})], "k int, t int, m map<string,int>")
    assert latest_per_key(df, ["k"], ["t"]).first().m == {"b": 2}


def test_same_row_whatever_the_partitioning(spark, rows):
    df = spark.range(1000).selectExpr("id % 7 as k", "id % 3 as t", "id % 11 as u")
    expected = rows(latest_per_key(df, ["k"], ["t"]))
    for n in (1, 5):
        shuffled = df.repartition(n)
        assert rows(latest_per_key(shuffled, ["k"], ["t"])) == expected
        assert rows(first_ranked(shuffled, ["k"], ["t"])) == expected


def test_one_per_key_without_other_columns(spark):
    assert one_per_key(spark.createDataFrame([(1,), (1,)], "k int"), ["k"]).count() == 1
