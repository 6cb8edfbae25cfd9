import pytest

from lakeloom.operators import quality as q


@pytest.fixture
def tables(spark):
    child = spark.createDataFrame(
        [(1, 1, 5), (1, 2, None), (2, 9, -1), (None, 9, 0), (None, None, 1)],
        "id int, parent_id int, amount int",
    )
    parent = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    return {"child": child, "parent": parent}


def test_failures_are_counted(tables, rows):
    checks = [
        q.Unique("child", "id"),
        q.Unique("parent", "id"),
        q.NotNull("child", "id"),
        q.NotNull("child", "parent_id"),
        q.Relationship("child", "parent_id", "parent", "id"),
        q.Condition("child", "amount", "amount >= 0"),
    ]
    results = q.run_checks(tables, checks)
    assert rows(results) == [
        ("condition", "child", "amount", 1),
        ("not_null", "child", "id", 2),
        ("not_null", "child", "parent_id", 1),
        ("relationships", "child", "parent_id", 2),
        ("unique", "child", "id", 1),
        ("unique", "parent", "id", 1),
    ]
    with pytest.raises(q.QualityError, match=r"not_null\(child.id\)=2"):
        q.require_passed(results)


def test_passing_checks(tables):
    ok = {"t": tables["parent"].distinct()}
    results = q.run_checks(ok, [q.Unique("t", "id"), q.NotNull("t", "id")])
    q.require_passed(results)
    assert [r.failures for r in results.collect()] == [0, 0]


def test_empty_tables_pass(tables):
    empty = {name: df.limit(0) for name, df in tables.items()}
    q.require_passed(
        q.run_checks(
            empty,
            [
                q.Unique("child", "id"),
                q.Relationship("child", "parent_id", "parent", "id"),
                q.Condition("child", "amount", "amount >= 0"),
            ],
        )
    )


def test_relationships_of_a_table_are_one_pass(spark, tables, rows):
    related = [
        q.Relationship("child", "parent_id", "parent", "id"),
        q.Relationship("child", "amount", "parent", "id"),
        q.Relationship("child", "id", "wide", "id"),
        q.Relationship("parent", "id", "child", "id"),
    ]
    tables["wide"] = spark.createDataFrame([(1,), (5,)], "id long")
    results = q.run_checks(tables, related)
    assert rows(results) == [
        ("relationships", "child", "amount", 3), ("relationships", "child", "id", 1),
        ("relationships", "child", "parent_id", 2), ("relationships", "parent", "id", 0),
    ]


def test_orphans(tables, rows):
    assert rows(q.orphans(tables["child"], "parent_id", tables["parent"], "id")) == [(9, 2)]
