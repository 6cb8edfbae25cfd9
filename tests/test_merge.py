import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeloom.operators import merge

SCHEMA = "k int, t int, v string"
NEWER = "source.t > target.t"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


TARGET = [
    (1, 10, "t"), (2, 10, "t"), (3, 10, "t"), (4, None, "t"), (5, 10, "t"),
    (6, 10, "t"), (None, 10, "t"),
]
SOURCE = [
    (1, 11, "s"),  # newer
    (2, 9, "s"),  # older
    (3, 10, "s"),  # equal
    (4, 11, "s"),  # target's change time unknown
    (5, None, "s"),  # source's change time unknown
    (7, 1, "s"),  # new
    (None, 99, "s"),  # null keys never match
]
MERGED = [
    (1, 11, "s"), (2, 10, "t"), (3, 10, "t"), (4, None, "t"), (5, 10, "t"),
    (6, 10, "t"), (7, 1, "s"), (None, 10, "t"), (None, 99, "s"),
]


@pytest.mark.parametrize("large", [False, True])
def test_upsert_matrix(spark, rows, large):
    merged = merge.upsert(frame(spark, TARGET), frame(spark, SOURCE), ["k"], NEWER, large)
    assert rows(merged) == sorted(MERGED, key=repr)


def test_unconditional_upsert_replaces_every_match(spark, rows):
    merged = merge.upsert(frame(spark, TARGET[:2]), frame(spark, SOURCE[:2]), ["k"])
    assert rows(merged) == [(1, 11, "s"), (2, 9, "s")]


def test_insert_only(spark, rows):
    merged = merge.insert_only(frame(spark, TARGET), frame(spark, SOURCE), ["k"])
    assert rows(merged) == sorted([*TARGET, (7, 1, "s"), (None, 99, "s")], key=repr)


def test_summary(spark):
    summary = merge.upsert_summary(frame(spark, TARGET), frame(spark, SOURCE), ["k"], NEWER)
    assert summary.first().asDict() == {
        "before_count": 7, "incoming_count": 7, "update_count": 1, "insert_count": 2,
        "after_count": 9, "row_count": 3,
    }


def test_candidates(spark, rows):
    target, source = frame(spark, TARGET), frame(spark, SOURCE)
    assert rows(merge.update_candidates(target, source, ["k"], NEWER)) == [(1, 11, "s")]
    assert rows(merge.unmatched(source, target, ["k"])) == [(7, 1, "s"), (None, 99, "s")]


def test_columns_match_by_name_and_take_the_target_types(spark):
    source = spark.createDataFrame([("s", 1, 5, "more")], "v string, k long, t long, extra string")
    merged = merge.upsert(frame(spark, TARGET[:1]), source, ["k"])
    assert merged.schema == frame(spark, []).schema
    with pytest.raises(ValueError, match="lacks"):
        merge.upsert(frame(spark, TARGET), source.drop("t"), ["k"])


@pytest.mark.parametrize("large", [False, True])
def test_two_column_keys(spark, rows, large):
    schema = "a int, b string, v int"
    target = spark.createDataFrame([(1, "x", 0), (1, "y", 0), (1, None, 0)], schema)
    source = spark.createDataFrame([(1, "y", 1), (2, "x", 1), (1, None, 1)], schema)
    assert rows(merge.upsert(target, source, ["a", "b"], large_batch=large)) == sorted(
        [(1, "x", 0), (1, "y", 1), (2, "x", 1), (1, None, 0), (1, None, 1)], key=repr
    )


def test_duplicate_target_rows_are_each_judged(spark, rows):
    target = frame(spark, [(1, 5, "a"), (1, 9, "b")])
    source = frame(spark, [(1, 7, "s")])
    assert rows(merge.upsert(target, source, ["k"], NEWER)) == [(1, 7, "s"), (1, 9, "b")]
    assert merge.classify(target, source, ["k"], NEWER).first()[merge.ACTION] == "update"


def test_duplicate_keys(spark, rows):
    df = frame(spark, [(1, 1, ""), (1, 2, ""), (2, 1, ""), (None, 1, ""), (None, 1, "")])
    assert rows(merge.duplicate_keys(df, ["k"])) == [(1, 2)]


def model(target, source):
    """The merge, one row at a time."""
    out = dict(target)
    for key, row in source.items():
        if key not in out:
            out[key] = row
        elif None not in (row[0], out[key][0]) and row[0] > out[key][0]:
            out[key] = row
    return sorted(((k, *v) for k, v in out.items()), key=repr)


TABLE = st.dictionaries(
    st.integers(0, 8), st.tuples(st.none() | st.integers(0, 3), st.sampled_from("abc")), max_size=8
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(TABLE, TABLE)
def test_against_a_model_and_replay(spark, rows, target, source):
    t = frame(spark, [(k, *v) for k, v in target.items()])
    s = frame(spark, [(k, *v) for k, v in source.items()])
    once = merge.upsert(t, s, ["k"], NEWER)
    assert rows(once) == model(target, source)
    assert rows(merge.upsert(once, s, ["k"], NEWER)) == model(target, source)
    assert rows(merge.upsert(t, s, ["k"], NEWER, large_batch=True)) == model(target, source)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(TABLE, TABLE, st.integers(0, 8))
def test_a_batch_may_be_split(spark, rows, target, source, cut):
    def f(d):
        return frame(spark, [(k, *v) for k, v in d.items()])

    first = {k: v for k, v in source.items() if k < cut}
    rest = {k: v for k, v in source.items() if k >= cut}
    whole = merge.upsert(f(target), f(source), ["k"], NEWER)
    parts = merge.upsert(merge.upsert(f(target), f(first), ["k"], NEWER), f(rest), ["k"], NEWER)
    assert rows(whole) == rows(parts)
