import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_merge import MERGED, NEWER, SOURCE, TABLE, TARGET, frame, model

from lakeloom.operators import key_filter, merge
from lakeloom.sinks import tables
from lakeloom.sinks.tables import Table


def test_matrix_with_a_filter(spark, rows):
    target, source = frame(spark, TARGET), frame(spark, SOURCE)
    assert rows(merge.upsert(target, source, ["k"], NEWER, batch_rows=7)) == sorted(MERGED, key=repr)
    assert rows(merge.unmatched(source, target, ["k"], 7)) == [(7, 1, "s"), (None, 99, "s")]
    assert rows(merge.insert_only(target, source, ["k"], 7)) == sorted([*TARGET, (7, 1, "s"), (None, 99, "s")], key=repr)
    same = merge.classify(target, source, ["k"], NEWER)
    assert rows(merge.classify(target, source, ["k"], NEWER, 7)) == rows(same)


def test_empty_batch_and_target(spark, rows):
    empty, target = frame(spark, []), frame(spark, TARGET)
    assert rows(merge.upsert(target, empty, ["k"], NEWER, batch_rows=0)) == sorted(TARGET, key=repr)
    assert rows(merge.upsert(empty, target, ["k"], NEWER, batch_rows=7)) == sorted(TARGET, key=repr)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(TABLE, TABLE)
def test_against_the_model(spark, rows, target, source):
    t, s = (frame(spark, [(k, *v) for k, v in d.items()]) for d in (target, source))
    assert rows(merge.upsert(t, s, ["k"], NEWER, batch_rows=len(source))) == model(target, source)


@pytest.mark.parametrize("keys", [["k"], ["k", "name"]])
def test_no_key_is_turned_away_and_few_others_pass(spark, keys):
    every = spark.range(60_000).select(F.col("id").alias("k"), F.concat(F.lit("é"), "id").alias("name"))
    batch = every.where("k % 20 = 7")
    held = key_filter.batch_filter(every, batch, keys, 3000)
    passed = every.where(held).agg(F.count("*"), F.count_if(F.expr("k % 20 = 7"))).first()
    assert passed[1] == 3000 and passed[0] - 3000 < 57_000 * 0.03


def test_size_is_bounded_and_keys_must_hash_alike(spark):
    assert key_filter.filter_bits(0) == 4096
    assert all(10 * n <= key_filter.filter_bits(n) <= max(4096, 20 * n) for n in (1, 1000, 10**6, 13 * 10**6))
    assert key_filter.filter_bits(key_filter.MOST_BITS) is None
    ints, longs = (spark.range(3).select(F.col("id").cast(t).alias("k")) for t in ("int", "long"))
    floats = spark.range(3).select(F.col("id").cast("double").alias("k"))
    assert key_filter.batch_filter(ints, longs, ["k"], 3) is None
    assert key_filter.batch_filter(floats, floats, ["k"], 3) is None
    # without a filter the merge is the plain one
    assert merge.upsert(floats, floats, ["k"], batch_rows=3).count() == 3


def test_rows_are_turned_away_before_they_are_shuffled(spark):
    target = spark.range(50_000).select(F.col("id").alias("k"), F.lit(1).alias("t"))
    batch = target.where("k % 50 = 0").withColumn("t", F.lit(2))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = merge.classify(target, batch, ["k"], NEWER, batch_rows=1000)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.where(F.col(merge.ACTION) == "update").count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # read from the scan upwards, the subquery's filter comes first and the join's exchange after it
    side = plan[plan.index("SortMergeJoin") :]
    side = side[side.index("SortMergeJoin", 1) :]
    assert side.index("Exchange hashpartitioning(k") < side.index("Subquery subquery") < side.index("Range (0, 50000")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("ranges", [None, tables.Ranges("k", 100)])
def test_table_merges_of_large_batches_are_filtered(spark, tmp_path, monkeypatch, ranges):
    asked = []
    plain = merge.batch_filter
    monkeypatch.setattr(merge, "batch_filter", lambda *a: asked.append(a[3]) or plain(*a))
    monkeypatch.setattr(tables, "FILTERED_FROM", 50)
    spark.sql("CREATE DATABASE IF NOT EXISTS filtered")
    name = f"filtered.t_{'ranges' if ranges else 'plain'}"
    table = Table(name, str(tmp_path / "t"), ("k",), ranges)
    first = spark.range(1000).select(F.col("id").cast("int").alias("k"), F.lit(1).alias("t"), F.lit("a").alias("v"))
    table.upsert(first, NEWER)
    second = spark.range(940, 1040).select(F.col("id").cast("int").alias("k"), F.lit(2).alias("t"), F.lit("b").alias("v"))
    counts = table.upsert(second, NEWER)
    assert (counts.updates, counts.inserts, asked) == (60, 40, [100, 60])
    got = table.read(spark).groupBy("v").count().collect()
    assert {r["v"]: r["count"] for r in got} == {"a": 940, "b": 100}
    assert table.upsert(second, NEWER).changed == 0
    spark.sql(f"DROP TABLE {name}")
