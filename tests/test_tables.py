import pytest
from pyspark.sql import functions as F

from lakeloom.sinks import tables
from lakeloom.sinks.tables import RANGE, MergeCounts, Ranges, Table
from test_merge import MERGED, NEWER, SOURCE, TARGET, frame


@pytest.fixture(params=[None, Ranges("k", 3)], ids=["plain", "ranges"])
def table(request, lakehouse):
    return Table(
        f"{lakehouse.silver}.t", f"{lakehouse.root}/silver/t", ("k",), request.param
    )


def partitions(spark, table):
    """Folder of each partition the catalog knows."""
    out = {}
    for row in spark.sql(f"SHOW PARTITIONS {table.name}").collect():
        value = int(row[0].split("=")[1])
        detail = spark.sql(f"DESCRIBE EXTENDED {table.name} PARTITION ({row[0]})")
        out[value] = detail.where("col_name = 'Location'").first().data_type
    return out


def test_first_run_creates(spark, rows, table):
    assert not table.exists(spark)
    counts = table.upsert(frame(spark, TARGET), NEWER)
    assert counts == MergeCounts(0, 7, 0, 7)
    assert rows(table.read(spark)) == sorted(TARGET, key=repr)


def test_created_empty_and_kept(spark, table):
    schema = frame(spark, []).schema
    table.create_if_absent(spark, schema)
    assert table.read(spark).schema == schema
    table.upsert(frame(spark, TARGET))
    table.create_if_absent(spark, schema)
    assert table.read(spark).count() == len(TARGET)


def test_upsert_matrix(spark, rows, table):
    table.upsert(frame(spark, TARGET), NEWER)
    counts = table.upsert(frame(spark, SOURCE), NEWER)
    assert counts == MergeCounts(7, 7, 1, 2)
    assert (counts.after, counts.changed) == (9, 3)
    assert rows(table.read(spark)) == sorted(MERGED, key=repr)
    assert table.read(spark).columns == ["k", "t", "v"]


def test_replay_changes_nothing(spark, rows, table):
    batch = frame(spark, [r for r in SOURCE if r[0] is not None])
    table.upsert(frame(spark, TARGET), NEWER)
    table.upsert(batch, NEWER)
    once = rows(table.read(spark))
    counts = table.upsert(batch, NEWER)
    assert (counts.updates, counts.inserts) == (0, 0)
    assert rows(table.read(spark)) == once


def test_the_target_need_not_be_counted(spark, table):
    table.upsert(frame(spark, TARGET), NEWER, count_target=False)
    counts = table.upsert(frame(spark, SOURCE), NEWER, count_target=False)
    assert (counts.before, counts.after, counts.updates, counts.inserts) == (None, None, 1, 2)


def test_insert_only_touches_nothing(spark, rows, table):
    table.insert_new(frame(spark, TARGET))
    counts = table.insert_new(frame(spark, SOURCE))
    assert (counts.updates, counts.inserts) == (0, 2)
    assert rows(table.read(spark)) == sorted([*TARGET, (7, 1, "s"), (None, 99, "s")], key=repr)


def test_only_touched_ranges_are_rewritten(spark, rows, lakehouse):
    table = Table(f"{lakehouse.silver}.r", f"{lakehouse.root}/r", ("k",), Ranges("k", 10))
    table.upsert(frame(spark, [(k, 1, "t") for k in range(40)]), NEWER)
    before = partitions(spark, table)
    assert sorted(before) == [0, 1, 2, 3]
    # 5 is replaced, 15 is stale, 25 was deleted nowhere, 41 is new
    table.upsert(frame(spark, [(5, 2, "s"), (15, 0, "s"), (41, 1, "s")]), NEWER)
    after = partitions(spark, table)
    assert {v for v in after if after[v] != before.get(v)} == {0, 4}
    assert rows(table.read(spark).where("v = 's'")) == [(41, 1, "s"), (5, 2, "s")]
    # a new key in a range that was moved before lands in the moved folder
    table.insert_new(frame(spark, [(-3, 1, "s")]))
    table.upsert(frame(spark, [(6, 2, "s"), (9, 0, "x")]), NEWER)
    assert table.read(spark).count() == 42


def test_ranges_may_follow_another_column(spark, rows, lakehouse):
    schema = "item int, order_id int, q int"
    table = Table(f"{lakehouse.silver}.i", f"{lakehouse.root}/i", ("item",), Ranges("order_id", 2))
    table.upsert(spark.createDataFrame([(1, 1, 0), (2, 4, 0)], schema))
    table.upsert(spark.createDataFrame([(2, 4, 1), (3, 1, 1)], schema))
    assert rows(table.read(spark)) == [(1, 1, 0), (2, 4, 1), (3, 1, 1)]
    assert rows(table.read(spark, ranges=[2])) == [(2, 4, 1)]


def test_replace(spark, rows, table):
    assert table.replace(frame(spark, TARGET)) == 7
    old = table.read(spark).where(F.col("k") == 1)
    assert table.replace(frame(spark, [(1, 0, "n"), (100, 0, "n")])) == 2
    assert rows(table.read(spark)) == [(1, 0, "n"), (100, 0, "n")]
    assert old.columns == ["k", "t", "v"]
    with pytest.raises(ValueError, match="differ"):
        table.replace(frame(spark, TARGET).drop("t"))


def test_a_table_may_be_replaced_from_itself(spark, rows, table):
    table.replace(frame(spark, TARGET[:3]))
    table.replace(table.read(spark).where("k > 1"))
    assert [r[0] for r in rows(table.read(spark))] == [2, 3]


def test_duplicate_source_keys_raise(spark, rows, table):
    table.upsert(frame(spark, TARGET), NEWER)
    with pytest.raises(ValueError, match="more than once"):
        table.upsert(frame(spark, [(1, 50, "a"), (1, 51, "b")]), NEWER)
    assert rows(table.read(spark)) == sorted(TARGET, key=repr)


def test_merge_statement_is_valid_sql(spark, table):
    table.replace(frame(spark, TARGET))
    source = frame(spark, SOURCE)
    if table.ranges:
        source = source.withColumn(RANGE, table.ranges.of())
    source.createOrReplaceTempView("s")
    statement = table.merge_statement("s", NEWER, insert_only=False)
    # plain Parquet understands the statement and then refuses it
    with pytest.raises(Exception, match="UNSUPPORTED_FEATURE.TABLE_OPERATION"):
        spark.sql(statement)
    assert "WHEN MATCHED" not in table.merge_statement("s", None, insert_only=True)


def test_a_first_load_is_written_once(spark, rows, table, monkeypatch):
    monkeypatch.setattr(tables, "materialise", lambda *_: pytest.fail("written twice"))
    first = frame(spark, TARGET[:3] + TARGET[-1:])
    assert table.insert_new(first.where("false"), source_is_unique=True) == MergeCounts(0, 0, 0, 0)
    assert table.insert_new(first, source_is_unique=True, count_target=False) == MergeCounts(None, 4, 0, 4)
    assert rows(table.read(spark)) == sorted(TARGET[:3] + TARGET[-1:], key=repr)


def test_a_large_insert_only_batch_is_joined_once(spark, rows, table, monkeypatch):
    table.upsert(frame(spark, [*TARGET, (9, 1, "t")]))
    table.insert_new(frame(spark, [(10, 1, "t")]))
    monkeypatch.setattr(tables, "FILTERED_FROM", 1)
    for name in ("classify", "update_matched"):
        monkeypatch.setattr(tables.m, name, lambda *_: pytest.fail("joined again"))
    batch = [(1, 99, "s"), (9, 99, "s"), (11, 1, "s"), (70, 1, "s"), (None, 98, "s")]
    assert table.insert_new(frame(spark, batch)) == MergeCounts(9, 5, 0, 3)
    assert rows(table.read(spark)) == sorted([*TARGET, (9, 1, "t"), (10, 1, "t"), *batch[2:]], key=repr)


def test_a_stored_batch_is_not_written_again(spark, rows, table, monkeypatch):
    table.upsert(frame(spark, TARGET), NEWER)
    purposes = []
    written = tables.materialise
    monkeypatch.setattr(tables, "materialise", lambda df, purpose: purposes.append(purpose) or written(df, purpose))
    assert table.upsert(written(frame(spark, SOURCE), "given"), NEWER, stored=True) == MergeCounts(7, 7, 1, 2)
    assert rows(table.read(spark)) == sorted(MERGED, key=repr)
    assert purposes == ["changes"]
