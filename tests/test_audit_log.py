from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

from lakeloom.plans import audit
from lakeloom.plans.audit import AuditRecord
from lakeloom.sinks.tables import JOINED

NONE = timedelta(0)


def record(name, month=1):
    return AuditRecord("Silver", name, "a", status="SUCCESS", start_time=datetime(2025, month, 3), end_time=datetime(2025, month, 4))


def names(spark, table):
    return sorted(r.source_name for r in table.read(spark).collect())


def test_a_month_is_one_partition_and_the_log_is_the_same(spark, lakehouse):
    table, sink = lakehouse.audit_table(), lakehouse.audit_sink(spark)
    for n in range(5):
        sink(record(f"t{n}", 1 + n // 3))
    before = sorted(map(tuple, table.read(spark).collect()))
    assert audit.compact(spark, table) == {"2025-01": 3, "2025-02": 2}
    # joined partitions are beside the single ones, which nobody reads any more
    assert len(table._listed_leaves(spark)) == 7
    assert sorted(map(tuple, table.read(spark).collect())) == before
    assert audit.compact(spark, table) == {} and len(table._listed_leaves(spark)) == 7
    assert audit.compact(spark, table, NONE) == {} and len(table._listed_leaves(spark)) == 2
    assert sorted(map(tuple, table.read(spark).collect())) == before
    sink(record("late", 1))
    assert audit.compact(spark, table, NONE) == {"2025-01": 2}
    assert names(spark, table) == ["late", "t0", "t1", "t2", "t3", "t4"]


def test_a_reader_sees_neither_loss_nor_copy_at_any_step(spark, lakehouse):
    table, sink = lakehouse.audit_table(), lakehouse.audit_sink(spark)
    for n in range(3):
        sink(record(f"t{n}"))
    early = table.read(spark)  # looked up before the join, read after it
    audit.compact(spark, table)
    assert sorted(r.source_name for r in early.collect()) == ["t0", "t1", "t2"] == names(spark, table)
    joint = next(n for n in table._listed_leaves(spark) if n.startswith(JOINED))
    # a run that died before the catalog heard of the joint partition
    spark.sql(f"ALTER TABLE {table.name} DROP PARTITION (leaf='{joint}')")
    assert names(spark, table) == ["t0", "t1", "t2"]
    audit.compact(spark, table, NONE)
    audit.compact(spark, table, NONE)
    assert names(spark, table) == ["t0", "t1", "t2"] and len(table._listed_leaves(spark)) == 1


def test_writers_go_on_meanwhile(spark, lakehouse):
    table, sink = lakehouse.audit_table(), lakehouse.audit_sink(spark)
    sink(record("first"))
    with ThreadPoolExecutor(7) as pool:
        writing = [pool.submit(sink, record(f"t{n}")) for n in range(14)]
        while not all(w.done() for w in writing):
            audit.compact(spark, table)
            now = names(spark, table)
            assert len(now) == len(set(now)) and "first" in now
        for w in writing:
            w.result()
    audit.compact(spark, table, NONE)
    audit.compact(spark, table, NONE)
    assert names(spark, table) == sorted(["first", *(f"t{n}" for n in range(14))])
    assert len(table._listed_leaves(spark)) == 1


def test_empty_log(spark, lakehouse):
    table = lakehouse.audit_table()
    table.create_if_absent(spark, audit.audit_frame(spark, []).schema)
    assert audit.compact(spark, table) == {} and table.read(spark).count() == 0
