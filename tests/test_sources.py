from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lakeloom import cli
from lakeloom.session import materialise, workspace
from lakeloom.sinks import write_batch, write_full, write_unmarked
from lakeloom.sources import JdbcSource, Split, control_rows, extract, read_batch, read_csv, read_full
from lakeloom.sources.control import CONTROL_SCHEMA


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n int")


def test_a_day_is_replaced_alone(spark, rows, tmp_path):
    base = str(tmp_path)
    write_batch(numbers(spark, 1, 2), base, "t", "2026-01-01")
    write_batch(numbers(spark, 3), base, "t", "2026-01-02")
    write_batch(numbers(spark, 4), base, "t", "2026-01-02")
    assert rows(read_batch(spark, base, "t", "2026-01-01")) == [(1,), (2,)]
    assert rows(read_batch(spark, base, "t", "2026-01-02")) == [(4,)]
    write_batch(numbers(spark, 8), base, "t", "2026-01-03", since=datetime(2026, 1, 2))
    write_batch(numbers(spark, 5), base, "t", "2026-01-03", since=datetime(2026, 1, 2))
    write_batch(numbers(spark, 6), base, "t", "2026-01-03", since=datetime(2026, 1, 3, 1, 2, 3))
    assert rows(read_batch(spark, base, "t", "2026-01-03")) == [(5,), (6,)]
    assert rows(read_batch(spark, base, "t", "2026-01-03", since=datetime(2026, 1, 2))) == [(5,)]
    assert read_full(spark, f"{base}/t", "ingest_date=2026-01-01").count() == 2
    assert list(tmp_path.glob("t/*/*.snappy.parquet"))


def test_absent_day_is_an_empty_batch(spark, tmp_path):
    base = str(tmp_path)
    write_batch(numbers(spark, 1), base, "t", "2026-01-01")
    absent = read_batch(spark, base, "t", "2026-01-09")
    assert absent.dtypes == [("n", "int")] and absent.count() == 0
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_batch(spark, base, "t", "2026-01-09", strict=True)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_batch(spark, base, "nothing", "2026-01-09")


def test_full_copy_is_replaced(spark, rows, tmp_path):
    for values in ((1, 2), (3,)):
        write_full(numbers(spark, *values), str(tmp_path), "t")
    assert rows(read_full(spark, str(tmp_path), "t")) == [(3,)]


def test_a_full_write_that_died_leaves_the_last_copy(spark, rows, tmp_path):
    base = str(tmp_path)
    numbers(spark, 0).write.parquet(f"{base}/t")  # as older releases wrote it
    assert rows(read_full(spark, base, "t")) == [(0,)]
    write_full(numbers(spark, 1, 2), base, "t")
    numbers(spark, 7).write.parquet(f"{base}/t/copy=99991231T000000000000-dead")  # never listed
    dying = numbers(spark, 8).select(F.raise_error(F.lit("died")).cast("int").alias("n"))
    with pytest.raises(Exception, match="died"):
        write_full(dying, base, "t")
    assert rows(read_full(spark, base, "t")) == [(1,), (2,)]


def test_days_with_and_without_marks_are_one_table(spark, rows, tmp_path):
    base, day = str(tmp_path), "2026-01-02"
    write_batch(numbers(spark, 1), base, "t", "2026-01-01")
    write_batch(numbers(spark, 2), base, "t", day, since=datetime(2026, 1, 1))
    write_unmarked(numbers(spark, 3), base, "t", day)
    write_unmarked(numbers(spark, 4), base, "t", day)  # in place of the ones before
    assert rows(read_full(spark, base, "t")) == [(1,), (2,), (4,)]
    assert rows(read_batch(spark, base, "t", day)) == [(2,), (4,)]
    assert rows(read_batch(spark, base, "t", "2026-01-05")) == []
    write_batch(numbers(spark, 9), base, "t", day)  # without a mark: the whole day
    assert rows(read_full(spark, base, "t")) == [(1,), (9,)]


def test_csv(spark, rows, tmp_path):
    text = 'spend_date,channel,clicks\r\n2026-01-01,"Meta, \\"Ads\\"",345\r\n2026-01-02,,7\r\n'
    (tmp_path / "spend.csv").write_bytes(text.encode())
    df = read_csv(spark, str(tmp_path), "spend.csv", ["spend_date", "channel", "clicks"])
    assert rows(df) == [("2026-01-01", 'Meta, "Ads"', "345"), ("2026-01-02", None, "7")]
    assert {t for _, t in df.dtypes} == {"string"}


def test_csv_header_must_match(spark, tmp_path):
    (tmp_path / "spend.csv").write_text("a,b\n1,2\n")
    with pytest.raises(Exception, match="CSV header"):
        read_csv(spark, str(tmp_path), "spend.csv", ["b", "a"]).collect()


MARK = datetime(2025, 1, 2)


def control(spark, *rows):
    return spark.createDataFrame(rows, CONTROL_SCHEMA)


def test_strictly_newer_rows_are_extracted(spark, rows):
    listed = control(
        spark,
        ("orders", "dbo", "incremental", "updated_at", MARK),
        ("customers", "dbo", "full", None, MARK),
    )
    customers, orders = control_rows(listed)
    days = [(n, datetime(2025, 1, n)) for n in (1, 2, 3)] + [(4, None)]
    source = spark.createDataFrame(days, "n int, updated_at timestamp_ntz")
    assert [r[0] for r in rows(extract(source, orders))] == [3]
    assert extract(source, customers).count() == 4


@pytest.mark.parametrize(
    "row",
    [("t", "dbo", "sometimes", None, MARK), ("t", "dbo", "incremental", None, MARK)],
)
def test_bad_control_rows(spark, row):
    with pytest.raises(ValueError):
        control_rows(control(spark, row))


def test_jdbc_options():
    split = Split("order_id", 1, 1000, 8)
    source = JdbcSource("jdbc:x://host/db", {"user": "u"}, {"orders": split})
    plain = {
        "url": "jdbc:x://host/db", "dbtable": "dbo.customers", "fetchsize": "10000",
        "pushDownPredicate": "true", "preferTimestampNTZ": "true", "user": "u",
    }
    assert source.reader_options("dbo", "customers") == plain
    assert source.reader_options("dbo", "orders") == {
        **plain, "dbtable": "dbo.orders", "partitionColumn": "order_id",
        "lowerBound": "1", "upperBound": "1000", "numPartitions": "8",
    }


def test_conditions_go_before_splits_and_are_given_to_the_readers(monkeypatch):
    calls = []

    class Reader:
        def jdbc(self, url, table, predicates, properties):
            calls.append((url, table, predicates, properties))

    class Session:
        read = Reader()

    source = JdbcSource(
        "jdbc:x://host/db", {"user": "u"}, {"orders": Split("order_id", 1, 9, 2)}, conditions={"orders": ["a", "b"]}
    )
    source.read(Session(), "dbo", "orders")
    properties = {"fetchsize": "10000", "pushDownPredicate": "true", "preferTimestampNTZ": "true", "user": "u"}
    assert calls == [("jdbc:x://host/db", "dbo.orders", ["a", "b"], properties)]


def test_even_split_option(spark, tmp_path):
    args = cli.parser().parse_args(
        ["ingest", "--root", "r", "--run_date", "2025-01-01", "--jdbc_url", "jdbc:x",
         "--even_split", "orders:order_id:4", "--even_split", "users:user_id:4"]
    )
    write_full(spark.range(100).withColumnRenamed("id", "order_id"), str(tmp_path), "orders")
    found = cli.even_conditions(args, spark, str(tmp_path))
    assert list(found) == ["orders"] and len(found["orders"]) == 5
    assert cli.jdbc_source(args, found).conditions == found


def test_scratch_is_in_the_shared_folder(spark, rows):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = workspace(spark, "x"), workspace(spark, "x")
    assert first.startswith(base) and first != second
    df = materialise(numbers(spark, 1, 2), "x")
    assert rows(df) == [(1,), (2,)] and df.inputFiles()[0].removeprefix("file://").startswith(base)
