from pyspark.sql import functions as F

from lakeloom.sources.footers import bounded, counted, footer_session, statistics


def written(df, path):
    df.write.parquet(str(path))
    return str(path)


def test_rows_and_bounds_of_all_types(spark, tmp_path):
    df = spark.range(1000).select(
        F.col("id"), F.expr("CAST(id - 5 AS INT) AS small"), F.expr("DATE'2025-01-01' + CAST(id AS INT) AS day"),
        F.expr("IF(id % 2 = 0, CAST(id AS STRING), NULL) AS words"), F.expr("id / 4 AS part"),
        F.expr("TIMESTAMP_NTZ'2025-01-01 00:00:00' + id * INTERVAL '1' SECOND AS at"), F.expr("array(id) AS many"),
    )
    got = statistics(spark, written(df.repartition(3), tmp_path / "t")).collect()
    assert [tuple(r) for r in got] == [
        ("id", 1000, 1000, "0", "999"), ("small", 1000, 1000, "-5", "994"), ("day", 1000, 1000, "2025-01-01", "2027-09-27"),
        ("words", 1000, 500, "0", "998"), ("part", 1000, 1000, "0.0", "249.75"),
        ("at", 1000, 1000, "2025-01-01 00:00:00", "2025-01-01 00:16:39"),
    ]


def test_footers_answer_and_the_session_stays(spark, tmp_path):
    path = written(spark.range(10), tmp_path / "t")
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    files = footer_session(spark).read.parquet(path)
    for asked, pushed in ((counted, "COUNT(*), COUNT(id)"), (bounded, "MIN(id), MAX(id)")):
        plan = asked(files, ["id"])._jdf.queryExecution().executedPlan().toString()
        assert f"PushedAggregation: [{pushed}]" in plan
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


def test_a_file_without_values_and_an_empty_table(spark, tmp_path):
    some = spark.range(10).select("id", F.lit(None).cast("int").alias("none"))
    path = written(some, tmp_path / "t")
    assert [tuple(r) for r in statistics(spark, path).collect()] == [("id", 10, 10, "0", "9"), ("none", 10, 0, None, None)]
    part = spark.range(10).select(F.expr("IF(id < 5, NULL, id) AS k")).repartitionByRange(2, "k")
    assert tuple(statistics(spark, written(part, tmp_path / "p")).first()) == ("k", 10, 5, "5", "9")
    assert statistics(spark, path, footers=False).collect() == statistics(spark, path).collect()
    empty = written(spark.range(0), tmp_path / "e")
    assert tuple(statistics(spark, empty).first()) == ("id", 0, 0, None, None)


def test_named_columns_alone(spark, tmp_path):
    path = written(spark.range(4).select("id", F.lit("x").alias("v")), tmp_path / "t")
    assert [r.column for r in statistics(spark, path, ["v"]).collect()] == ["v"]
    assert statistics(spark, path, []).count() == 0
