"""Counts and marks of Parquet files from their footers.

The number of rows and the smallest and largest value of whole-number, date and
truth columns stand in each file's footer. Spark's Parquet source takes them from
there if it may push an aggregation down, so no row is read, however many there
are. That is a setting; it is set in a session of its own and the caller's stays
as it is. Columns of other types are scanned, and only they: the footers' order of
times, texts and floating-point numbers is not Spark's. So are columns with nulls,
as a file may hold nothing else in some part of it and has no bounds there; the
footers' counts tell which. Files written without statistics are an error, or
scanned with ``footers=False``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = "column string, n_rows long, n_values long, least string, greatest string"
_IN_FOOTERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.BooleanType)


def footer_session(spark: SparkSession) -> SparkSession:
    """A session whose Parquet source answers plain aggregations from footers."""
    other = spark.newSession()
    other.conf.set("spark.sql.sources.useV1SourceList", "")
    other.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return other


def counted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the rows, and the values of each column."""
    return df.agg(F.count(F.lit(1)).alias("n"), *(F.count(c).alias(f"n{i}") for i, c in enumerate(columns)))


def bounded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the least and the greatest value of each column, as text."""
    sides = [(f"{side}{i}", f(c)) for i, c in enumerate(columns) for side, f in (("least", F.min), ("greatest", F.max))]
    return df.agg(*(value.alias(name) for name, value in sides)).select(*(F.col(name).cast("string") for name, _ in sides))


def statistics(spark: SparkSession, path: str, columns: Sequence[str] | None = None, footers: bool = True) -> DataFrame:
    """A row for each column, in their order: column, n_rows, n_values, least and greatest, as text; null where there is no value.

    columns: by default all but nested ones. They are read at the call.
    """
    plain = spark.read.parquet(path)
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    names = list(columns) if columns is not None else [f.name for f in plain.schema if not isinstance(f.dataType, nested)]
    if not names:
        return spark.createDataFrame([], SCHEMA)
    # of any column the footers know how many values there are
    counts = counted(footer_session(spark).read.parquet(path) if footers else plain, names).first()
    n = counts["n"] or 0  # no footer, no count
    values = {c: counts[f"n{i}"] or 0 for i, c in enumerate(names)}
    cheap = [c for c in names if footers and values[c] == n and isinstance(plain.schema[c].dataType, _IN_FOOTERS)]
    bounds: dict[str, tuple] = {}
    for source, wanted in ((footer_session(spark).read.parquet(path), cheap), (plain, [c for c in names if c not in cheap])):
        if wanted and n:
            found = bounded(source.select(*wanted), wanted).first()
            bounds |= {c: (found[f"least{i}"], found[f"greatest{i}"]) for i, c in enumerate(wanted)}
    return spark.createDataFrame([(c, n, values[c], *bounds.get(c, (None, None))) for c in names], SCHEMA)
