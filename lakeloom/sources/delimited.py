"""CSV files with a header, every column text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.quarantine import RECORD, SOURCE

# The columns of the sources that come as CSV files.
CSV_COLUMNS = {
    "marketing_spend": ("spend_date", "channel", "campaign", "spend_amount", "clicks"),
    "supplier_price_list": (
        "product_id", "product_name", "supplier_name", "supplier_cost", "effective_date",
    ),
}


#: How the files are written.
CSV_FORMAT = {"sep": ",", "quote": '"', "escape": "\\"}


def read_csv(
    spark: SparkSession, folder: str, file_name: str, columns: Sequence[str]
) -> DataFrame:
    """Read ``columns`` as strings. Naming them up front saves an inference pass.

    Files stay splittable: a field holds no line break.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    return (
        spark.read.schema(schema)
        .options(header=True, enforceSchema=False, **CSV_FORMAT)
        .csv(f"{folder}/{file_name}")
    )


def read_csv_lines(spark: SparkSession, folder: str, file_name: str, columns: Sequence[str]) -> DataFrame:
    """As ``read_csv``, with the file that each row is from and, of a line with more or fewer fields, the line.

    ``read_csv`` fills such a line up with nulls, or cuts it.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (*columns, RECORD)])
    read = (
        spark.read.schema(schema)
        .options(header=True, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=RECORD)
        .options(columnPruning=False, **CSV_FORMAT)  # a line is only known to be broken if all its fields are parsed
        .csv(f"{folder}/{file_name}")
    )
    return read.select(*columns, RECORD, F.col("_metadata.file_path").alias(SOURCE))
