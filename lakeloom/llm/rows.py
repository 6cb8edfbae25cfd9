"""Helpers the operators share: reading documents, ordered buckets, scratch tables."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

import lakeloom
from lakeloom.operators.key_filter import batch_filter
from lakeloom.session import materialise, tune, workspace

__all__ = [
    "batches", "documents", "fresh", "materialise", "numbered", "ordered_buckets", "parted", "per_bucket", "ship", "table", "tasks",
    "tune", "without_losers", "word_blocks", "workspace",
]


#: Texts may be long: what a Python worker is given at once is bounded by bytes, not by rows.
BATCH_BYTES = "8m"


def ship(spark: SparkSession) -> SparkSession:
    """Give the package to the Python workers, once per application, so that they need no path of their own to it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    context = spark.sparkContext
    if getattr(context, "_lakeloom_shipped", False):
        return spark
    package = Path(lakeloom.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="run-")) / "lakeloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._lakeloom_shipped = True
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(ship(spark)).read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, so that other columns of any name do no harm; a null text is empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def batches(frames: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Arrow batches in parts of some rows, so that what is built from each stays small."""
    for batch in frames:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A text in parts of about ``size`` bytes, cut at spaces only, so that a long text's words are not all held at once."""
    at = 0
    while at < len(data):
        end = data.find(b" ", at + size)
        end = end if end >= 0 else len(data)
        yield data[at:end]
        at = end


def numbered(df: DataFrame, order: Sequence[Column], out: str, by: Sequence[str] = (), purpose: str = "numbered") -> DataFrame:
    """``df`` with each row's number, from 0 on, in a total order of all rows or of those with the same ``by``.

    A window would put all rows of one ``by``, or all rows, into one task. Here rows are dealt over tasks by ranges of
    (by, order), so that a hot group is many tasks', and written; a row's number is its place in its task plus the rows of
    its group in the tasks before, of which there are at most as many as tasks. The order must tell all rows apart.
    """
    part, at = fresh(df, "__part"), fresh(df, "__at")
    keys = [*(F.asc(c) for c in by), *order]
    n = tasks(df)
    dealt = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id()  # the partition's number, then 33 bits for the place in it
    placed = dealt.withColumn(part, F.spark_partition_id()).withColumn(at, place.bitwiseAND(F.lit((1 << 33) - 1)))
    placed = materialise(placed, purpose)
    # a group's rows in a task are consecutive: they start at the smallest place
    names = {c: f"__{i}" for i, c in enumerate([*by, part])}
    groups = (F.col(c).alias(n) for c, n in names.items())
    starts = placed.groupBy(*groups).agg(F.min(at).alias("__first"), F.count(F.lit(1)).alias("__rows"))
    before = W.partitionBy(*(names[c] for c in by)).orderBy(names[part]).rowsBetween(W.unboundedPreceding, -1)
    starts = starts.withColumn("__offset", F.coalesce(F.sum("__rows").over(before), F.lit(0)) - F.col("__first")).drop("__first", "__rows")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{n}")) for c, n in names.items()]
    numbered_rows = placed.alias("l").join(starts.alias("r"), same)
    return numbered_rows.select(*(F.col(f"l.{c}") for c in df.columns), (F.col(f"l.{at}") + F.col("r.__offset")).alias(out))


def parted(rows: DataFrame, listed: DataFrame, key: str) -> tuple[DataFrame | None, DataFrame]:
    """The rows whose key is surely not listed, and those whose key may be; None and all if the list is too long."""
    held = batch_filter(rows, listed, [key], listed.count())
    return (None, rows) if held is None else (rows.where(~held), rows.where(held))


def without_losers(docs: DataFrame, digest: Column, decided: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay; decided: doc_id, digest and kept of every row.

    Whole rows meet only the list of those that go, and of them only those whose doc_id a Bloom filter says may be listed: the
    others are not shuffled. Where the list is too long for a filter, all are, once. Of rows with one doc_id and text, of which
    one is kept, one stays: only rows on a list of such repeats are compared.
    """
    one, key, place = fresh(docs, "__id"), fresh(docs, "__key"), fresh(docs, "__place")
    keys = decided.groupBy(F.col("doc_id").alias(one), F.col("digest").alias(f"{key}_")).agg(
        F.count(F.lit(1)).alias("n"), F.max("kept").alias("kept")
    )
    gone = materialise(keys.filter("n > 1 OR NOT kept"), "losers")
    # the filter leaves null keys out; a null doc_id is in it as 0. Digests would cost more than hashes of numbers
    listed = gone.select(F.coalesce(one, F.lit(0).cast("long")).alias(place))
    apart, may = parted(docs.withColumn(place, F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long"))), listed, place)
    keyed = may.drop(place).withColumn(key, digest)
    same = keyed["doc_id"].cast("long").eqNullSafe(F.col(one)) & (F.col(key) == F.col(f"{key}_"))
    left = keyed.join(gone.drop("n", "kept"), same, "left_anti").drop(key)
    if apart is not None:
        left = apart.drop(place).unionByName(left)
    repeats = gone.filter("kept").drop("n", "kept")
    if repeats.isEmpty():
        return left
    again = keyed.join(repeats, same, "left_semi").dropDuplicates(["doc_id", key]).drop(key)
    return left.unionByName(again)


def ordered_buckets(df: DataFrame, key: str, count: int, out: str) -> tuple[DataFrame, int]:
    """Number the rows' buckets so that a lower number means lower keys; equal keys share one. Also how many there may be.

    The bounds are quantiles: ``count`` numbers at most pass through the driver.
    Unlike a range exchange, whose bounds are drawn anew in each plan, these are
    fixed, so several plans agree on them. Null keys come first.
    """
    steps = [i / count for i in range(1, count)]
    cuts = df.select(F.col(key).cast("double").alias(key)).stat.approxQuantile(key, steps, 0.25 / count) if steps else []
    if not cuts:
        return df.withColumn(out, F.when(F.col(key).isNull(), 0).otherwise(1)), 2
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    number, raw = fresh(df, "__number"), fresh(df, "__bucket")
    cut = Bucketizer(splits=splits, inputCol=number, outputCol=raw, handleInvalid="keep")
    bucketed = (
        cut.transform(df.withColumn(number, F.col(key).cast("double")))
        .withColumn(out, F.when(F.col(key).isNull(), 0).otherwise(F.col(raw).cast("int") + 1))
        .drop(number, raw)
    )
    return bucketed, len(splits)


def per_bucket(df: DataFrame, bucket: str, count: int, order: Sequence[str]) -> DataFrame:
    """Each of ``count`` buckets whole in a partition of its own, in the given order."""
    return df.repartitionById(count, F.col(bucket)).sortWithinPartitions(bucket, *order)
