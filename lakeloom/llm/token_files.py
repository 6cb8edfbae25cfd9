"""Token ids in ORC files, in ascending order of document.

Method: ORC writes integers run-length encoded in stripes, with a row index and
a Bloom filter on ``doc_id``: readers take stripes in parallel and skip those
that can't hold the document asked for. One row is a document: ``doc_id``,
``bucket`` and ``bucket_start`` (ids of the documents before it in its bucket),
``n_tokens`` and ``ids``. The buckets are ranges of ``doc_id``, one file each,
so a document's place among all ids is its bucket's first place, a sum over the
few buckets, plus ``bucket_start``; no task sees all documents.

A null text is empty (the end id alone); a null doc_id comes before all others;
equal doc_ids are ordered by text; an empty table gives empty files; other
columns of the input are ignored. A document's ids are held whole by one task,
a range of documents never is. A doc_id is an identifier: rows that share one,
or have none, are written by one task.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.rows import batches, documents, ordered_buckets, per_bucket, tasks
from lakeloom.llm.vocab import encoder

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("bucket_start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
    ]
)
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("bucket", pa.int32()), ("bucket_start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))]
)

#: Pre-tokens that a worker holds, some 150 MB at most. Those that it forgets are encoded again.
KNOWN = 800_000


def write_token_files(docs: DataFrame, path: str, file: str, end_id: int, stripe_bytes: int = 32 << 20) -> None:
    """Encode every text, append ``end_id`` to each and write the ids."""
    end = struct.pack("<I", end_id)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, at, now = encoder(file, KNOWN), 0, None
        for batch in batches(frames, 500):
            ids = [known.encode(t) + end for t in batch.column("text").to_pylist()]
            sizes = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
            starts = []
            for bucket, n in zip(batch.column("bucket").to_pylist(), sizes.tolist(), strict=True):
                at, now = (0 if bucket != now else at), bucket
                starts.append(at)
                at += n
            flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
            offsets = pa.array(np.fromiter(accumulate(sizes.tolist(), initial=0), np.int32, len(ids) + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("bucket"),
                    pa.array(starts, pa.int64()),
                    pa.array(sizes),
                    pa.ListArray.from_arrays(offsets, flat),
                ],
                schema=_ARROW,
            )

    bucketed, count = ordered_buckets(documents(docs), "doc_id", tasks(docs), "bucket")
    (
        per_bucket(bucketed, "bucket", count, ["doc_id", "text"])
        .mapInArrow(run, SCHEMA)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.create.index", "true")
        .option("orc.stripe.size", str(stripe_bytes))
        .option("orc.compress", "ZSTD")
        .orc(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids."""
    rows = spark.read.schema(SCHEMA).orc(path)
    sums = rows.groupBy("bucket").agg(F.sum("n_tokens").alias("n")).collect()  # a row for each bucket
    sums.sort(key=lambda r: r.bucket)
    first = accumulate((r.n for r in sums), initial=0)
    bases = spark.createDataFrame([(r.bucket, n) for r, n in zip(sums, first, strict=False)], "bucket int, base long")
    return rows.join(F.broadcast(bases), "bucket").select(
        "doc_id", (F.col("base") + F.col("bucket_start")).alias("start"), "n_tokens", "ids"
    )


def tokens_of(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The rows of some documents; stripes without them are skipped by their index and Bloom filter."""
    return spark.read.schema(SCHEMA).orc(path).filter(F.col("doc_id").isin(doc_ids))


def with_checksum(rows: DataFrame, ids: str = "ids", out: str = "ids_crc32") -> DataFrame:
    """Put the CRC-32 of the ids, as little-endian unsigned 32-bit integers, in the place of the ids."""
    kept = [c for c in rows.columns if c != ids]
    schema = T.StructType([*rows.select(*kept).schema.fields, T.StructField(out, T.LongType())])

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            lists = batch.column(ids)
            flat = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)).view("u1")
            at = 4 * lists.offsets.to_numpy().astype(np.int64)
            sums = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(sums, pa.int64())], [*kept, out])

    return rows.mapInArrow(run, schema)
