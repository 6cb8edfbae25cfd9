"""Exact deduplication of texts through content-defined chunk recipes.

Two texts are equal when they are the same after each run of white space
(``[\\x20\\x09-\\x0D]+``) is replaced by one space. Of equal texts the row with the
smallest doc_id stays.

Method: each normalised text is cut where its content says so (a hash of the
last eight bytes), between a least and a most size, so that shared passages give
the same chunks wherever they stand. A chunk's identifier is a 64-bit hash,
verified: the distinct chunks are brought together once by hash, and where
two different chunks share one, they are told apart by a number. A document
is then its recipe, the ordered list of identifiers, and equal recipes mean
equal texts. Long documents are not moved: only distinct chunks, then recipes.

A null text is empty; a null doc_id counts as larger than any other. Rows that
repeat a doc_id and its text are rows of one group, of which exactly one stays.
An empty table gives an empty result; other columns are ignored. A text of any
length becomes chunks of bounded size. One group may hold most rows: groups are
counted before the shuffle, and the join that brings the counts back is one
that Spark can split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeloom.llm.rows import batches, documents, materialise, without_losers
from lakeloom.operators.spread import spread_join

#: Each run of white space that isn't just one space.
_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def normalised(text) -> F.Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUNS, " ")


def cuts(data: bytes, least: int = 256, average: int = 1024, most: int = 8192) -> list[int]:
    """Ends of the chunks of ``data``; the last is its length. Empty data has none."""
    n = len(data)
    if n <= least:
        return [n] if n else []
    window = np.ndarray((n - 7,), "<u8", data, strides=(1,))
    top = (window * _MIX) >> np.uint64(65 - average.bit_length())
    ends, start = [], 0
    for end in (np.flatnonzero(top == 0) + 8).tolist():
        while end - start > most:
            start += most
            ends.append(start)
        if end - start >= least:
            start = end
            ends.append(end)
    while n - start > most:
        start += most
        ends.append(start)
    return ends if start == n else [*ends, n]


def identifiers(data: bytes, id_bits: int) -> tuple[list[int], list[bytes]]:
    """The hash of each chunk as a signed number of ``id_bits`` bits, and the chunks."""
    chunks, start = [], 0
    for end in cuts(data):
        chunks.append(data[start:end])
        start = end
    shift = 64 - id_bits
    return [(xxhash.xxh3_64_intdigest(c) >> shift) - (1 << (id_bits - 1)) for c in chunks], chunks


def _distinct_chunks(texts: DataFrame, id_bits: int) -> DataFrame:
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(frames):
            seen: dict[bytes, int] = {}
            for text in batch.column("text").to_pylist():
                ids, chunks = identifiers(text.encode(), id_bits)
                seen.update(zip(chunks, ids, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(seen.values(), pa.int64()), pa.array(seen.keys(), pa.binary())], ["id", "chunk"])

    return texts.select("text").mapInArrow(run, "id long, chunk binary").distinct()


def _recipes(texts: DataFrame, id_bits: int) -> DataFrame:
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(frames):
            data = [t.encode() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([hashlib.sha256(d).digest() for d in data], pa.binary()),
                    pa.array([identifiers(d, id_bits)[0] for d in data], pa.list_(pa.int64())),
                ],
                ["doc_id", "digest", "recipe"],
            )

    return texts.mapInArrow(run, "doc_id long, digest binary, recipe array<long>")


def doubtful_chunks(recipes: DataFrame, texts: DataFrame, doubtful: DataFrame, id_bits: int) -> DataFrame:
    """digest, place, id and chunk of the chunks whose hash different chunks share; other texts and chunks are not read again.

    Which documents hold one is known from their recipes. Their texts, each different one once, are found by digest: a list
    of few goes to the texts, a long one is met by a shuffle of them.
    """
    placed = recipes.select("digest", F.explode(F.array_distinct("recipe")).alias("id"))
    held = spread_join(placed, doubtful, ["id"], "left_semi").groupBy("digest").agg(F.collect_set("id").alias("ids"))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(frames, 200):
            rows: list[tuple] = []
            for digest, text, wanted in zip(*(batch.column(c).to_pylist() for c in ("digest", "text", "ids")), strict=True):
                ids, chunks = identifiers(text.encode(), id_bits)
                asked = set(wanted)
                rows += [(digest, i, h, c) for i, (h, c) in enumerate(zip(ids, chunks, strict=True)) if h in asked]
            kinds = (pa.binary(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["digest", "place", "id", "chunk"]
            )

    keyed = texts.select(F.unhex(F.sha2("text", 256)).alias("digest"), "text")
    found = keyed.join(held, "digest").dropDuplicates(["digest"])
    return found.mapInArrow(run, "digest binary, place int, id long, chunk binary")


def _told_apart(recipes: DataFrame, texts: DataFrame, shared: DataFrame, doubtful: DataFrame, id_bits: int) -> DataFrame:
    """Add to each recipe the numbers of its chunks among different chunks of one hash, by place."""
    number = W.partitionBy("id").orderBy("chunk")  # a hash of 64 bits is shared by a handful of chunks at most
    numbered = shared.withColumn("number", F.row_number().over(number))
    chunks = doubtful_chunks(recipes, texts, doubtful, id_bits)
    found = spread_join(chunks, numbered, ["id", "chunk"], "inner")
    lists = found.groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("place", "number"))).alias("apart"))
    return spread_join(recipes, lists, ["digest"], "left")


def exact_duplicates(docs: DataFrame, id_bits: int = 64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept and text_sha256 (of the normalised text).

    id_bits: bits of a chunk's hash; fewer make different chunks share one, which the tests use.
    """
    texts = documents(docs).withColumn("text", normalised(F.col("text")))
    chunks = _distinct_chunks(texts, id_bits)
    doubtful = materialise(chunks.groupBy("id").count().filter("count > 1").select("id"), "shared-ids")
    recipes = materialise(_recipes(texts, id_bits).withColumn("row_number", F.monotonically_increasing_id()), "recipes")
    key = ["recipe"]
    if not doubtful.isEmpty():
        shared = materialise(chunks.join(doubtful, "id", "left_semi"), "shared-chunks")
        recipes, key = _told_apart(recipes, texts, shared, doubtful, id_bits), ["recipe", "apart"]
        recipes = recipes.withColumn("apart", F.coalesce("apart", F.array().cast("array<struct<place:int,number:int>>")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_number")).alias("first")
    groups = recipes.groupBy(*key).agg(first, F.count("*").alias("size")).filter("size > 1")
    first_row = F.col("first.row_number")
    return spread_join(recipes, groups, key, "left").select(
        "doc_id",
        F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("size").isNull() | (first_row == F.col("row_number"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay."""
    decided = exact_duplicates(docs).select("doc_id", F.col("text_sha256").alias("digest"), "kept")
    return without_losers(docs, F.sha2(normalised(F.col("text").cast("string")), 256), decided)
