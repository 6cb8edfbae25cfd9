"""Near duplicates by SimHash fingerprints of 64 bits.

A text's words are runs of other characters than ``[\\x20\\x09-\\x0D]``, with A-Z
in lower case; its shingles are each four words in a row, repeats included (all
words if there are fewer). A bit of the fingerprint is set if it is set in over
half of the shingles' XXH64 (seed 42). Documents are linked where their
fingerprints differ in at most ``distance`` bits; components are what links join.

Method (multi-index hashing): a fingerprint is cut into segments. Two
fingerprints within the distance differ, in one segment at least, in no more
bits than that segment's radius; the radii and the number of segments add up to
more than the distance. So each fingerprint is filed under its segments,
and asks for all values in a small Hamming ball around each of them; whole
distances are verified in the join itself. Of two values, only the one with a 0
in the lowest bit that differs asks, which halves the work and loses nothing.

Distinct fingerprints are joined, not documents: copies share one. A text without
words has fingerprint 0 and is linked like any other, a null text too. Repeated
rows and repeated doc_ids each give a row; a null doc_id gives its row and
counts as larger than any other. Empty tables give empty results; other columns
are ignored. A long text's shingles are hashed in slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.components import components
from lakeloom.llm.rows import batches, documents, materialise, without_losers
from lakeloom.operators.spread import spread_join

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: str, width: int = 4, slice_: int = 50_000) -> int:
    """As a signed number."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return 0
    line, hash_ = b" ".join(words), xxhash.xxh64_intdigest
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    width = min(width, len(words))
    n = len(words) - width + 1
    set_ = np.zeros(64, np.int64)
    for at in range(0, n, slice_):
        ends = starts[at + width : min(n, at + slice_) + width]
        hashes = np.array([hash_(line[a : b - 1], 42) for a, b in zip(starts[at:], ends, strict=False)], "<u8")
        set_ += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_ > n, bitorder="little").view("<i8")[0])


def _text_key(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def fingerprints(docs: DataFrame, width: int = 4, with_key: bool = False) -> DataFrame:
    """doc_id and fingerprint (signed) of every document, and its text's SHA-256 if asked for."""
    kept = ["doc_id", *["text_key"] * with_key]

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(frames):
            found = [fingerprint(t, width) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(found, pa.int64())], [*kept, "fingerprint"])

    texts = documents(docs)
    if with_key:
        texts = texts.withColumn("text_key", _text_key(F.col("text")))
    return texts.mapInArrow(run, f"doc_id long, {'text_key binary, ' * with_key}fingerprint long")


def segment_count(n: int) -> int:
    """Segments for n fingerprints. Any number finds all links; more of them mean fewer questions but fuller files."""
    return 3 if n < 1 << 28 else 2


def segments(count: int, distance: int) -> list[tuple[int, int, int]]:
    """First bit, bits and radius of each segment. Radii plus one add up to distance plus one, so no link is missed."""
    sizes = [64 // count + (i < 64 % count) for i in range(count)]
    radii = [(distance + 1) // count + (i < (distance + 1) % count) - 1 for i in range(count)]
    return [(at, size, r) for at, size, r in zip(accumulate(sizes, initial=0), sizes, radii, strict=False) if r >= 0]


def ball(bits: int, radius: int) -> list[int]:
    """All values of so many bits with at most ``radius`` of them set."""
    return [sum(1 << b for b in of) for r in range(radius + 1) for of in combinations(range(bits), r)]


def _signed(value: int) -> Column:
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("long")


def links(distinct: DataFrame, distance: int, count: int) -> DataFrame:
    """All pairs (a, b) of the fingerprints in ``distinct`` (one row each) within the distance, once or a few times."""
    asks, files = [], []
    for number, (at, size, radius) in enumerate(segments(count, distance)):
        value = F.shiftrightunsigned("fingerprint", at).bitwiseAND(F.lit((1 << size) - 1 if size < 64 else -1))
        of = distinct.select("fingerprint", value.alias("value"), F.lit(number).alias("segment"))
        files.append(of.withColumnRenamed("fingerprint", "b"))
        # each mask with its lowest bit
        around = F.array(*(F.struct(_signed(v).alias("mask"), _signed(v & -v).alias("low")) for v in ball(size, radius)))
        masks = of.select(F.col("fingerprint").alias("a"), "segment", "value", F.inline(around))
        asks.append(
            masks.filter(F.col("value").bitwiseAND(F.col("low")) == 0).select(
                "a", "segment", F.col("value").bitwiseXOR(F.col("mask")).alias("value"), (F.col("mask") == 0).alias("same")
            )
        )
    ask, file = asks[0], files[0]
    for more_asks, more_files in zip(asks[1:], files[1:], strict=True):
        ask, file = ask.unionByName(more_asks), file.unionByName(more_files)
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    once = ~F.col("same") | (F.col("a") < F.col("b"))  # equal values ask for each other
    found = ask.alias("x").join(
        file.alias("y"), (F.col("x.segment") == F.col("y.segment")) & (F.col("x.value") == F.col("y.value")) & close & once
    )
    return found.select("a", "b")


def near_duplicates(
    docs: DataFrame, distance: int = 4, width: int = 4, count: int | None = None, with_key: bool = False
) -> DataFrame:
    """One row per document: doc_id, fingerprint (signed), component_id (its smallest doc_id), component_key.

    component_key is the component's smallest fingerprint: unique to it even where doc_ids repeat.
    with_key: also text_key, the text's SHA-256.
    """
    prints = materialise(fingerprints(docs, width, with_key), "fingerprints")
    distinct = materialise(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    found = links(distinct.select("fingerprint"), distance, count or segment_count(distinct.count()))
    roots = components(found)
    rooted = spread_join(distinct, roots.withColumnRenamed("node", "fingerprint"), ["fingerprint"], "left")
    rooted = rooted.withColumn("component_key", F.coalesce("root", "fingerprint")).drop("root")
    least = rooted.groupBy("component_key").agg(F.min("least").alias("component_id"))
    named = spread_join(rooted.drop("least"), least, ["component_key"], "inner")
    columns = ["doc_id", "fingerprint", "component_id", "component_key", *["text_key"] * with_key]
    return spread_join(prints, named, ["fingerprint"], "inner").select(*columns)


def drop_near_duplicates(docs: DataFrame, distance: int = 4, width: int = 4) -> DataFrame:
    """The rows of ``docs``, with all their columns, less all but one document of each component.

    The one with the component's smallest doc_id stays; if rows share it, one of them.
    """
    found = near_duplicates(docs, distance, width, with_key=True).select("doc_id", "text_key", "component_key")
    mine = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")  # null doc_ids come last
    found = materialise(found.withColumn("mine", mine), "near-groups")
    first = found.groupBy("component_key").agg(F.min("mine").alias("first"))
    decided = spread_join(found, first, ["component_key"], "inner").select(
        "doc_id", F.col("text_key").alias("digest"), F.col("mine").eqNullSafe(F.col("first")).alias("kept")
    )
    return without_losers(docs, _text_key(F.coalesce(F.col("text").cast("string"), F.lit(""))), decided)
