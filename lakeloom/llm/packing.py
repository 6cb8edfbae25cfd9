"""Documents packed into sequences of a fixed number of tokens with little padding.

Method (best-fit decreasing): a document longer than a sequence is first cut
into full ones; what is left of it, and every shorter document, is an item. The
items are dealt evenly into groups of about a million tokens; in each, from the
longest to the shortest, an item goes into the open sequence with the least room
that holds it. A segment tree over the remaining rooms, one leaf for each
possible room, finds that sequence in as many steps as the length has bits.

A null text is empty and gives the end id alone. Repeated rows, and rows with
equal or null doc_ids, are packed each by itself. An empty table gives an empty
result; other columns of the input are ignored. A text of any length is cut into
pieces of at most one sequence; only its own ids are held at once.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.rows import batches, documents, materialise, tasks
from lakeloom.llm.vocab import encoder

#: Tokens packed together, about: a group leaves a sequence or two partly empty, some 0.2 % of these.
GROUP_TOKENS = 1_000_000
#: Items packed together, at most about: the bound on a task's memory where items are a few tokens each.
GROUP_ITEMS = 100_000


class Rooms:
    """Open sequences by their remaining room: a segment tree that tells whether any has room between two bounds."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.any = [0] * (2 * self.leaves)  # open sequences below each node
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        node = room + self.leaves
        while node:
            self.any[node] += 1
            node >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove the sequence with the least room of at least ``length``: its room and number."""
        node = length + self.leaves
        if not self.any[node]:
            while node > 1 and (node & 1 or not self.any[node + 1]):  # up to the first right neighbour with any
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        room = node - self.leaves
        while node:
            self.any[node] -= 1
            node >>= 1
        return room, self.open[room].pop()


def best_fit(lengths: list[int], size: int) -> tuple[list[int], list[int]]:
    """The sequence of each item, from 0 on, and its offset there. The lengths are in descending order, 1 to ``size``."""
    rooms, sequences, offsets, count = Rooms(size), [], [], 0
    for length in lengths:
        room, sequence = rooms.take(length) or (size, count)
        count += sequence == count
        sequences.append(sequence)
        offsets.append(size - room)
        if room > length:
            rooms.put(room - length, sequence)
    return sequences, offsets


def cut_documents(docs: DataFrame, file: str, end_id: int, size: int, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``size`` ids: doc_id, start, length, ids_crc32, doc_tokens, and the ids if asked for."""
    end = struct.pack("<I", end_id)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(file)
        for batch in batches(frames):
            out: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = known.encode(text) + end
                for at in range(0, len(ids), 4 * size):
                    piece = ids[at : at + 4 * size]
                    row = (doc_id, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4)
                    out.append((*row, np.frombuffer(piece, "<i4")) if with_ids else row)
            kinds = [pa.int64()] * 5 + [pa.list_(pa.int32())]
            columns = [pa.array([r[i] for r in out], kinds[i]) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return documents(docs).mapInArrow(run, ", ".join(f"{n} {'array<int>' if n == 'ids' else 'long'}" for n in names))


def pack(
    docs: DataFrame,
    file: str,
    end_id: int,
    size: int = 2048,
    with_ids: bool = False,
    group_items: int = GROUP_ITEMS,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """One row per piece: what ``cut_documents`` gives, with sequence_id and offset there.

    with_ids: the pieces' ids too, as an array. A sequence's pieces have consecutive offsets from 0 on.
    """
    spark = docs.sparkSession
    # written once: the count and the packing read it, and row numbers then stay as they are
    pieces = materialise(
        cut_documents(docs, file, end_id, size, with_ids).withColumn("piece", F.monotonically_increasing_id()), "pieces"
    )
    items = pieces.filter(F.col("length") < size)
    count, tokens = items.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    groups = max(1, -(-count // group_items), -(-tokens // group_tokens))
    full = pieces.filter(F.col("length") == size).select(
        # even numbers for full sequences, odd ones for packed: piece numbers are unique already
        "*", (2 * F.col("piece")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )

    # Arrow, as pandas would turn ids beside a null into floating point
    def place(group: pa.Table) -> pa.Table:
        lengths, numbers = (group[c].to_numpy() for c in ("length", "piece"))
        group = group.take(np.lexsort((numbers, -lengths)))
        sequences, offsets = best_fit(group["length"].to_pylist(), size)
        number = group["group"][0].as_py()
        ids = 2 * (np.asarray(sequences, np.int64) * groups + number) + 1
        placed = group.drop_columns("group").append_column("sequence_id", pa.array(ids))
        return placed.append_column("offset", pa.array(np.asarray(offsets, np.int64)))

    group = F.pmod(F.xxhash64("piece"), F.lit(groups)).cast("int")
    # the ids stay out of the packing tasks
    given = ["piece", "length"] if with_ids else [c for c in pieces.columns if c != "ids"]
    schema = ", ".join(f"{c} long" for c in [*given, "sequence_id", "offset"])
    packed = items.select(*given, group.alias("group")).groupBy("group").applyInArrow(place, schema)
    if with_ids:
        packed = items.join(packed.drop("length"), "piece")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids, "sequence_id", "offset"]
    return full.select(columns).unionByName(packed.select(columns))
