"""Lines that many documents share, dropped from all of them.

A text is split at ``\\n``; a line's key is the line without white space
(``[\\x20\\x09-\\x0D]``) at both ends and with A-Z in lower case. Keys of at least
``min_chars`` code points that at least ``min_docs`` documents hold lose all their
lines. The others stay as they are, joined by ``\\n``.

Method: the 128-bit hashes of the distinct lines are counted, then dealt by
their first bits into shards of a bounded number. A shard is a minimal perfect
hash over its lines with two compact arrays beside it, a 64-bit fingerprint and
a count for each: some 13 bytes a line, whatever its length. Documents probe
the arrays: their line hashes go to the shards, the hashes of lines to drop
come back. Lines themselves are never joined. Lines of one document only are left
out of the arrays; a probe finds that its fingerprint isn't there.

A shard that holds the lines of very many documents is copied in proportion,
and its probes are dealt over the copies, so one line in every document does not
make one task long, and no worker is given more than about ``shard_probes`` at
once, however few lines all documents are made of. A null or empty text is one empty line, which is never
dropped by ``min_chars`` of 1 or more. Repeated rows count as documents of their
own. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.rows import batches, documents, materialise, tasks
from lakeloom.operators.spread import spread_join

_ENDS = b" \t\n\x0b\x0c\r"
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Lines of a shard, about: the bound on what a task builds or holds of the index.
SHARD_LINES = 250_000
#: Probes that one copy of a shard answers at once, about; more of them make more copies.
SHARD_PROBES = 1_000_000


def line_key(line: bytes, min_chars: int = 1) -> int | None:
    """The key's 128-bit hash; None for a key of too few code points."""
    key = line.strip(_ENDS).translate(_LOWER)
    if len(key) < min_chars or (min_chars > 1 and len(key.decode()) < min_chars):
        return None
    return xxhash.xxh3_128_intdigest(key)


def _halves(keys: list[int]) -> tuple[pa.Array, pa.Array]:
    both = np.frombuffer(b"".join(k.to_bytes(16, "big") for k in keys), ">i8").astype("<i8").reshape(-1, 2)
    return pa.array(both[:, 0]), pa.array(both[:, 1])


class PerfectHash:
    """A minimal perfect hash in levels: each marks the places that one key alone falls on, the rest goes to the next.

    A key's number is the rank of its place among all marks. Keys outside the set get some number or -1.
    """

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        self.marks = np.unpackbits(bits, count=int(sizes.sum()), bitorder="little")
        self.sizes, self.rank = sizes, np.cumsum(self.marks, dtype=np.int64) - 1

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        x = (keys ^ np.uint64(_MIX[1] * (level + 1) & (1 << 64) - 1)) * np.uint64(_MIX[0])
        x = (x ^ (x >> np.uint64(29))) * np.uint64(_MIX[1])
        return ((x >> np.uint64(32)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """keys: distinct unsigned 64-bit integers."""
        parts, sizes = [], []
        while len(keys):
            size = 2 * len(keys) + 1
            place = cls._place(keys, len(sizes), size)
            alone = np.bincount(place, minlength=size) == 1
            parts.append(alone)
            sizes.append(size)
            keys = keys[~alone[place]]
        marks = np.concatenate(parts) if parts else np.zeros(0, bool)
        return cls(np.packbits(marks, bitorder="little"), np.asarray(sizes, np.int64))

    def bits(self) -> bytes:
        return np.packbits(self.marks, bitorder="little").tobytes()

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        found, base = np.full(len(keys), -1, np.int64), 0
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            at = base + self._place(keys[left], level, size)
            hit = self.marks[at] == 1
            found[left[hit]] = self.rank[at[hit]]
            left, base = left[~hit], base + size
        return found


def _unsigned(column: pd.Series) -> np.ndarray:
    return column.to_numpy(np.int64).view(np.uint64)


def build_shard(lines: pd.DataFrame) -> pd.DataFrame:
    """A shard's row: marks and level sizes of its perfect hash, then fingerprints and counts by its numbers."""
    keys = _unsigned(lines["h1"])
    # lines that share the first half keep one place each: the second of such a pair is held as it is
    first = ~lines["h1"].duplicated().to_numpy()
    index = PerfectHash.build(keys[first])
    at = index(keys[first])
    prints, counts = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    prints[at] = lines["h2"].to_numpy(np.int64)[first]
    counts[at] = lines["n"].to_numpy(np.int64)[first]
    rest = lines[~first]
    return pd.DataFrame(
        {
            "shard": [int(lines["shard"].iloc[0])],
            "marks": [index.bits()],
            "sizes": [index.sizes.tobytes()],
            "prints": [prints.tobytes()],
            "counts": [counts.astype("<u4" if counts.max(initial=0) < 1 << 32 else "<i8").tobytes()],
            "beside": [rest[["h1", "h2", "n"]].to_numpy(np.int64).tobytes()],
        }
    )


def probe(shard: pd.Series, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """The counts of lines by their hashes; 0 for those the shard doesn't hold."""
    index = PerfectHash(np.frombuffer(shard["marks"], np.uint8), np.frombuffer(shard["sizes"], np.int64))
    prints = np.frombuffer(shard["prints"], np.int64)
    wide = len(shard["counts"]) == 8 * len(prints)
    counts = np.frombuffer(shard["counts"], "<i8" if wide else "<u4").astype(np.int64)
    if not len(prints):
        return np.zeros(len(h1), np.int64)
    at = index(h1.view(np.uint64))
    found = np.where((at >= 0) & (prints[at] == h2), counts[at], 0)
    for one, two, n in np.frombuffer(shard["beside"], np.int64).reshape(-1, 3).tolist():
        found[(h1 == one) & (h2 == two)] = n
    return found


_SHARD = "shard int, marks binary, sizes binary, prints binary, counts binary, beside binary"


def copies_of(probes: DataFrame, shards: int, most: int) -> dict[int, int]:
    """shard -> into how many copies it goes, so that none has more probes than ``most``, or twice those of a shard on average.

    probes: shard and n. Only shards with several copies are listed, of which there are fewer than shards.
    """
    mean = (probes.agg(F.sum("n")).first()[0] or 0) / shards
    bound = max(1, min(most, int(2 * mean)))
    return {r.shard: -(-r.n // bound) for r in probes.filter(F.col("n") > bound).collect()}


def asked_lines(texts: DataFrame, shards: int, copies: dict[int, int], min_chars: int) -> DataFrame:
    """The distinct lines of each text (key, text) as probes: shard, copy, key and hash. Equal rows ask once a batch."""

    def ask(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(frames):
            keys, of = [], []
            for key, text in dict.fromkeys(zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True)):
                held = {line_key(x, min_chars) for x in text.encode().split(b"\n")} - {None}
                keys += held
                of += [key] * len(held)
            h1, h2 = _halves(keys)
            number = (h1.to_numpy() >> 20) % shards
            n = np.array([copies.get(s, 1) for s in number.tolist()], np.int64)
            key = np.array(of, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number.astype(np.int32)), pa.array((key % n).astype(np.int32)), pa.array(key), h1, h2],
                ["shard", "copy", "key", "h1", "h2"],
            )

    return texts.select("key", "text").mapInArrow(ask, "shard int, copy int, key long, h1 long, h2 long")


def drop_common_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, shard_lines: int = SHARD_LINES, shard_probes: int = SHARD_PROBES
) -> DataFrame:
    """doc_id, n_lines (before dropping), n_dropped and the kept text of every document.

    shard_probes: about how many probes meet one copy of a shard in one worker, however many documents share a line.
    """
    # drops hold for all documents alike, so that two documents of one key share a list does no harm
    texts = documents(docs).withColumn("key", F.xxhash64("doc_id", "text"))

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            n: dict[int, int] = {}
            for text in batch.column("text").to_pylist():
                for k in {line_key(x, min_chars) for x in text.encode().split(b"\n")}:
                    n[k] = n.get(k, 0) + 1
            n.pop(None, None)
            yield pa.RecordBatch.from_arrays([*_halves(list(n)), pa.array(n.values(), pa.int64())], ["h1", "h2", "n"])

    lines = texts.select("text").mapInArrow(count, "h1 long, h2 long, n long").groupBy("h1", "h2").agg(F.sum("n").alias("n"))
    lines = materialise(lines, "lines")
    shards = max(4 * tasks(docs), -(-lines.count() // shard_lines))
    shard = F.pmod(F.shiftright("h1", 20), F.lit(shards)).cast("int")
    probes = lines.groupBy(shard.alias("shard")).agg(F.sum("n").alias("n"))
    copies = copies_of(probes, shards, shard_probes)
    index = lines.filter(F.col("n") >= min(2, min_docs)).withColumn("shard", shard).groupBy("shard").applyInPandas(build_shard, _SHARD)
    index = materialise(index, "line-index")

    def answer(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or held.empty:
            return asked[["key", "h1", "h2"]].head(0)
        n = probe(held.iloc[0], asked["h1"].to_numpy(np.int64), asked["h2"].to_numpy(np.int64))
        return asked.loc[n >= min_docs, ["key", "h1", "h2"]]

    asked = asked_lines(texts, shards, copies, min_chars)
    times = docs.sparkSession.createDataFrame(list(copies.items()), "shard int, times int")
    copied = index.join(times, "shard", "left").withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.coalesce("times", F.lit(1)) - 1))
    )
    drops = (
        asked.groupBy("shard", "copy")
        .cogroup(copied.drop("times").groupBy("shard", "copy"))
        .applyInPandas(answer, "key long, h1 long, h2 long")
        .distinct()
        .groupBy("key")
        .agg(F.collect_list("h1").alias("h1"), F.collect_list("h2").alias("h2"))
    )

    def drop(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(frames):
            sizes, gone, kept = [], [], []
            columns = (batch.column(c).to_pylist() for c in ("text", "h1", "h2"))
            for text, h1, h2 in zip(*columns, strict=True):
                lines = text.encode().split(b"\n")
                away = {(a % 2**64) << 64 | b % 2**64 for a, b in zip(h1 or (), h2 or (), strict=True)}
                stay = [x for x in lines if line_key(x, min_chars) not in away] if away else lines
                sizes.append(len(lines))
                gone.append(len(lines) - len(stay))
                kept.append(text if len(stay) == len(lines) else b"\n".join(stay).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_lines", "n_dropped", "text"],
            )

    return spread_join(texts, drops, ["key"], "left", by=["key"]).mapInArrow(drop, "doc_id long, n_lines long, n_dropped long, text string")
