"""Documents drawn so that their words follow a target corpus: importance resampling over hashed word runs.

Features are all runs of one to three consecutive words; a feature's bucket is the CRC-32 of its
bytes modulo ``buckets``. The gain of a bucket is the logarithm of how much likelier it is in the
target than in the corpus; a document's weight is the sum of gains over its features, and with
Gumbel noise from its doc_id the highest scores are a sample without replacement.

Method: the gains are one array that tasks index with the buckets of a batch (the bucket of a run
follows from those of its words, as CRC-32 is linear, without joining strings). The cutoff is
bracketed by a quantile sketch of the scores; exact counts above and inside the bracket prove that
it holds the cutoff, or widen it; only the scores inside are sorted to find it.

A null or empty text has no words and no features, weight 0, and is not drawn (too few words).
A null doc_id gets the noise of an empty one and comes after all others of its score; rows that tie
in all of that come in the order in which they were written. Repeated rows take part each for
itself. Long texts are read in blocks. An empty table gives an empty result, an empty target equal
gains for unseen buckets; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.rows import batches, documents, materialise, numbered, word_blocks

BUCKETS = 10_000
SCALE = 1000
#: Lower-cases A-Z and makes a space of every other ASCII character that is no digit or letter.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Longer words are hashed anew in each run they are part of.
_LONGEST = 40
#: Words a task remembers the hashes of, about.
_KNOWN = 1 << 18


@lru_cache(maxsize=1)
def _shifts() -> np.ndarray:
    """(bytes appended, byte of the CRC, its value): what the CRC becomes when so many zero bytes follow.

    The CRC of a joined string is that of its head, shifted by the tail's length, and that of the tail: linear over bits.
    """
    one = np.array([zlib.crc32(bytes([v])) ^ zlib.crc32(b"\0") for v in range(256)], np.uint32)
    values = np.arange(256, dtype=np.uint32)
    table = np.zeros((_LONGEST + 2, 4, 256), np.uint32)
    for byte in range(4):
        table[0, byte] = values << np.uint32(8 * byte)
    for n in range(1, _LONGEST + 2):
        before = table[n - 1]
        table[n] = (before >> np.uint32(8)) ^ one[before & np.uint32(255)]
    return table


def _joined(head: np.ndarray, tail: np.ndarray, length: np.ndarray) -> np.ndarray:
    t = _shifts()
    out = tail.copy()
    for byte in range(4):
        out ^= t[length, byte, (head >> np.uint32(8 * byte)) & np.uint32(255)]
    return out


class Hasher:
    """The CRC-32 of all runs of one to three words of texts. Remembers words up to a bound."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}
        self.crc, self.spaced, self.length = np.zeros(1024, np.uint32), np.zeros(1024, np.uint32), np.zeros(1024, np.int64)

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        """The numbers of words among those remembered: of each its CRC, its CRC after a space, and how long that is (0: long)."""
        if len(self.number) > _KNOWN:
            self.number.clear()
        new = [w for w in set(words) if w not in self.number]
        start = len(self.number)
        if start + len(new) > len(self.crc):
            size = 2 * (start + len(new))
            self.crc, self.spaced, self.length = (np.resize(x, size) for x in (self.crc, self.spaced, self.length))
        for i, word in enumerate(new, start):
            self.number[word] = i
            self.crc[i], self.spaced[i] = zlib.crc32(word), zlib.crc32(b" " + word)
            self.length[i] = 0 if len(word) > _LONGEST else len(word) + 1
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def runs(self, words: list[bytes], fresh: int = 0) -> Iterator[np.ndarray]:
        """Hashes of the runs of words that end at place ``fresh`` or later."""
        at = self._numbers(words)
        run, spaced, length = self.crc[at], self.spaced[at], self.length[at]
        yield run[fresh:]
        for more in (1, 2):
            run = _joined(run[:-1], spaced[more:], length[more:])
            for i in np.flatnonzero(length[more:] == 0).tolist():
                run[i] = zlib.crc32(b" ".join(words[i : i + more + 1]))
            yield run[max(0, fresh - more) :]

    def text(self, text: str) -> Iterator[tuple[int, Iterator[np.ndarray]]]:
        """The number of words and the hashes of the runs of each block of a text."""
        last: list[bytes] = []
        for block in word_blocks(text.encode().translate(_WORDS)):
            words = block.split()
            if words:
                yield len(words), self.runs([*last, *words], len(last))
                last = [*last, *words][-2:]


def feature_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket: ``buckets`` numbers are all the driver gets."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, hasher = np.zeros(buckets, np.int64), Hasher()
        for batch in frames:
            for text in batch.column("text").to_pylist():
                for _, runs in hasher.text(text):
                    for hashes in runs:
                        counts += np.bincount(hashes % np.uint32(buckets), minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(counts[held])], ["bucket", "n"])

    rows = texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect()
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows:
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket, in thousandths, from how many features of the corpus and of the target it holds."""
    k, all_source, all_target = len(source), int(source.sum()), int(target.sum())
    ratios = (
        (float(t + 1) * float(all_source + k)) / (float(s + 1) * float(all_target + k))
        for s, t in zip(source.tolist(), target.tolist(), strict=True)
    )
    return np.array([math.floor(SCALE * math.log(r)) for r in ratios], np.int64)


def _noise(seed: int) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / 4294967296.0)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int = 42) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every document."""
    buckets = len(gain)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches(frames):
            out = []
            for text in batch.column("text").to_pylist():
                n_words = n = weight = 0
                for words, runs in hasher.text(text):
                    n_words += words
                    for hashes in runs:
                        n += len(hashes)
                        weight += int(gain[hashes % np.uint32(buckets)].sum())
                out.append((n_words, n, weight))
            columns = [pa.array([r[i] for r in out], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_words", "n_features", "weight"])

    weighed = docs.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")
    return weighed.withColumn("score", (F.col("weight") + _noise(seed)).cast("long"))


def bracket(scores: DataFrame, wanted: int, total: int, error: float = 0.005) -> tuple[int, int, int]:
    """Scores (low, high) with fewer than ``wanted`` rows above high and at least so many from low on; the rows above high.

    The sketch may be off by any amount: exact counts decide, and a bracket that doesn't hold the cutoff is widened.
    """
    score, place = F.col("score"), 1 - wanted / total
    while error < 0.2:
        ends = [max(0.0, place - 2 * error), min(1.0, place + 2 * error)]
        sketch = scores.select(score.cast("double").alias("score")).stat.approxQuantile("score", ends, error)
        low, high = (int(x) for x in sketch)
        above, held = scores.agg(F.count_if(score > high), F.count_if(score >= low)).first()
        if above < wanted <= held:
            return low, high, above
        error *= 4
    low, high = scores.agg(F.min(score), F.max(score)).first()
    return low, high, 0


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, buckets: int = BUCKETS
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; rank is null for those not drawn.

    target: a table with a column ``text``.
    percent: of the documents with at least ``least_words`` words, so many of a hundred are drawn.
    """
    texts = documents(docs)
    wanted_texts = target.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    gain = gains(feature_counts(texts, buckets), feature_counts(wanted_texts, buckets))
    rows = materialise(scored(texts, gain, seed).withColumn("row", F.monotonically_increasing_id()), "scores")
    fit = F.col("n_words") >= least_words
    able = rows.filter(fit)
    total = able.count()
    wanted = percent * total // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    if not wanted:
        return rows.select(*columns, F.lit(None).cast("long").alias("rank"))
    low, high, above = bracket(able.select("score"), wanted, total)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    inside = able.filter(F.col("score").between(low, high)).select("doc_id", "score", "row")
    last = numbered(inside, order, "place", purpose="bracket").filter(F.col("place") == wanted - above - 1).first()
    tie = F.col("doc_id").eqNullSafe(F.lit(last.doc_id).cast("long")) & (F.col("row") <= last.row)
    before = F.col("doc_id").isNotNull() if last.doc_id is None else F.coalesce(F.col("doc_id") < last.doc_id, F.lit(False))
    taken = fit & ((F.col("score") > last.score) | ((F.col("score") == last.score) & (before | tie)))
    ranked = numbered(rows.filter(taken), order, "rank", purpose="drawn").select(*columns, (F.col("rank") + 1).alias("rank"))
    return ranked.unionByName(rows.filter(~taken).select(*columns, F.lit(None).cast("long").alias("rank")))
