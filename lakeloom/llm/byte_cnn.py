"""Language of whole texts by a convolutional network over bytes.

Method: a text's UTF-8 bytes are cut into windows of a fixed length, the last
one padded with zero bytes. Each byte has a learned vector; filters of several
widths slide over the window, the largest response of each is kept, and a
softmax layer turns these into probabilities. A text's probabilities are the
mean over its windows, by length, so every byte counts. The network is trained
here, in numpy on the driver, by gradient descent (Adam) from labelled windows;
tasks get the weights (some thousands of numbers) and apply them to batches of
windows. As inputs are bytes, a filter's response is a sum of table entries, and
two bytes make one entry, so no multiplication is left at prediction.

The sample to learn from is bounded: about ``rows_per_language`` distinct texts of
each language, chosen by hash, and ``windows_per_document`` of their windows,
spread over the text. Everything else covers all rows and whole texts.

A null text, and one without a letter, is ``und`` with score 0; so is every text
if there is nothing to learn from. A null label is not learned. A null doc_id
counts as an empty one. Repeated rows each give a row; an empty table gives an
empty result; other columns are ignored. Long texts are predicted in slices.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.rows import batches

UNKNOWN = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
_MOST = max(WIDTHS) - 1  # bytes that a filter may look beyond a window
_ASCII_LETTER = re.compile("[A-Za-z]")


def held_out(doc_id: Column) -> Column:
    """A third of all documents, by doc_id, that is never learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def has_letter(text: str) -> bool:
    return _ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text))


def windows(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The windows of all texts, one a row, each with the bytes behind it that filters may need; texts' window counts."""
    counts = np.array([-(-len(d) // WINDOW) for d in data], np.int64)
    flat = np.frombuffer(b"".join(d.ljust(n * WINDOW, b"\0") for d, n in zip(data, counts.tolist(), strict=True)), np.uint8)
    return np.pad(flat.reshape(-1, WINDOW), ((0, 0), (0, _MOST))), counts


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Network:
    """The weights: a vector for each byte, filters by width, and the last layer."""

    labels: list[str]
    vectors: np.ndarray
    filters: dict[int, np.ndarray]  # width: (width, vector, filter)
    biases: dict[int, np.ndarray]
    last: np.ndarray
    last_bias: np.ndarray
    _tables: dict = field(default_factory=dict, repr=False)

    @classmethod
    def new(cls, labels: list[str], size: int = 8, count: int = 8, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, by: (rng.standard_normal(shape) * by).astype(np.float32)
        return cls(
            labels,
            draw(256, size, by=0.5),
            {w: draw(w, size, count, by=(2 / (w * size)) ** 0.5) for w in WIDTHS},
            {w: np.zeros(count, np.float32) for w in WIDTHS},
            draw(len(WIDTHS) * count, len(labels), by=0.2),
            np.zeros(len(labels), np.float32),
        )

    @cached_property
    def tables(self) -> dict[int, list[list[np.ndarray]]]:
        """By width and filter: responses to each pair of bytes, then to the byte left over, as one table for each."""
        out = {}
        for w, f in self.filters.items():
            by_byte = np.einsum("be,wef->wfb", self.vectors, f).astype(np.float32)
            out[w] = [
                [
                    (by_byte[at, k][:, None] + by_byte[at + 1, k][None, :]).ravel() if at + 1 < w else by_byte[at, k].copy()
                    for at in range(0, w, 2)
                ]
                for k in range(f.shape[2])
            ]
        return out

    def features(self, rows: np.ndarray) -> np.ndarray:
        one = rows.astype(np.intp)
        pair = (one[:, :-1] << 8) | one[:, 1:]
        out = []
        for w, filters in self.tables.items():
            starts = [(pair if at + 1 < w else one)[:, at : at + WINDOW] for at in range(0, w, 2)]
            for k, parts in enumerate(filters):
                response = parts[0].take(starts[0])
                for table, start in zip(parts[1:], starts[1:], strict=True):
                    response += table.take(start)
                out.append(response.max(axis=1) + self.biases[w][k])
        return np.maximum(np.stack(out, axis=1), 0)

    def probabilities(self, rows: np.ndarray, slice_: int = 512) -> np.ndarray:
        parts = [softmax(self.features(rows[i : i + slice_]) @ self.last + self.last_bias) for i in range(0, len(rows), slice_)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.labels)), np.float32)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        known = [i for i, t in enumerate(texts) if self.labels and t is not None and has_letter(t)]
        data = [texts[i].encode() for i in known]
        rows, counts = windows(data)
        found = self.probabilities(rows).astype(np.float64)
        at = 0
        for i, d, n in zip(known, data, counts.tolist(), strict=True):
            share = np.full(n, float(WINDOW))
            share[-1] = len(d) - (n - 1) * WINDOW
            mean = share @ found[at : at + n] / len(d)
            best = int(mean.argmax())
            out[i], at = (self.labels[best], min(1.0, float(mean[best]))), at + n
        return out


def train(rows: np.ndarray, labels: list[str], steps: int = 500, batch: int = 96, rate: float = 0.01, seed: int = 7) -> Network:
    """rows: windows as ``windows`` makes them; labels: theirs. Languages weigh alike, however many windows they have."""
    names = sorted(set(labels))
    net = Network.new(names)
    if len(names) < 2:
        return net
    rng = np.random.default_rng(seed)
    number = np.array([names.index(x) for x in labels])
    of = [np.flatnonzero(number == i) for i in range(len(names))]
    params = [net.vectors, net.last, net.last_bias, *net.filters.values(), *net.biases.values()]
    means, squares = ([np.zeros_like(p) for p in params] for _ in range(2))
    count = net.filters[WIDTHS[0]].shape[2]
    for step in range(1, steps + 1):
        picked = np.array([rng.choice(of[c]) for c in rng.integers(len(names), size=batch)])
        x, y = rows[picked], number[picked]
        embedded = net.vectors[x]
        found, where = [], []
        for w in WIDTHS:
            seen = np.concatenate([embedded[:, k : k + WINDOW] for k in range(w)], axis=2)
            response = seen @ net.filters[w].reshape(-1, count) + net.biases[w]
            at = response.argmax(axis=1)
            where.append(at)
            found.append(np.take_along_axis(response, at[:, None, :], axis=1)[:, 0])
        pooled = np.concatenate(found, axis=1)
        active = np.maximum(pooled, 0)
        delta = softmax(active @ net.last + net.last_bias)
        delta[np.arange(batch), y] -= 1
        delta /= batch
        back = (delta @ net.last.T) * (pooled > 0)
        d_vectors, d_filters, d_biases = np.zeros_like(net.vectors), [], []
        each = np.arange(batch)[:, None]
        for i, w in enumerate(WIDTHS):
            grad = back[:, i * count : (i + 1) * count]
            d_filter = np.empty_like(net.filters[w])
            for k in range(w):
                byte = x[each, where[i] + k]  # (batch, filter)
                d_filter[k] = np.einsum("bfe,bf->ef", net.vectors[byte], grad)
                np.add.at(d_vectors, byte, grad[:, :, None] * net.filters[w][k].T[None])
            d_filters.append(d_filter)
            d_biases.append(grad.sum(axis=0))
        grads = [d_vectors, active.T @ delta, delta.sum(axis=0), *d_filters, *d_biases]
        pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, m, s in zip(params, grads, means, squares, strict=True):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= (pace * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def draw(labelled: DataFrame, rows_per_language: int) -> tuple[DataFrame, int]:
    """About so many distinct texts of each language (lang, text), by the hash of the text; how many languages there are."""
    hashed = labelled.select("lang", "text", F.xxhash64("text", F.lit(11)).alias("hash"))
    # copies of a text are drawn together and count once, in the share as in the sample
    counts = hashed.select("lang", "hash").distinct().groupBy("lang").count().collect()  # a row for each language
    shares = labelled.sparkSession.createDataFrame(
        [(r["lang"], rows_per_language / r["count"]) for r in counts], "lang string, share double"
    )
    drawn = (F.pmod(F.col("hash"), F.lit(1 << 30)) / (1 << 30)) < F.col("share")
    sample = hashed.join(F.broadcast(shares), "lang").filter(drawn).select("lang", "text").dropDuplicates()
    return sample, len(counts)


def learn(docs: DataFrame, rows_per_language: int = 600, windows_per_document: int = 6) -> Network:
    """A network from the labelled documents that aren't held out."""
    labelled = docs.select(
        F.col("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sample, languages = draw(labelled, rows_per_language)

    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(frames):
            out = []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if has_letter(text):
                    data = text.encode()
                    n = -(-len(data) // WINDOW)
                    for i in sorted({k * n // windows_per_document for k in range(windows_per_document)}):
                        out.append((lang, data[i * WINDOW : (i + 1) * WINDOW]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.binary())], ["lang", "bytes"]
            )

    most = 2 * rows_per_language * windows_per_document * max(1, languages)
    taken = sample.mapInArrow(cut, "lang string, bytes binary").orderBy(F.xxhash64("bytes"), "lang", "bytes").limit(most).collect()
    rows, _ = windows([bytes(r["bytes"]) for r in taken])
    return train(rows, [r["lang"] for r in taken])


def predictions(docs: DataFrame, network: Network) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document. Only the text is an input of the prediction."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(frames, 200):
            found = network.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array([x for x, _ in found], pa.string()),
                    pa.array([x for _, x in found], pa.float64()),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def called(text: Column, network: Network) -> Column:
    """The predicted language of a text."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        found = [network.predict([t if isinstance(t, str) else None for t in texts[i : i + 200]]) for i in range(0, len(texts), 200)]
        return pd.Series([x for part in found for x, _ in part], dtype=object)

    # else a filter by the answer would ask the network a second time, in a second worker
    return run.asNondeterministic()(text.cast("string"))


def classify(docs: DataFrame, network: Network, out: str) -> DataFrame:
    """``docs`` with all their columns and the predicted language as one more."""
    return docs.withColumn(out, called(F.col("text"), network))


def lettered(text: Column) -> Column:
    """Whether a text has a letter; a null one has none."""

    @F.pandas_udf("boolean")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([isinstance(t, str) and has_letter(t) for t in texts], dtype=bool)

    return run.asNondeterministic()(text.cast("string"))
