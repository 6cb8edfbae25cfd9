"""Documents kept or dropped by rules that vote, weighed by what they agree on.

Method (weak supervision): each rule looks at one signal of a text and votes that
it is good or bad, or abstains between its two bounds. Rules err, so no rule drops a
document alone: a document is good or bad, unseen, and each rule votes for, votes
against or abstains with probabilities of its own on good documents and on bad ones.
Expectation-maximisation estimates them, and so how accurate each rule is, and the
share of good documents from the votes alone, without labels. The quality of a document is its posterior probability
of being good; it is kept from ``least`` on.

A document's votes are one number, so all documents shrink to counts of at most
3 ** rules vote patterns (6561 for the rules here): only those counts reach the
driver, and its estimate is the same for any order or number of tasks.

A base filter comes first: fewer than ``least_words`` words, or more than ``most_repeats``
per cent of the words inside repeated windows. Null and empty texts have no words and
fail it. Texts are read whole; of a long one only the numbers of its words are held.
Repeated rows are judged alike, each for itself. An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.rows import batches, materialise, word_blocks
from lakeloom.llm.spotsigs import ANCHORS

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
_BLANKS_TO_SPACE = bytes.maketrans(BLANKS.encode(), b" " * len(BLANKS))
WINDOW = 5
ABSTAINS, GOOD, BAD = range(3)

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_common", "n_capital", "n_ends")


@dataclass(frozen=True)
class Rule:
    """Votes on the ratio of two counts: good within ``good``, bad outside ``fair``, else an abstention.

    It also abstains on documents with fewer than ``words`` words.
    """

    name: str
    count: str
    per: str
    good: tuple[float, float]
    fair: tuple[float, float]
    words: int = 1

    def votes(self, counts: Mapping[str, np.ndarray]) -> np.ndarray:
        """GOOD, BAD or ABSTAINS for each document."""
        value = counts[self.count] / np.maximum(counts[self.per], 1)
        good = (value >= self.good[0]) & (value <= self.good[1])
        fair = (value >= self.fair[0]) & (value <= self.fair[1])
        return np.where(counts["n_words"] < self.words, ABSTAINS, np.where(good, GOOD, np.where(fair, ABSTAINS, BAD)))


ANY = float("inf")
RULES = (
    Rule("long enough", "n_words", "one", (40, ANY), (10, ANY)),
    Rule("word length", "word_chars", "n_words", (3, 10), (2, 14)),
    Rule("symbols", "n_symbols", "n_words", (0, 0.02), (0, 0.10)),
    Rule("repeats", "n_repeat_words", "n_words", (0, 0.08), (0, 0.15)),
    Rule("repeated lines", "n_dup_lines", "n_lines", (0, 0.15), (0, 0.40)),
    Rule("common words", "n_common", "n_words", (0.05, 0.60), (0.01, 0.80), words=10),
    Rule("capitals", "n_capital", "n_words", (0, 0.10), (0, 0.30)),
    Rule("sentences", "n_ends", "n_words", (0.01, 0.40), (0.003, 0.60), words=10),
)


def repeated(numbers: np.ndarray, window: int = WINDOW) -> int:
    """Words in windows that occur twice or more, their first occurrence included. Exact: no hashes."""
    if len(numbers) <= window:
        return 0
    rank = numbers
    for k in range(1, window):
        following = numbers[k:]
        pairs = rank[:-1] * (int(numbers.max()) + 1) + following
        _, rank, times = np.unique(pairs, return_inverse=True, return_counts=True)
        if len(times) == len(rank):
            return 0
    covered = np.zeros(len(numbers) + 1, np.int64)
    starts = np.flatnonzero(times[rank] > 1)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered) > 0).sum())


def signals(text: str, common: frozenset[bytes], window: int = WINDOW) -> tuple[int, ...]:
    """The counts BASE and MORE of a text."""
    numbers: dict[bytes, int] = {}
    parts, capital, found, ends = [], 0, 0, 0
    for block in word_blocks(text.encode().translate(_BLANKS_TO_SPACE)):
        words = block.split()
        parts.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)))
        capital += sum(map(bytes.isupper, words))
        found += sum(map(common.__contains__, block.lower().split()))
        ends += sum(w.endswith((b".", b"!", b"?")) for w in words)
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    n = sum(map(len, parts))
    chars = len(text) - sum(map(text.count, BLANKS))
    repeats = repeated(np.concatenate(parts), window) if parts else 0
    return n, chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeats, len(lines), found, capital, ends


def vote_table(docs: DataFrame, rules: tuple[Rule, ...] = RULES, common: frozenset[str] = ANCHORS) -> DataFrame:
    """doc_id, the counts of each document, and its votes as a number in base 3, the first rule's the lowest digit."""
    known = frozenset(w.encode() for w in common)
    names = [*BASE, *MORE]

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(frames):
            rows = [signals(t or "", known) for t in batch.column("text").to_pylist()]
            table = np.array(rows, np.int64).reshape(-1, len(names))
            counts = {name: table[:, i] for i, name in enumerate(names)} | {"one": np.ones(len(table))}
            votes = sum(rule.votes(counts) * 3**i for i, rule in enumerate(rules)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(table[:, i]) for i in range(len(names))), pa.array(votes)], ["doc_id", *names, "votes"]
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, ", ".join(f"{c} long" for c in ("doc_id", *names, "votes")))


@dataclass(frozen=True)
class Opinion:
    """What the votes say: the share of good documents, and how each rule votes on good and on bad ones (rule, vote)."""

    share_good: float
    on_good: np.ndarray
    on_bad: np.ndarray

    def quality(self, patterns: np.ndarray) -> np.ndarray:
        """The posterior probability of good for each row of votes (0, 1 or 2 a rule)."""
        each = np.arange(patterns.shape[1])
        odds = np.log(self.share_good) - np.log1p(-self.share_good)
        odds = odds + (np.log(self.on_good) - np.log(self.on_bad))[each, patterns].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))

    def accuracy(self) -> tuple[np.ndarray, np.ndarray]:
        """How often each rule is right when it votes: on good documents, and on bad ones."""
        return tuple(of[:, right] / (of[:, GOOD] + of[:, BAD]) for of, right in ((self.on_good, GOOD), (self.on_bad, BAD)))


def digits(codes: np.ndarray, rules: int) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(rules) % 3


def estimate(patterns: np.ndarray, times: np.ndarray, rounds: int = 200) -> Opinion:
    """Expectation-maximisation over vote patterns and how often each occurs.

    It starts from documents against which no rule votes as the good ones. A rule may not be worse than chance: it
    votes bad on bad documents at least as often as on good ones, and good the other way round, which keeps the two
    from changing places.
    """
    rules = patterns.shape[1]
    votes = np.stack([patterns == v for v in (ABSTAINS, GOOD, BAD)], axis=2).astype(float)
    is_good = np.where((patterns == BAD).any(axis=1), 0.1, 0.95)
    opinion = Opinion(0.5, np.full((rules, 3), 1 / 3), np.full((rules, 3), 1 / 3))
    for _ in range(rounds):
        good, bad = is_good * times, (1 - is_good) * times
        # one more vote of each kind than was cast: nothing is impossible
        on = [np.einsum("p,prv->rv", w, votes) + 1 for w in (good, bad)]
        on_good, on_bad = (x / x.sum(axis=1, keepdims=True) for x in on)
        both = (on[0] + on[1]) / (on[0] + on[1]).sum(axis=1, keepdims=True)
        chance = (on_bad[:, BAD] < on_good[:, BAD]) | (on_good[:, GOOD] < on_bad[:, GOOD])
        on_good, on_bad = (np.where(chance[:, None], both, x) for x in (on_good, on_bad))
        share = float((good.sum() + 1) / (times.sum() + 2))
        moved = max(abs(share - opinion.share_good), np.abs(on_good - opinion.on_good).max(initial=0), np.abs(on_bad - opinion.on_bad).max(initial=0))
        opinion = Opinion(share, on_good, on_bad)
        is_good = opinion.quality(patterns)
        if moved < 1e-9:
            break
    return opinion


def judge(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    least: float = 0.5,
    least_words: int = 10,
    most_repeats: int = 20,
) -> DataFrame:
    """doc_id, the BASE counts, base_failed, kept, quality (the posterior) and votes of every document."""
    voted = materialise(vote_table(docs, rules), "votes")
    counted = voted.groupBy("votes").count().orderBy("votes").collect()  # at most 3 ** rules rows
    codes, times = (np.array([r[i] for r in counted], np.int64) for i in range(2))
    patterns = digits(codes, len(rules))
    quality = estimate(patterns, times.astype(float)).quality(patterns)
    of = docs.sparkSession.createDataFrame(list(zip(codes.tolist(), quality.tolist(), strict=True)), "votes long, quality double")
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeats * F.col("n_words"))
    return voted.join(of, "votes").select(
        "doc_id", *BASE, failed.alias("base_failed"), (~failed & (F.col("quality") >= least)).alias("kept"), "quality", "votes"
    )
