"""Quality by voting rules, resampling towards a target, and the trie of conversations, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_rows import frame
from pyspark.sql import functions as F

from lakeloom.llm.prefix_trie import prefix_trie
from lakeloom.llm.resampling import Hasher, bracket, gains, resample
from lakeloom.llm.rows import numbered
from lakeloom.llm.weak_quality import BAD, GOOD, RULES, digits, estimate, judge, repeated

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# -- quality -------------------------------------------------------------------
def brute_base(text):
    words = WORD.findall(text or "")
    lines = (text or "").split("\n")
    times = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if times[tuple(words[i : i + 5])] > 1 for k in range(5)}
    again = sum(bool(WORD.search(x)) and x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(inside)


def test_base_counts_and_verdicts(docs, hard):
    rows = judge(docs).collect()
    want = Counter((i, *brute_base(t)) for i, t in hard)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == want
    for r in rows:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.quality >= 0.5) and 0 <= r.quality <= 1


def test_quality_of_nothing(none):
    assert judge(none).count() == 0


@pytest.mark.parametrize("numbers", [[], [1] * 5, [1] * 6, [1, 2, 3, 4, 5, 9, 1, 2, 3, 4, 5], list(range(50)), [1, 2] * 9 + [3] + [1, 2] * 3])
def test_repeated_windows(numbers):
    assert repeated(np.array(numbers, np.int64)) == brute_base(" ".join(map(str, numbers)))[4]


def test_accuracies_are_found_from_votes_alone():
    rng = np.random.default_rng(3)
    n, right = 40_000, np.array([0.95, 0.9, 0.85, 0.8, 0.75])
    truth = rng.random(n) < 0.7
    hit = rng.random((n, 5)) < right
    votes = np.where(hit == truth[:, None], GOOD, BAD)
    votes[rng.random((n, 5)) < 0.2] = 0
    patterns, times = np.unique(votes, axis=0, return_counts=True)
    opinion = estimate(patterns, times.astype(float))
    assert abs(opinion.share_good - 0.7) < 0.02
    for found in opinion.accuracy():
        assert np.abs(found - right).max() < 0.03
    assert ((opinion.quality(votes) >= 0.5) == truth).mean() > 0.95


def test_votes_are_numbers_in_base_three():
    codes = np.array([0, 1, 5, 3**8 - 1])
    assert (digits(codes, 8) @ 3 ** np.arange(8) == codes).all() and len(RULES) == 8


def test_labelled_junk_goes_and_clean_documents_stay(spark):
    """Labels are no input: they only tell how many verdicts are right."""
    source = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{source}/labels.parquet")
    rows = judge(spark.read.parquet(f"{source}/documents.parquet")).filter("NOT base_failed").drop("quality").join(labels, "doc_id").collect()
    clean, junk = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean(clean) >= 0.98 and np.mean(junk) <= 0.05


# -- resampling ------------------------------------------------------------------
FEATURE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_features(text):
    w = FEATURE_WORD.findall((text or "").translate(LOWER))
    return w, [zlib.crc32(" ".join(w[i : i + n]).encode()) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


@pytest.mark.parametrize("text", ["", "one", "one two", "a B c-d É", "x" * 41 + " y " + "z" * 300 + " y y", "ab " * 700_000])
def test_hashes_of_runs(text):
    _, want = brute_features(text)
    found = Counter()
    for _, runs in Hasher().text(text):
        for hashes in runs:
            found.update(hashes.tolist())
    assert found == Counter(want)


def brute_resample(rows, target, buckets, percent=5):
    source, wanted = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for _, t in rows:
        for f in brute_features(t)[1]:
            source[f % buckets] += 1
    for t in target:
        for f in brute_features(t)[1]:
            wanted[f % buckets] += 1
    s, t = int(source.sum()), int(wanted.sum())
    gain = [
        math.floor(1000 * math.log((float(b + 1) * float(s + buckets)) / (float(a + 1) * float(t + buckets))))
        for a, b in zip(source.tolist(), wanted.tolist(), strict=True)
    ]
    out = []
    for i, text in rows:
        words, features = brute_features(text)
        weight = sum(gain[f % buckets] for f in features)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words) >= 20))
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0]))
    drawn = [(*r[:4], k) for k, r in enumerate(able[: percent * len(able) // 100], 1)]
    return drawn, Counter(r[:4] for r in out)


@pytest.mark.parametrize("percent", [0, 40])
def test_resampling(spark, docs, hard, percent):
    target = ["the house of stone", None, "", "und der Fluss"]
    found = resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), percent).collect()
    drawn, every = brute_resample(hard, target, 10_000, percent)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in found) == every
    assert sorted((tuple(r) for r in found if r.rank is not None), key=lambda r: r[4]) == drawn


def test_resampling_of_nothing_and_towards_nothing(spark, docs, none):
    empty = spark.createDataFrame([], "text string")
    assert resample(none, empty).count() == 0
    assert resample(docs, empty).count() == docs.count()
    assert gains(np.zeros(4, np.int64), np.zeros(4, np.int64)).tolist() == [0] * 4


def test_bracket_holds_the_cutoff_on_ties_and_gaps(spark):
    for scores in ([5] * 300, [1] * 200 + [9] * 100, list(range(300)), [0] + [7] * 298 + [8]):
        df = spark.createDataFrame([(s,) for s in scores], "score long")
        for wanted in (15, 150):
            low, high, above = bracket(df, wanted, len(scores))
            assert above == sum(s > high for s in scores) < wanted <= sum(s >= low for s in scores)


def test_numbered_splits_a_group_over_tasks(spark):
    rows = spark.range(2_000).select(F.when(F.col("id") % 3 > 0, 1).alias("k"), (F.col("id") * 7 % 2_000).alias("v"), F.col("id").alias("__at"))
    out = numbered(rows, [F.asc("v")], "n", by=["k"]).collect()
    groups = defaultdict(list)
    for r in out:
        groups[r.k].append((r.n, r.v))
    assert set(groups) == {None, 1}
    for pairs in groups.values():
        assert [n for n, _ in sorted(pairs)] == list(range(len(pairs))) and [v for _, v in sorted(pairs)] == sorted(v for _, v in pairs)


# -- trie ------------------------------------------------------------------------
CONVERSATION = "conv_id long, turn long, role string, text string, place long, head string, ids int"


def turn_hash(role, text):
    return hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()[:16]


def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, turn_hash(role, text), (role or "", text or "")))
    own = {c: [x[3] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in sorted(built.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for key, ids in members.items():
        words = len(WORD.findall(key[-1][1])) if key else 0
        for d in range(len(key) + 1):
            leaves[key[:d]] += key not in kids
            saved[key[:d]] += (len(ids) - 1) * words
    out = Counter()
    for key, ids in members.items():
        ends = ",".join(str(c) for c in ids if len(built[c]) == len(key))
        parent = members[key[:-1]][0] if key else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out[(ids[0], len(key), parent, len(ids), kids[key], leaves[key], saved[key], digest)] += 1
    return out


def hard_conversations():
    """Common beginnings, copies, one conversation in another, gaps and nulls, a long one, ids without a base."""
    rng = random.Random(8)
    rows, turns = [], [("user", "hello there"), ("assistant", "yes of course"), (None, "again  and again"), ("user", None), ("user", "")]
    for c in range(120):
        if c in (20, 41):
            continue
        n = rng.choice([1, 1, 2, 3, 5, 9, 17])
        seq = [turns[k % 5] if rng.random() < 0.8 else rng.choice(turns) for k in range(n)]
        rows += [(c, None if rng.random() < 0.05 else 3 * k, *t) for k, t in enumerate(seq)]
    rows += [(c, k, *turns[k % 5]) for c in range(200, 230) for k in range(8)]  # copies
    rows += [(400, k, "user", f"turn {k // 2}") for k in range(60)]
    rows += [(405, k, "user", f"turn {k // 2}") for k in range(41)]
    rows += [(None, 1, "user", "of no conversation"), (3, 0, "user", "hello there"), (3, 0, "user", "hello there")]
    rng.shuffle(rows)
    return [(*r, 1, "h", 2) for r in rows]


@pytest.mark.parametrize("limit, block", [(2_000, 1_024), (5, 1_024), (10**6, 20), (3, 30)])
def test_trie(spark, hard, limit, block):
    rows = hard_conversations()
    found = prefix_trie(spark.createDataFrame(rows, CONVERSATION).repartition(3), limit=limit, block=block).collect()
    assert Counter(map(tuple, found)) == brute_trie(rows)


def test_trie_of_nothing_and_of_turnless_conversations(spark, hard):
    assert prefix_trie(spark.createDataFrame([], CONVERSATION)).count() == 0
    # ids whose first turns come from a conversation that isn't there
    alone = [(c, 0, "user", "x", 1, "h", 2) for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4]
    found = prefix_trie(spark.createDataFrame(alone, CONVERSATION)).collect()
    assert Counter(map(tuple, found)) == brute_trie(alone) and len(found) == 1


def test_ids_of_a_node_are_hashed_in_runs(spark, hard, monkeypatch):
    import lakeloom.llm.prefix_trie as trie

    monkeypatch.setattr(trie, "IDS", 7)
    rows = [(c, k, "user", str(k), 1, "h", 2) for c in range(0, 1_000, 20) for k in range(3)]
    found = prefix_trie(spark.createDataFrame(rows, CONVERSATION)).collect()
    assert Counter(map(tuple, found)) == brute_trie(rows)


def test_long_words_and_copies_share_no_rank(spark, hard):
    rows = [(i, "the house by the river " * 6) for i in range(40)] + [(None, "the house by the river " * 6)] * 3
    found = resample(frame(spark, rows), spark.createDataFrame([("river",)], "text string"), 50).collect()
    assert sorted(r.rank for r in found if r.rank) == list(range(1, 22))
