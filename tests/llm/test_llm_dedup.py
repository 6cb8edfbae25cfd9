"""Exact, line and near deduplication against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
import xxhash
from llm_rows import frame
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeloom.llm import chunk_dedup, line_dedup, simhash
from lakeloom.llm.components import components
from lakeloom.operators import key_filter

BLANK = re.compile("[\x20\x09-\x0d]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def order(i):
    return (i is None, i or 0)


@pytest.mark.parametrize("bits", [64, 5])
def test_exact_duplicates(docs, hard, bits):
    """bits=5: nearly all different chunks share a hash and must be told apart."""
    got = chunk_dedup.exact_duplicates(docs, id_bits=bits).collect()
    of = {}
    for i, t in hard:
        of.setdefault(BLANK.sub(" ", t or ""), []).append(i)
    want = Counter((i, min(of[x], key=order), len(of[x]), sha(x)) for i, t in hard for x in [BLANK.sub(" ", t or "")])
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [(r.doc_id, r.text_sha256) for r in got if r.kept]
    assert sorted(kept, key=str) == sorted(((min(ids, key=order), sha(x)) for x, ids in of.items()), key=str)


def test_exact_duplicates_leave_one_row_of_each(docs, hard):
    got = chunk_dedup.drop_duplicates(docs)
    assert got.columns == docs.columns
    texts = [BLANK.sub(" ", r.text or "") for r in got.collect()]
    assert sorted(texts) == sorted({BLANK.sub(" ", t or "") for _, t in hard})


def test_chunks_follow_content():
    rng = random.Random(1)
    shared = bytes(rng.randrange(97, 123) for _ in range(60_000))
    one, two = chunk_dedup.identifiers(b"x" * 999 + shared, 64)[0], chunk_dedup.identifiers(shared, 64)[0]
    assert len(set(one) & set(two)) > 0.8 * len(two)
    for data in (b"", b"a", b"a" * 100_000, shared):
        ends = chunk_dedup.cuts(data)
        sizes = np.diff([0, *ends])
        assert (ends[-1] if ends else 0) == len(data) and (sizes > 0).all() and (sizes <= 8192).all()


def brute_lines(rows, least_docs, least_chars):
    ends = "\x20\t\n\x0b\x0c\r"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(ends).translate(lower)
    n = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if len(k) >= least_chars)
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if n[key(x)] < least_docs]
        out[i, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


@pytest.mark.parametrize("least_docs, least_chars", [(10, 1), (2, 1), (2, 5), (1, 1)])
def test_common_lines(docs, hard, least_docs, least_chars):
    got = line_dedup.drop_common_lines(docs, least_docs, least_chars).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got) == brute_lines(hard, least_docs, least_chars)


def test_a_line_in_every_document_is_spread_over_copies(spark, hard):
    rows = [(i, f"everywhere\nown {i}\nnear {i // 9}") for i in range(3000)]
    got = line_dedup.drop_common_lines(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got) == brute_lines(rows, 10, 1)


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=400))
def test_perfect_hash_is_minimal(keys):
    keys = np.array(sorted(keys), np.uint64)
    index = line_dedup.PerfectHash.build(keys)
    assert sorted(index(keys).tolist()) == list(range(len(keys)))
    again = line_dedup.PerfectHash(np.frombuffer(index.bits(), np.uint8), index.sizes)
    assert (again(keys) == index(keys)).all()


def test_shard_tells_lines_with_one_first_half_apart():
    lines = pd.DataFrame({"shard": 3, "h1": [5, 5, 9], "h2": [1, 2, 3], "n": [10, 20, 30]})
    row = line_dedup.build_shard(lines).iloc[0]
    asked = np.array([5, 5, 9, 9, 77]), np.array([1, 2, 3, 4, 5])
    assert line_dedup.probe(row, *asked).tolist() == [10, 20, 30, 0, 0]


def brute_print(text, width=4):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(prints, distance):
    label = {p: p for p in prints}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in label:
        for b in label:
            if bin(a ^ b).count("1") <= distance:
                label[find(a)] = find(b)
    return {p: find(p) for p in label}


@pytest.mark.parametrize("count", [None, 2, 4])
def test_near_duplicates(docs, hard, count):
    got = simhash.near_duplicates(docs, count=count).collect()
    prints = [(i, brute_print(t)) for i, t in hard]
    assert Counter((r.doc_id, r.fingerprint % 2**64) for r in got) == Counter(prints)
    of = brute_components({p for _, p in prints}, 4)
    least = {}
    for i, p in prints:
        least[of[p]] = min(least.get(of[p], i), i, key=order)
    assert all(r.component_id == least[of[r.fingerprint % 2**64]] for r in got)
    groups = {}
    for r in got:
        groups.setdefault(r.component_key, set()).add(of[r.fingerprint % 2**64])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(least)


@pytest.mark.parametrize("count", [1, 2, 3, 4, 5, 7])
def test_links_lose_none_and_invent_none(spark, hard, count):
    rng = random.Random(count)
    centres = [rng.getrandbits(64) for _ in range(6)] + [0, 2**64 - 1]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for c in centres for _ in range(25)}
    rows = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    distance = 2 if count == 1 else 4  # a ball over all 64 bits grows fast
    got = simhash.links(spark.createDataFrame(rows, "fingerprint long"), distance, count).collect()
    pairs = {frozenset((r.a % 2**64, r.b % 2**64)) for r in got}
    assert pairs == {frozenset((a, b)) for a in prints for b in prints if a < b and bin(a ^ b).count("1") <= distance}


def test_radii_leave_no_gap():
    for count in range(1, 9):
        for distance in range(9):
            of = simhash.segments(count, distance)
            assert sum(r + 1 for _, _, r in of) == distance + 1


def test_near_duplicates_leave_one_document_of_each(docs, hard):
    got = simhash.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    of = brute_components({brute_print(t) for _, t in hard}, 4)
    groups = [of[brute_print(r.text)] for r in got.collect()]
    assert sorted(groups) == sorted(set(of.values()))


def test_components_of_paths_stars_and_cliques(spark, hard):
    links = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 300)]
    links += [(a, b) for a in range(5000, 5020) for b in range(5000, 5020)] + [(7, 7), (-5, 3)]
    got = components(spark.createDataFrame(links, "a long, b long").repartition(9)).collect()
    root = {r.node: r.root for r in got}
    assert len(root) == len(got)
    want = {i: -5 for i in range(201)} | {1000 + i: 1000 for i in range(1, 300)} | {i: 5000 for i in range(5001, 5020)}
    assert root == want


def test_empty_tables(none):
    assert chunk_dedup.exact_duplicates(none).count() == 0
    assert chunk_dedup.drop_duplicates(none).count() == 0
    assert line_dedup.drop_common_lines(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.drop_near_duplicates(none).count() == 0


def test_hot_groups(spark, hard):
    """A third of the rows are copies of one text, another third near copies."""
    near = "a river of stone and a house of cloud in the middle of the town with many more words to come until the end "
    rows = [(i, "copy of one") for i in range(400)] + [(400 + i, near * 6 + f"x{i % 40}") for i in range(400)]
    rows += [(800 + i, f"text number {i} of its own kind {i * 7919}") for i in range(400)]
    docs = frame(spark, rows)
    assert chunk_dedup.exact_duplicates(docs).filter("kept").count() == 1 + 40 + 400
    got = simhash.near_duplicates(docs).filter(F.col("doc_id") < 800)
    of = brute_components({brute_print(t) for _, t in rows}, 4)
    assert got.select("component_id").distinct().count() == len({of[brute_print(t)] for i, t in rows if i < 800})


def test_probe_groups_are_bounded_however_few_lines_there_are(spark, hard):
    """20,000 documents of three out of 50 lines, a third of them without an id and equal."""
    rng, bound = random.Random(3), 1000
    texts = ["\n".join(f"line {rng.randrange(50)}" for _ in range(3)) for _ in range(13_000)]
    rows = [*enumerate(texts), *[(None, "line 1\nline 2\nonce")] * 7_000]
    many = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = line_dedup.drop_common_lines(many, 10, shard_probes=bound).groupBy("text", "n_dropped").count().collect()
    assert [tuple(r) for r in got] == [("", 3, 20_000)]  # "once" is in 7,000 documents
    keyed = many.withColumn("key", F.xxhash64("doc_id", "text"))
    sizes = spark.createDataFrame([(s, 40_000) for s in range(4)], "shard int, n long")
    copies = line_dedup.copies_of(sizes, 4, bound)
    assert copies == dict.fromkeys(range(4), 40)
    groups = line_dedup.asked_lines(keyed, 4, copies, 1).groupBy("shard", "copy").count()
    assert groups.agg(F.max("count")).first()[0] < 2 * bound


def test_only_doubtful_chunks_are_read_again(spark, hard):
    """Two chunks of one hash, in three of 203 documents; the others' texts and chunks are not exploded."""
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdefgh \n") for _ in range(6000)) for _ in range(203)]
    docs = spark.createDataFrame([*enumerate(texts), (900, texts[0])], "doc_id long, text string")
    bits = 40
    recipes = chunk_dedup._recipes(docs, bits)
    some = sorted({chunk_dedup.identifiers(texts[i].encode(), bits)[0][1] for i in (0, 7, 9)})
    doubtful = spark.createDataFrame([(i,) for i in some], "id long")
    got = chunk_dedup.doubtful_chunks(recipes, docs, doubtful, bits).collect()
    want = {
        (hashlib.sha256(t.encode()).digest(), place, i, c)
        for t in texts for place, (i, c) in enumerate(zip(*chunk_dedup.identifiers(t.encode(), bits))) if i in some
    }
    assert {(bytes(r.digest), r.place, r.id, bytes(r.chunk)) for r in got} == want
    assert len(got) == len(want) == 3


@pytest.mark.parametrize("drop", [chunk_dedup.drop_duplicates, simhash.drop_near_duplicates])
@pytest.mark.parametrize("listed", ["short", "too long for a filter"])
def test_texts_that_stay_meet_no_join(spark, monkeypatch, drop, listed):
    """Only rows whose doc_id may be on the list of those that go are joined to it; all are where no filter can hold the list."""
    rng = random.Random(6)
    texts = [" ".join(f"{rng.getrandbits(40):x}" for _ in range(30)) for _ in range(600)]
    rows = [*enumerate(texts), (0, texts[0]), (700, texts[5]), (None, texts[6]), (7, texts[8]), (None, "only here"), (None, "only here")]
    docs = frame(spark, rows)
    if listed != "short":
        monkeypatch.setattr(key_filter, "MOST_BITS", 0)
    joined, join = [], type(docs).join

    def counted(left, *a):
        if "text" in left.columns:
            joined.append(left.count())
        return join(left, *a)

    monkeypatch.setattr(type(docs), "join", counted)
    got = drop(docs)
    # ids 0, 8, 700 and null are listed: seven rows, and a few in a hundred that only seem to be
    assert joined and all(7 <= n < 60 if listed == "short" else n == len(rows) for n in joined)
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter([(i, t) for i, t in enumerate(texts) if i != 8] + [(7, texts[8]), (None, "only here")])
