"""Secrets, spot signatures and language against brute force, and held-out accuracy."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import frame
from pyspark.sql import functions as F

from lakeloom.llm import byte_cnn, secret_ledger, spotsigs
from lakeloom.session import workspace

PATTERNS = (
    (r"""((?a:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    (r"AKIA[A-Z0-9]+", 0, 16),
    (r"[0-9a-f]+", 0, 32),
)


def brute_spans(text):
    spans = [(m.start(), k, m.end()) for k, (p, g, n) in enumerate(PATTERNS) for m in re.finditer(p, text or "") if len(m[g]) >= n]
    return sorted(spans)


def test_secrets(spark, docs, hard):
    got = secret_ledger.find_secrets(docs, workspace(spark, "ledger")).collect()
    rows = Counter((r.doc_id, tuple((s.start, s.kind, s.end) for s in r.spans or ())) for r in got)
    assert rows == Counter((i, tuple(brute_spans(t))) for i, t in hard)
    assert sum(bool(brute_spans(t)) for _, t in hard) >= 3


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["token", "Secret", "api_key", "apikey", "=", ":", " ", "'", "abc123", "AKIA", "ABCDEFGH1234",
                                          "0123456789abcdef", "é", "\n", "🎉", "passwd\"", "=="]), max_size=14).map("".join), max_size=12))
def test_spans_of_any_text(spark, hard, texts):
    got = secret_ledger.find_secrets(frame(spark, list(enumerate(texts))), workspace(spark, "ledger")).collect()
    assert {r.doc_id: [(s.start, s.kind, s.end) for s in r.spans or ()] for r in got} == {i: brute_spans(t) for i, t in enumerate(texts)}


def test_ledger_scans_only_what_it_does_not_know(spark, hard):
    path, secret = workspace(spark, "ledger"), "token = abcdefgh12345"
    first = [(1, secret), (2, "clean"), (3, secret)]
    secret_ledger.find_secrets(frame(spark, first), path).count()
    scanned = lambda v=secret_ledger.RULES_VERSION: secret_ledger.read_ledger(spark, path, v).filter("kind = -1").count()
    assert scanned() == 2
    rows = secret_ledger.find_secrets(frame(spark, [*first, (4, "new"), (5, secret)]), path).collect()
    assert scanned() == 3
    assert {r.doc_id for r in rows if r.spans} == {1, 3, 5}
    rule = secret_ledger.Rule("new", "new", 0, 3)
    rows = secret_ledger.find_secrets(frame(spark, [(4, "new"), (5, secret)]), path, (rule,), "other").collect()
    assert scanned("other") == 2 and {r.doc_id for r in rows if r.spans} == {4}


def test_query_scans_a_second_time_only_what_is_new(spark, monkeypatch):
    from lakeloom.llm import queries

    path, small = workspace(spark, "ledger"), "/root/testdata/sf0.001"
    monkeypatch.setattr(queries, "workspace", lambda *_: path)
    rows = queries.op6_secrets(spark, small).count()
    texts = spark.read.parquet(f"{small}/documents.parquet")
    blobs = secret_ledger.read_ledger(spark, path, secret_ledger.RULES_VERSION).filter("kind = -1")
    runs = spark.read.parquet(path).filter("kind = -1").groupBy("run").count().collect()
    assert rows == texts.count() and len(runs) == 2
    assert blobs.count() == blobs.select("blob").distinct().count() == texts.select("text").distinct().count()


def test_texts_stay_where_they_are(spark, monkeypatch):
    """Only texts that come again, are known or hold a secret are shuffled."""
    scanned, joined = [], []
    plain, join = secret_ledger.scan, secret_ledger.spread_join
    monkeypatch.setattr(secret_ledger, "scan", lambda blobs, *a: scanned.append(blobs) or plain(blobs, *a))
    monkeypatch.setattr(secret_ledger, "spread_join", lambda left, *a, **k: joined.append(left.count()) or join(left, *a, **k))
    rows = [(i, "token = abcdefgh12345" if i == 7 else f"text {i}") for i in range(400)]
    path, docs = workspace(spark, "ledger"), frame(spark, rows)
    masked = secret_ledger.redact(docs, path).collect()
    assert {r.doc_id: r.text for r in masked} == {**dict(rows), 7: "[SECRET]"}
    assert "hashpartitioning(blob" not in scanned[0]._jdf.queryExecution().executedPlan().toString()
    again = frame(spark, [*rows, (400, "text 5"), (401, "new"), (402, "new"), (403, "old")])
    assert secret_ledger.find_secrets(again, path).count() == 404
    assert scanned[1].count() == 2 and joined[0] < 40 and 401 <= joined[1] < 404


def test_main_path_has_no_python(spark, docs):
    plan = secret_ledger.find_secrets(docs, workspace(spark, "ledger"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_redaction(spark, docs, hard):
    got = secret_ledger.redact(docs, workspace(spark, "ledger"))
    assert got.columns == docs.columns

    def mask(text):
        out, at = [], 0
        for start, _, end in brute_spans(text):
            out.append(text[at:start] + "[SECRET]" if start >= at else "")
            at = max(at, end)
        return "".join(out) + text[at:]

    rows = got.select("doc_id", "text", "n_chars").collect()
    want = Counter((i, None if t is None else mask(t), len(mask(t or ""))) for i, t in hard)
    assert Counter(map(tuple, rows)) == want


def test_secrets_of_nothing(spark, none):
    assert secret_ledger.find_secrets(none, workspace(spark, "ledger")).count() == 0
    assert secret_ledger.redact(none, workspace(spark, "ledger")).count() == 0


def brute_edit(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for k, (i, t) in enumerate(ordered):
        t, behind = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        n = len(t) // 4
        yield i, t, t[: len(t) - n] + behind[:n], behind


def test_fingerprints_with_edits(docs, hard):
    got = Counter(
        (r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9))
        for r in spotsigs.fingerprints_with_edits(docs).collect()
    )
    want, print_ = Counter(), lambda t: spotsigs.written(spotsigs.spots(t))
    for i, t, edit, behind in brute_edit(hard):
        sets = [set(spotsigs.spots(x).tolist()) for x in (t, edit, behind)]
        near = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        digest = hashlib.sha256(edit.encode()).hexdigest()
        want[i, len(t), digest, print_(t), print_(edit), round(near[0], 9), round(near[1], 9)] += 1
    assert got == want


@pytest.mark.parametrize("rows", [[], [(1, "one and only the house")], [(None, None)], [(5, "x"), (5, "x")], [(2, "b"), (1, "a"), (None, "c")]])
def test_fingerprints_of_few_documents(spark, hard, rows):
    got = spotsigs.fingerprints_with_edits(frame(spark, rows)).collect()
    want = Counter((i, hashlib.sha256(e.encode()).hexdigest()) for i, _, e, _ in brute_edit(rows))
    assert Counter((r.doc_id, r.edited_sha256) for r in got) == want


def test_spots_are_anchors_with_chains():
    one = spotsigs.spots("The river of stone and a house", chain=2)
    assert len(one) == 2 + 5  # the river stone, of stone house; few, so all chains besides
    assert spotsigs.read(spotsigs.written(one)).tolist() == one.tolist()
    assert spotsigs.jaccard(one, one) == 1.0 and spotsigs.jaccard(one, one[:1], least=0.5) == 0.0


def test_similar_documents(spark, hard):
    base = "the river of stone and a house of cloud in the garden by the old mill was it that they saw on the way to the north "
    rows = [(i, base * 3 + f"the end {i % 7} of it all") for i in range(30)]
    rows += [(100 + i, f"the {'abc'[i % 3]}{i} of w{i * 31} and x{i * 17} is y{i} for z{i * 3}") for i in range(40)]
    rows += [(200, None), (201, ""), (None, base)]
    got = spotsigs.similar_documents(frame(spark, rows), 0.8).collect()
    sets = [(i, set(spotsigs.spots(t or "").tolist())) for i, t in rows]
    label = list(range(len(rows)))

    def find(x):
        return x if label[x] == x else find(label[x])

    linked = Counter()
    distinct = {frozenset(s) for _, s in sets}
    for a in distinct:
        linked[a] = sum(a != b and len(a & b) / max(1, len(a | b)) >= 0.8 for b in distinct)
    for x, (_, a) in enumerate(sets):
        for y, (_, b) in enumerate(sets):
            if (len(a & b) / len(a | b) if a | b else 1.0) >= 0.8:
                label[find(max(x, y, key=find))] = min(find(x), find(y))
    least = {}
    for x, (i, _) in enumerate(sets):
        least[find(x)] = min(least.get(find(x), i), i, key=lambda i: (i is None, i or 0))
    want = Counter((i, least[find(x)], linked[frozenset(s)]) for x, (i, s) in enumerate(sets))
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == want


def test_language(spark, hard):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    network = byte_cnn.learn(docs)
    rows = byte_cnn.predictions(docs, network).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and 0 < len(out) < len(rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in out]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_hard_texts(docs, hard, none, spark):
    labelled = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "a").when(F.col("doc_id") % 5 == 0, None).otherwise("b"))
    network = byte_cnn.learn(labelled)
    assert network.labels == ["a", "b"]
    got = byte_cnn.predictions(labelled, network).collect()
    assert len(got) == len(hard)
    unknown = Counter(r.doc_id for r in got if r.lang_pred == "und")
    assert unknown == Counter(i for i, t in hard if t is None or not any(c.isalpha() for c in t))
    assert all((r.score == 0) == (r.lang_pred == "und") for r in got)
    column = byte_cnn.classify(labelled, network, "__found").collect()
    assert Counter((r.doc_id, r["__found"]) for r in column) == Counter((r.doc_id, r.lang_pred) for r in got)
    assert byte_cnn.predictions(none, byte_cnn.learn(none)).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in byte_cnn.predictions(unlabelled, byte_cnn.learn(unlabelled)).collect()} == {"und"}


def test_copies_take_no_share_of_the_sample(spark, hard):
    rows = [("a", f"house number {i}") for i in range(400)] + [("b", f"casa {i}") for i in range(400)] + [("b", "copia")] * 4000
    labelled = spark.createDataFrame(rows, "lang string, text string")
    sample, languages = byte_cnn.draw(labelled, 100)
    drawn = Counter(r.lang for r in sample.collect())
    assert languages == 2 and all(70 <= drawn[x] <= 130 for x in "ab")


def test_a_language_of_copies_is_learned(spark, hard):
    texts = [("a", f"house number {i}") for i in range(40)] + [("b", "copia de casa")] * 4000
    docs = spark.createDataFrame([(i, t, x) for i, (x, t) in enumerate(texts)], "doc_id long, text string, lang string")
    assert byte_cnn.learn(docs, rows_per_language=40).labels == ["a", "b"]


def test_tables_are_the_convolution():
    network = byte_cnn.Network.new(["a", "b"])
    rows, counts = byte_cnn.windows([b"hello world", b"x" * 600, b""])
    assert counts.tolist() == [1, 3, 0]
    want = []
    for w in byte_cnn.WIDTHS:
        seen = np.stack([network.vectors[rows[:, k : k + byte_cnn.WINDOW]] for k in range(w)], axis=2)
        want.append(np.einsum("nlwe,wef->nlf", seen, network.filters[w]).max(axis=1) + network.biases[w])
    assert np.allclose(network.features(rows), np.maximum(np.concatenate(want, axis=1), 0), atol=1e-4)
