"""Token counts, files, suffix-array encoding and packing against the libraries themselves."""

import random
import subprocess
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import frame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeloom.llm import packing, suffix_pieces, token_counts, token_files, vocab
from lakeloom.session import workspace

ROOT = Path(__file__).resolve().parents[2]
BYTES, WORDS, PIECES = map(public_tokenizers.path, ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECES)
TEXTS = st.text(st.sampled_from("abcdefghinorstuTHE  \n\t'.,!-019éßÀÿ▁日½²́ΣİK  <|>"), max_size=80)


def library_ids(file, text, end):
    return [*Tokenizer.from_file(file).encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("file", [BYTES, WORDS])
@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_pretokens_give_the_library_ids(file, text):
    known = vocab.encoder(file)
    assert known.apart
    assert np.frombuffer(known.encode(text), "<u4").tolist() == known.library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("file", [BYTES, WORDS])
def test_long_texts_are_cut_where_no_token_reaches(file):
    known = vocab.Encoder(file, most=50, segment=40)
    rng = random.Random(3)
    text = " ".join(rng.choice(["Überß", "the", "river  x", "日本", "it's", "9 1", "<|endoftext|>", "a\n b"]) for _ in range(3000))
    assert len(list(known.segments(text))) > 20
    assert np.frombuffer(known.encode(text), "<u4").tolist() == known.library.encode(text, add_special_tokens=False).ids


def test_proved_pieces_are_single_tokens():
    found = token_counts.proved(LIBRARY)
    assert len(found) > 10_000 and set(found.values()) == {1}
    assert all(len(LIBRARY.encode(p[1:].replace("▁", " "))) == 1 for p in random.Random(1).sample(sorted(found.keys() - {"▁"}), 500))


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=4))
def test_counts_and_suffix_arrays_give_the_library_pieces(texts):
    want = LIBRARY.encode(texts)
    assert token_counts.counter(PIECES).count(texts) == [len(w) for w in want]
    model = suffix_pieces.matcher(PIECES)
    assert [np.frombuffer(x, "<u4").tolist() for x in model.encode(texts)] == want
    assert [model.decode(w) for w in want] == LIBRARY.decode(want)


@settings(max_examples=100, deadline=None)
@given(st.text("abAB+/é語 ", max_size=200), st.integers(17, 40))
def test_stretches_are_encoded_window_after_window(text, block):
    model = suffix_pieces.matcher(PIECES)
    whole, model.block = model.block, block
    model.known.clear()
    try:
        assert np.frombuffer(model.encode([text])[0], "<u4").tolist() == LIBRARY.encode(text)
    finally:
        model.block = whole


def test_five_million_characters_without_a_cut_take_little_memory():
    program = f"""
import resource
import numpy as np
from lakeloom.llm.suffix_pieces import Matcher
model = Matcher({PIECES!r})
text = "ab" * 2_500_000
got = np.frombuffer(model.encode([text])[0], "<u4")
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1000, (got == np.array(model.library.encode(text))).all())
"""
    done = subprocess.run([sys.executable, "-c", program], capture_output=True, text=True, check=True, timeout=300, cwd=ROOT)
    peak, equal = done.stdout.split()
    assert equal == "True" and int(peak) < 1000


def test_suffix_order_sorts_by_the_next_characters():
    rng = random.Random(2)
    text = "".join(rng.choice("ab") for _ in range(500))
    order = suffix_pieces.suffix_order(np.frombuffer(text.encode("utf-32-le"), "<u4"), 16)
    ahead = [text[i : i + 16] for i in order.tolist()]
    assert ahead == sorted(ahead) and sorted(order.tolist()) == list(range(500))


def test_count_tokens(docs, hard, none):
    got = token_counts.count_tokens(docs, PIECES).collect()
    want = Counter((i, len((t or "").encode()), len(LIBRARY.encode(t or ""))) for i, t in hard)
    assert Counter(map(tuple, got)) == want
    assert token_counts.count_tokens(none, PIECES).count() == 0


def test_suffix_pieces(docs, hard, none):
    got = suffix_pieces.decode(suffix_pieces.encode(docs, PIECES), PIECES).collect()
    ids = [(i, LIBRARY.encode(t or "")) for i, t in hard]
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in got) == Counter((i, tuple(x), LIBRARY.decode(x)) for i, x in ids)
    assert suffix_pieces.decode(suffix_pieces.encode(none, PIECES), PIECES).count() == 0


def test_token_files(spark, docs, hard, none):
    path = workspace(spark, "test-tokens")
    token_files.write_token_files(docs, path, BYTES, 2)
    got = token_files.read_token_files(spark, path).orderBy("start").collect()
    ordered = sorted(hard, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for row, (i, t) in zip(got, ordered, strict=True):
        ids = library_ids(BYTES, t, 2)
        assert (row.doc_id, row.start, row.n_tokens, row.ids) == (i, at, len(ids), ids)
        at += len(ids)
    sums = token_files.with_checksum(token_files.read_token_files(spark, path)).collect()
    assert Counter((r.doc_id, r.ids_crc32) for r in sums) == Counter((i, crc(library_ids(BYTES, t, 2))) for i, t in hard)
    assert [r.doc_id for r in token_files.tokens_of(spark, path, [19]).collect()] == [19]
    files = [f for f in spark.read.orc(path).inputFiles()]
    held = spark.read.orc(path).filter("doc_id is not null").groupBy(F.input_file_name()).agg(F.min("doc_id"), F.max("doc_id"))
    spans = sorted(tuple(r)[1:] for r in held.collect())
    assert len(files) > 1 and all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
    empty = workspace(spark, "test-tokens")
    token_files.write_token_files(none, empty, BYTES, 2)
    assert token_files.read_token_files(spark, empty).count() == 0


def check_packing(rows, hard, size, end):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert 1 <= r.length <= size
        by_doc[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(list)
    for i, t in hard:
        ids = library_ids(WORDS, t, end)
        want[i, len(ids)] += [(a, len(ids[a : a + size]), crc(ids[a : a + size])) for a in range(0, len(ids), size)]
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in want.items()}
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= size
    return by_sequence


@pytest.mark.parametrize("size, groups", [(2048, 2000), (64, 2000), (64, 7), (1, 50)])
def test_pack(docs, hard, size, groups):
    short = [r for r in hard if len(r[1] or "") < 6000] if size == 1 else hard
    source = docs.filter("coalesce(length(text), 0) < 6000") if size == 1 else docs
    rows = packing.pack(source, WORDS, 1, size, group_items=groups).collect()
    sequences = check_packing(rows, short, size, 1)
    if groups == 2000:
        assert len(sequences) <= 1.05 * sum(r.length for r in rows) / size + 2


def test_pack_with_ids(docs, hard):
    rows = packing.pack(docs, WORDS, 1, 128, with_ids=True).collect()
    check_packing(rows, hard, 128, 1)
    assert all(len(r.ids) == r.length and crc(r.ids) == r.ids_crc32 for r in rows)


@pytest.mark.parametrize("with_ids", [False, True])
def test_pack_keeps_large_ids_beside_a_null_one(spark, hard, with_ids):
    rows = [(2**53 + 1 + 2 * i, f"house {i}") for i in range(20)] + [(None, "no id"), (-(2**62) - 1, "cloud"), (2**63 - 1, "river")]
    packed = packing.pack(frame(spark, rows), WORDS, 1, 64, with_ids=with_ids).collect()
    check_packing(packed, rows, 64, 1)


def test_pack_of_nothing(none):
    assert packing.pack(none, WORDS, 1).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80), st.integers(50, 70))
def test_best_fit_takes_the_tightest_room(lengths, size):
    lengths = sorted(lengths, reverse=True)
    rooms, want = [], []
    for n in lengths:
        fits = [(room, i) for i, room in enumerate(rooms) if room >= n]
        if fits:
            room = min(fits)[0]
            want.append(room)
            rooms[next(i for i, r in enumerate(rooms) if r == room)] -= n
        else:
            want.append(size)
            rooms.append(size - n)
    sequences, offsets = packing.best_fit(lengths, size)
    assert [size - o for o in offsets] == want and len(set(sequences)) == len(rooms)


def test_short_documents_leave_hardly_any_padding(spark):
    rows = [(i, " ".join(f"w{(i * k) % 97}" for k in range(1, 4 + i % 3))) for i in range(20_000)]
    pieces = packing.pack(frame(spark, rows), WORDS, 1).select("sequence_id", "length").collect()
    sequences = len({r.sequence_id for r in pieces})
    assert sequences <= 1.01 * -(-sum(r.length for r in pieces) // 2048)


def test_what_comes_again_is_taken_over_when_the_dictionary_starts_anew():
    known, asked = vocab.Encoder(BYTES, most=40), []
    model = known._model
    known._model = type("Model", (), {"tokenize": lambda _, word: asked.append(word) or model.tokenize(word)})()
    for n in range(200):
        text = f"the river {n * 7919} {n}"
        assert np.frombuffer(known.encode(text), "<u4").tolist() == known.library.encode(text, add_special_tokens=False).ids
        assert len(known) + len(known._before) < 90
    assert asked.count("the") <= 1
