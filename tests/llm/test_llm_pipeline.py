"""The pipeline's stages against brute force, and the contract of the registered queries."""

import re
from collections import Counter
from pathlib import Path

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F
from test_llm_dedup import BLANK, brute_components, brute_print, order
from test_llm_texts import brute_spans
from test_llm_tokens import check_packing

import __spark_entry__
from lakeloom.llm.byte_cnn import held_out
from lakeloom.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op2_": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op3_": ["doc_id", "fingerprint", "component_id"],
    "op4_": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op5_": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
    "op6_": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op7_": ["doc_id", "n_tokens", "decoded_sha256", "ids_crc32"],
    "op8_": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op9_": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    "op10_": ["doc_id", "held_out", "lang_pred", "score"],
    "op11_": [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality", "votes",
    ],
    "op12_": ["doc_id", "n_features", "weight", "score", "rank"],
    "op13_": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
}


def test_every_operator_is_registered_once():
    found = [n for n in __spark_entry__.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in found) == list(range(1, 14))
    assert set(found) == set(QUERIES) and "pipeline" in __spark_entry__.queries()
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_columns(spark, name):
    prefix = re.match(r"op\d+_", name)[0]
    assert QUERIES[name](spark, SMALL).columns == COLUMNS[prefix]


@pytest.mark.parametrize("name", ORACLES)
def test_queries_say_what_the_sql_says(spark, name):
    rows = QUERIES[name](spark, SMALL)
    db = duckdb.connect()
    for name_ in ("documents", "benchmark", "conversations"):
        db.execute(f"CREATE VIEW {name_} AS SELECT * FROM '{SMALL}/{name_}.parquet'")
    want = db.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(rows.columns)
    assert Counter(map(tuple, rows.select(columns).collect())) == Counter(want.fetchall())


def next_docs(spark, tmp_path, name, docs):
    path = str(tmp_path / name)
    docs.write.parquet(path)
    return spark.read.parquet(path)


def test_stages(spark, docs, hard, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "exact dedup", "SimHash near-dedup", "secret scans", "packing"]
    language, exact, near, secrets, packing = (f for _, f in corpus_pipeline.STAGES)
    rows = list(hard)
    held = next_docs(spark, tmp_path, "language", language(spark, docs, ""))
    rows = [(i, t) for i, t in rows if t is not None and any(c.isalpha() for c in t)]
    assert held.columns == docs.columns and Counter((r.doc_id, r.text) for r in held.collect()) == Counter(rows)

    held = next_docs(spark, tmp_path, "exact", exact(spark, held, ""))
    groups = {}
    for i, t in sorted(rows, key=lambda r: order(r[0])):
        groups.setdefault(BLANK.sub(" ", t), i)
    assert held.columns == docs.columns
    assert Counter((r.doc_id, BLANK.sub(" ", r.text)) for r in held.collect()) == Counter((i, t) for t, i in groups.items())
    rows = [(r.doc_id, r.text) for r in held.collect()]

    held = next_docs(spark, tmp_path, "near", near(spark, held, ""))
    of = brute_components({brute_print(t) for _, t in rows}, 4)
    least = {}
    for i, t in sorted(rows, key=lambda r: order(r[0])):
        least.setdefault(of[brute_print(t)], i)
    assert held.columns == docs.columns
    assert Counter((r.doc_id, of[brute_print(r.text)]) for r in held.collect()) == Counter((i, c) for c, i in least.items())
    rows = [(r.doc_id, r.text) for r in held.collect()]

    held = next_docs(spark, tmp_path, "secrets", secrets(spark, held, ""))
    assert held.columns == docs.columns and Counter(r.doc_id for r in held.collect()) == Counter(i for i, _ in rows)
    assert not any(brute_spans(r.text) for r in held.collect())
    clean = {(i, t) for i, t in rows if not brute_spans(t)}
    assert clean <= {(r.doc_id, r.text) for r in held.collect()}
    rows = [(r.doc_id, r.text) for r in held.collect()]

    check_packing(packing(spark, held, "").collect(), rows, 2048, 1)


@pytest.mark.parametrize("label", ["null", "null but where held out", "und"])
def test_language_stage_without_usable_labels(spark, docs, hard, label):
    lang = {
        "null": F.lit(None).cast("string"),
        "null but where held out": F.when(held_out(F.col("doc_id")), "en"),
        "und": F.when(F.col("doc_id") % 2 == 0, "und").otherwise("en"),
    }[label]
    kept = corpus_pipeline.STAGES[0][1](spark, docs.withColumn("lang", lang), "")
    assert kept.columns == docs.columns
    want = Counter((i, t) for i, t in hard if t is not None and any(c.isalpha() for c in t))
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == want


def test_stages_of_nothing(spark, none):
    held = none
    for _, stage in corpus_pipeline.STAGES[:-1]:
        held = stage(spark, held, "")
        assert held.columns == none.columns and held.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, held, "").count() == 0


def test_run_keeps_clean_documents_and_drops_copies(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    texts = {r.doc_id: BLANK.sub(" ", r.text) for r in docs if any(c.isalpha() for c in r.text)}
    first = {}
    for i in sorted(texts):
        first.setdefault(texts[i], i)
    of = brute_components({brute_print(t) for t in first}, 4)
    least = {}
    for t, i in sorted(first.items(), key=lambda x: x[1]):
        least.setdefault(of[brute_print(t)], i)
    assert {r.doc_id for r in rows} == set(least.values())


def test_the_rest_stands_without_the_subpackage(tmp_path):
    import subprocess
    import sys

    root = Path(__spark_entry__.__file__).parent
    for source in [root / "__spark_entry__.py", *root.glob("lakeloom/**/*.py")]:
        if "llm" not in source.relative_to(root).parts:
            copy = tmp_path / source.relative_to(root)
            copy.parent.mkdir(parents=True, exist_ok=True)
            copy.write_text(source.read_text())
    code = "import __spark_entry__ as e; print(len(e.queries()), [n for n in e.queries() if n.startswith('op') or n == 'pipeline'])"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert out.stdout.strip().endswith("[]") and int(out.stdout.split()[0]) >= 75


def test_the_language_network_is_asked_once_per_text(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(["a river", "12", None, "the sea"])], "doc_id long, text string, lang string")
    kept = corpus_pipeline.language(spark, docs, "")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("run(") == 2  # the network and the letters
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3]


def test_the_language_stage_has_one_worker_a_task(spark):
    docs = spark.createDataFrame([(1, "a river", "en"), (2, "the sea", None)], "doc_id long, text string, lang string")
    kept = corpus_pipeline.language(spark, docs, "")
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted(tuple(r) for r in kept.collect()) == [(1, "a river", "en"), (2, "the sea", "en")]
