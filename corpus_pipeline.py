"""The training-data pipeline over ``documents``: language, exact and near copies, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before
it kept; all but the last return the columns of ``docs``. The language network is
learned from the stage's own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.byte_cnn import UNKNOWN, called, learn, lettered
from lakeloom.llm.chunk_dedup import drop_duplicates
from lakeloom.llm.packing import pack
from lakeloom.llm.queries import vocabulary
from lakeloom.llm.rows import fresh, materialise, ship, table, tune, workspace
from lakeloom.llm.secret_ledger import redact
from lakeloom.llm.simhash import drop_near_duplicates


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no text or no letter) go; every other one stays, and gets the predicted
    language where it has none.

    Null and empty texts go. A label that is there stays as it is; a column lang of text is filled where it is null, and
    stays null where there was no label to learn. Repeated rows are treated alike; other columns pass, whatever their names.
    """
    tune(ship(spark))
    found, letter = fresh(docs, "__language"), fresh(docs, "__letter")
    # in one projection, so that both are asked of one worker; in two, each task would have two
    answered = docs.withColumns({found: called(F.col("text"), learn(docs)), letter: lettered(F.col("text"))})
    # a text with a letter stays also where there was no label to learn, or where one is called as the unknown language is
    held = answered.filter((F.col(found) != UNKNOWN) | F.col(letter))
    if dict(docs.dtypes).get("lang") == "string":
        known = F.when(F.col(found) != UNKNOWN, F.col(found))
        held = held.withColumn("lang", F.coalesce("lang", known))
    return held.select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest doc_id stays; a null doc_id is the largest, a null text empty.

    Of repeated rows one stays. Other columns pass as they are.
    """
    tune(ship(spark))
    return drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their fingerprints the one with the smallest doc_id stays; null ones come last.

    Null and empty texts share a fingerprint, so one of them stays. Of repeated rows one stays. Other columns pass.
    """
    tune(ship(spark))
    return drop_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str, ledger: str | None = None) -> DataFrame:
    """Every document stays; secrets in its text are masked. A null text stays null; other columns pass, n_chars follows.

    ledger: folder of the ledger of earlier runs, whose texts are not scanned again; by default a new one.
    """
    tune(ship(spark))
    return redact(docs, ledger or workspace(spark, "secret-ledger"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their places in sequences of 2048 tokens; a null or empty text is its end id alone."""
    tune(ship(spark))
    return pack(docs, vocabulary("word_bpe_49k.json"), end_id=1, size=2048)


STAGES = [
    ("language ID", language),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("secret scans", secrets),
    ("packing", packing),
]

#: No SQL says what a trained network answers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
