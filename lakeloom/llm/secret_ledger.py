"""Secrets in every historical version of a text, each distinct content scanned once.

Method (incremental blob ledger): a version of a file or document is its content
address, the SHA-256 of its text. The ledger holds which addresses were scanned
under which version of the rules, and what was found. A run scans only texts
whose pair of address and rule version the ledger lacks, one copy each, adds
them, and joins all findings back to every path with that content. Everything is
DataFrame operations; no Python touches a row.

Rules, leftmost and non-overlapping per kind, offsets in code points, end exclusive:
``assign`` a keyword, ``:`` or ``=`` and a value of 8 or more characters; ``access``
``AKIA`` and capitals or digits, 16 or more in all; ``hex`` 32 or more digits.
A match whose value is too short counts as no finding, yet later matches start after it.

A null text is empty and has no findings. Repeated rows and null or repeated ids
each give a row. An empty table gives an empty result; other columns are ignored.
Texts of any length are scanned whole. A content that a third of all rows share is
one row per task before it is shuffled; the join back is one that Spark can split.
Addresses are shuffled for every text; the text itself only where a Bloom filter of
addresses says that it may come again, is known, or has findings to be masked.
A ledger folder may be shared by runs: each adds a folder of its own when its scan
is complete, so one that died leaves nothing that counts.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeloom.llm.rows import documents, fresh, materialise, parted
from lakeloom.operators.spread import spread_join


@dataclass(frozen=True)
class Rule:
    """group: of the pattern, 0 for the whole match, that must have ``least`` code points."""

    kind: str
    pattern: str
    group: int
    least: int


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
#: Fixed: the base rules, in the order in which kinds are listed.
RULES = (
    Rule("assign", rf"(?:{_KEYWORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 8),
    # a run that is long enough is found at the same place as by + and a later check of its length
    Rule("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
RULES_VERSION = "base-1"
LEDGER = "blob binary, kind int, start int, end int, rules string"


def address(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def read_ledger(spark: SparkSession, path: str, version: str) -> DataFrame:
    """What is known under a rule version: a row with kind -1 for each scanned blob, and one for each finding."""
    try:
        rows = spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], LEDGER)
    return rows.filter(F.col("rules") == version)


def _lengths(strings: Column) -> Column:
    return F.transform(strings, F.char_length)


def _matches(text: Column, number: int, rule: Rule) -> Column:
    """An array of one struct for each match: kind, its place, and the lengths of what is before it, itself and its value."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    zipped = F.arrays_zip(
        _lengths(F.split(text, rule.pattern, -1)).alias("gap"), _lengths(found).alias("len"), _lengths(value).alias("value")
    )
    # the last gap is what is behind the last match
    rows = F.transform(
        F.slice(zipped, F.lit(1), F.size(found)),
        lambda x, i: F.struct(
            F.lit(number).alias("kind"), i.alias("place"), x["gap"].alias("gap"), x["len"].alias("len"), x["value"].alias("value")
        ),
    )
    return F.when(text.rlike(rule.pattern), rows).otherwise(F.array().cast(_MATCHES))


_MATCHES = "array<struct<kind:int,place:int,gap:int,len:int,value:int>>"


def scan(texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob, kind, start and end of all findings in distinct texts (blob, text), and a row with kind -1 for each blob."""
    marker = F.array(F.struct(*(F.lit(x).alias(n) for n, x in (("kind", -1), ("place", 0), ("gap", 0), ("len", 0), ("value", 0)))))
    matches = F.concat(marker, *(_matches(F.col("text"), i, r) for i, r in enumerate(rules)))
    rows = texts.select("blob", F.inline(matches))
    so_far = W.partitionBy("blob", "kind").orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    ends = rows.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(so_far).cast("int"))
    least = F.element_at(F.array(F.lit(0), *(F.lit(r.least) for r in rules)), F.col("kind") + 2)
    return ends.filter(F.col("value") >= least).select("blob", "kind", (F.col("end") - F.col("len")).alias("start"), "end")


def scan_unseen(texts: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, version: str = RULES_VERSION) -> None:
    """Scan the texts that the ledger has no row for under this rule version, and add them to it."""
    spark = texts.sparkSession
    known = read_ledger(spark, ledger, version).filter("kind = -1").select("blob").distinct()
    blobs = texts.select(address(F.col("text")).alias("blob"), "text")
    if not known.isEmpty():
        apart, may = parted(blobs, materialise(known, "blobs-known"), "blob")
        blobs = spread_join(may, known, ["blob"], "left_anti", by=["blob"])
        blobs = blobs if apart is None else apart.unionByName(blobs)
    found = scan(_once(blobs), rules).withColumn("rules", F.lit(version))
    found.write.parquet(f"{ledger.rstrip('/')}/run={uuid.uuid4().hex}")


def _once(blobs: DataFrame) -> DataFrame:
    """One row for each blob; texts whose address comes once stay where they are."""
    again = blobs.groupBy("blob").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("blob")
    again = materialise(again, "blobs-again")
    if again.isEmpty():
        return blobs
    alone, may = parted(blobs, again, "blob")
    one = may.dropDuplicates(["blob"])
    return one if alone is None else alone.unionByName(one)


def findings(spark: SparkSession, ledger: str, version: str = RULES_VERSION) -> DataFrame:
    """blob and its spans: an ordered array of (start, kind, end, before), for blobs with any.

    before: the largest end of the spans before, so that overlapping spans can be told.
    """
    rows = read_ledger(spark, ledger, version).filter("kind >= 0").select("blob", "kind", "start", "end").distinct()
    before = W.partitionBy("blob").orderBy("start", "kind").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.max("end").over(before), F.lit(0)))
    return rows.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "before"))).alias("spans"))


def find_secrets(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, version: str = RULES_VERSION) -> DataFrame:
    """doc_id, blob and spans (null if none) of every document, after a scan of what the ledger doesn't know."""
    texts = documents(docs)
    scan_unseen(texts, ledger, rules, version)
    paths = texts.select("doc_id", address(F.col("text")).alias("blob"))
    return spread_join(paths, findings(docs.sparkSession, ledger, version), ["blob"], "left", by=["blob"])


def kind_count(kind: int) -> Column:
    return F.coalesce(F.size(F.filter("spans", lambda s: s["kind"] == kind)), F.lit(0)).cast("long")


def listing(rules: tuple[Rule, ...] = RULES) -> Column:
    """The spans as ``kind:start:end``, comma-joined in order of start, then kind as listed."""
    names = F.array(*(F.lit(r.kind) for r in rules))
    one = F.transform("spans", lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]))
    return F.coalesce(F.array_join(one, ","), F.lit(""))


def redact(docs: DataFrame, ledger: str, mask: str = "[SECRET]", rules: tuple[Rule, ...] = RULES, version: str = RULES_VERSION) -> DataFrame:
    """``docs`` with all their columns, each secret in ``text`` replaced by ``mask``; overlapping ones by one mask.

    A column n_chars, if there is one, gets the new length where the text changed.
    """
    scan_unseen(documents(docs), ledger, rules, version)
    found = findings(docs.sparkSession, ledger, version)
    blob, spans = fresh(docs, "__blob"), fresh(docs, "__spans")
    found = materialise(found.select(F.col("blob").alias(blob), F.col("spans").alias(spans)), "secret-spans")
    text = F.col("text").cast("string")
    clean, may = parted(docs.withColumn(blob, address(text)), found, blob)
    joined = spread_join(may, found, [blob], "left", by=[blob])
    if clean is not None:
        joined = joined.unionByName(clean.withColumn(spans, F.lit(None).cast(found.schema[spans].dataType)))
    parts = F.transform(
        F.col(spans),
        lambda s: F.concat(
            F.substring(text, s["before"] + 1, F.greatest(s["start"] - s["before"], F.lit(0))),
            F.when(s["start"] >= s["before"], F.lit(mask)).otherwise(""),
        ),
    )
    last = F.array_max(F.transform(F.col(spans), lambda s: s["end"]))
    cleaned = F.concat(F.array_join(parts, ""), F.substring(text, last + 1, F.char_length(text)))
    dirty = F.col(spans).isNotNull()
    result = joined.withColumn("text", F.when(dirty, cleaned).otherwise(text))
    if "n_chars" in docs.columns:
        kept = F.col("n_chars")
        new = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        result = result.withColumn("n_chars", F.when(dirty, new).otherwise(kept))
    return result.select(*docs.columns)
