"""Document fingerprints by spot signatures, and near duplicates through them.

Method (SpotSigs): common words are anchors. A spot is an anchor with the chain of
the next ``chain`` content words, the words that are no anchors; a text's
signature is the set of its spots. Running text is full of anchors and lists,
menus and boilerplate are not, so signatures follow what was written. Two
documents are compared by the Jaccard similarity of their sets. Set sizes alone
bound it, so documents are partitioned by set size and only those of sizes that
can reach the threshold meet; of a set only so many of its rarest-looking spots
are looked up as a similar set must share one of, and a pair's similarity is given up as soon
as it can't reach the threshold.

Lists have few common words: after ``GAP`` content words in a row, those with an
odd number of letters are anchors too, until the next common word. A text with
fewer than ``FEW`` spots has the chains of all its words besides; one too short for
a chain, the chain of all its words; one without words, the text itself, unless
it is empty. The fingerprint is the sorted set of 32-bit spot hashes, in base 64; the
empty text's is empty, and two empty fingerprints are alike.

A null text is empty. Documents follow one another by doc_id, null ones first and
those of one doc_id by text; with one document, it is its own next. Repeated rows
each give a row. An empty table gives an empty result; other columns are ignored.
Texts are moved once: documents go to buckets by doc_id, and with each bucket goes
the first document of the next. A doc_id is an identifier: rows that share one,
or have none, are one task's.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.components import components
from lakeloom.llm.rows import batches, documents, materialise, ordered_buckets, per_bucket, tasks
from lakeloom.operators.spread import spread_join

#: Common words of English, German, French and Spanish; a parameter of all functions here.
ANCHORS = frozenset(
    "the a an of and to in is was that it for on as with be by are this at from or "
    "der die das den dem des ein eine und zu von mit nicht ist auf für im sich "
    "le la les un une du de et à est que qui dans pour par sur pas "
    "el los las del en y por con no se su para".split()
)
CHAIN = 2
GAP = 6
FEW = 3
_WORD = re.compile(r"[^\W_]+")


def spots(text: str, anchors: frozenset[str] = ANCHORS, chain: int = CHAIN) -> np.ndarray:
    """The hashes of a text's spots, distinct and sorted."""
    if not text:
        return np.zeros(0, np.uint32)
    content: list[str] = []
    heads: list[tuple[str, int]] = []
    words, since = _WORD.findall(text.lower()), 0
    for word in words:
        if word in anchors:
            heads.append((word, len(content)))
            since = 0
        else:
            content.append(word)
            since += 1
            if since > GAP and len(word) % 2:
                heads.append((word, len(content)))
    found = {" ".join((w, *content[at : at + chain])) for w, at in heads if at + chain <= len(content)}
    if len(found) < FEW:
        found |= {" ".join(words[i : i + chain + 1]) for i in range(max(1, len(words) - chain))} if words else {text}
    hash_ = xxhash.xxh32_intdigest
    return np.unique(np.fromiter((hash_(s.encode()) for s in found), np.uint32, len(found)))


def written(of: np.ndarray) -> str:
    return base64.b64encode(of.astype("<u4").tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """The similarity of two sorted sets; 0 where sizes alone show that it is below ``least``."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < least * large:
        return 0.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (small + large - shared)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many of the following text's first, or all of them."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _heads(texts: DataFrame, spark_rows: list) -> DataFrame:
    """The first document of each bucket, filed under the bucket before it; the first of all under the last."""
    spark = texts.sparkSession
    order = sorted(spark_rows, key=lambda r: r["bucket"])
    before = [order[-1]["bucket"], *(r["bucket"] for r in order)]
    firsts = spark.createDataFrame(
        [(r["bucket"], b, r["none"], r["least"]) for r, b in zip(order, before, strict=False)],
        "bucket int, before int, none boolean, least long",
    )
    first = (F.col("doc_id").isNull() & F.col("none")) | (~F.col("none") & F.col("doc_id").eqNullSafe(F.col("least")))
    found = texts.join(F.broadcast(firsts), "bucket").filter(first)  # a row for each bucket
    return found.groupBy(F.col("before").alias("bucket")).agg(F.min("text").alias("text"))


_COLUMNS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def fingerprints_with_edits(docs: DataFrame, anchors: frozenset[str] = ANCHORS, chain: int = CHAIN) -> DataFrame:
    """Each document's fingerprint, its edited text's, and its likeness to that and to the next document.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    bucketed, count = ordered_buckets(documents(docs), "doc_id", tasks(docs), "bucket")
    # a null id, of which bucket 0 has no other, comes before all others
    starts = bucketed.groupBy("bucket").agg(F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("none")).collect()
    if not starts:
        return docs.sparkSession.createDataFrame([], _COLUMNS)
    heads = _heads(bucketed, starts).select(F.lit(None).cast("long").alias("doc_id"), "text", "bucket", F.lit(1).alias("behind"))
    rows = bucketed.select("doc_id", "text", "bucket", F.lit(0).alias("behind")).unionByName(heads)

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # bucket, doc_id, text and spots of the row before
        names = [c.split()[0] for c in _COLUMNS.split(", ")]
        for batch in batches(frames, 500):
            out = []
            columns = (batch.column(c).to_pylist() for c in ("bucket", "doc_id", "text", "behind"))
            for bucket, doc_id, text, behind in zip(*columns, strict=True):
                if last and last[0] == bucket:
                    now = spots(text, anchors, chain)
                    changed = edited(last[2], text)
                    found = spots(changed, anchors, chain)
                    digest = hashlib.sha256(changed.encode()).hexdigest()
                    near, near_next = jaccard(last[3], found), jaccard(last[3], now)
                    out.append((last[1], len(last[2]), digest, written(last[3]), written(found), near, near_next))
                else:
                    now = None
                last = None if behind else (bucket, doc_id, text, spots(text, anchors, chain) if now is None else now)
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=_ARROW)

    # buckets are whole and in order in their partitions; the document behind each comes last
    return per_bucket(rows, "bucket", count, ["behind", "doc_id", "text"]).mapInArrow(run, _COLUMNS)


_ARROW = pa.schema(
    [(c.split()[0], {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[c.split()[1]]) for c in _COLUMNS.split(", ")]
)


def signatures(docs: DataFrame, anchors: frozenset[str] = ANCHORS, chain: int = CHAIN) -> DataFrame:
    """doc_id and the sorted array of spot hashes of every document."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(frames):
            found = [spots(t, anchors, chain).astype(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "spots"])

    return documents(docs).mapInArrow(run, "doc_id long, spots array<long>")


def size_class(size: Column, least: float) -> Column:
    """Sets that can reach the similarity are in the same class or in neighbouring ones: sizes differ by 1 / least at most."""
    return F.floor(F.log(size.cast("double")) / F.log(F.lit(1 / least)) + F.lit(1e-9)).cast("int")


def similar_sets(sets: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of the distinct sets (id, spots) with a Jaccard similarity of ``least`` or more, each once."""
    sized = sets.filter(F.size("spots") > 0).withColumn("n", F.size("spots"))
    single = sized.select("id", "n", F.explode("spots").alias("spot"))
    often = single.groupBy("spot").agg(F.count("*").alias("often"))
    by_rarity = spread_join(single, often, ["spot"], "inner").groupBy("id", "n").agg(
        F.sort_array(F.collect_list(F.struct("often", "spot"))).alias("ordered")
    )
    # two similar sets share one of the rarest n - ceil(least * n) + 1 spots of each; a little more is harmless
    first = F.col("n") - F.ceil(F.col("n") * least - F.lit(1e-9)).cast("int") + 1
    filed = by_rarity.select(
        F.col("id").alias("b"), F.col("n").alias("nb"), size_class(F.col("n"), least).alias("class"), F.posexplode(F.slice("ordered", F.lit(1), first))
    ).select("b", "nb", "class", F.col("pos").alias("pb"), F.col("col.spot").alias("spot"))
    asking = filed.select(
        F.col("b").alias("a"), F.col("nb").alias("na"), F.explode(F.array("class", F.col("class") + 1)).alias("class"), F.col("pb").alias("pa"), "spot"
    )
    smaller = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    needed = (F.col("na") + F.col("nb")) * (least / (1 + least)) - F.lit(1e-9)
    # from this shared spot on, so many more can be shared at most; one shared before it leads to the pair by itself
    room = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    possible = (F.col("na") >= least * F.col("nb") - F.lit(1e-9)) & (room >= needed)
    asked, file = asking.alias("x"), filed.alias("y")
    same = (F.col("x.class") == F.col("y.class")) & (F.col("x.spot") == F.col("y.spot"))
    pairs = asked.join(file, same & smaller & possible).select("a", "b", "na", "nb").distinct()
    left = spread_join(pairs, sized.select(F.col("id").alias("a"), F.col("spots").alias("sa")), ["a"], "inner", by=["a"])
    both = spread_join(left, sized.select(F.col("id").alias("b"), F.col("spots").alias("sb")), ["b"], "inner", by=["b"])
    return both.filter(F.size(F.array_intersect("sa", "sb")) >= needed).select("a", "b")


def similar_documents(docs: DataFrame, least: float = 0.8, anchors: frozenset[str] = ANCHORS, chain: int = CHAIN) -> DataFrame:
    """One row per document: doc_id, class_id (the smallest doc_id that similar pairs lead to) and n_links.

    n_links counts the different signatures similar to the document's own; documents of one signature are one class anyway.
    """
    signed = materialise(signatures(docs, anchors, chain), "signatures")
    sets = signed.groupBy("spots").agg(F.min("doc_id").alias("least_id"))
    sets = materialise(sets.withColumn("id", F.monotonically_increasing_id()), "signature-sets")
    pairs = materialise(similar_sets(sets.select("id", "spots"), least), "similar-pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("n_links"))
    roots = components(pairs).select(F.col("node").alias("id"), "root")
    known = spread_join(spread_join(sets, ends, ["id"], "left"), roots, ["id"], "left").withColumn("root", F.coalesce("root", "id"))
    classes = known.groupBy("root").agg(F.min("least_id").alias("class_id"))
    named = spread_join(known, classes, ["root"], "inner")
    rows = spread_join(signed, named.select("spots", "class_id", "n_links"), ["spots"], "left", by=["doc_id"])
    return rows.select("doc_id", "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
