"""A Bloom filter of a batch's keys, asked in the scan of a merge's target.

A batch over Spark's broadcast threshold means a sort-merge join, for which the
whole target would be shuffled though most of its rows have no partner. The
filter is an array of 64-bit words made of the batch's keys: a key's hash names
one word and a few bits of it, so building is one aggregation and asking reads
one word. The target's rows are hashed where they are scanned, and only those
that may be in the batch go to the join. The array is a scalar subquery over
built-in functions, computed by the same query and asked inside generated code.
A filter never turns a key of the batch away, so a merge's result is the same
with it.

Its size is bounded: ``BITS_PER_KEY`` bits for each row of the batch, rounded up
to a power of two, and ``MOST_BITS`` at most. A larger batch has no filter, and
its merge is the plain join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Some two rows in a hundred pass without being in the batch.
BITS_PER_KEY = 10
#: 16 MB, for batches of up to 13 million rows.
MOST_BITS = 1 << 27
#: Bits of a word that a key sets. Its hash gives six binary digits for each, and those above tell the word.
BITS_SET = 4
_BLOCK = 1 << 12  # words brought together first


def filter_bits(rows: int) -> int | None:
    """The size of the filter for a batch of ``rows`` rows, or None if it would be too large."""
    bits = 1 << max(12, (max(rows, 1) * BITS_PER_KEY - 1).bit_length())
    return bits if bits <= MOST_BITS else None


def can_filter(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> bool:
    """Equal keys must hash alike: they have one type on both sides, and no two writings of a value."""
    several = (T.FloatType, T.DoubleType, T.ArrayType, T.MapType, T.StructType, T.VariantType)

    def plain(k: str) -> bool:
        kind = target.schema[k].dataType
        return kind == source.schema[k].dataType and not isinstance(kind, several)

    return all(map(plain, keys))


def _place(keys: Sequence[str], bits: int) -> tuple[Column, Column]:
    """The word that a key is in, and the bits that it sets there."""
    hashed = F.xxhash64(*keys)
    one = F.lit(1).cast("long")
    steps = (F.shiftright(hashed, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(BITS_SET))
    mask = reduce(Column.bitwiseOR, (F.call_function("shiftleft", one, step) for step in steps))
    return F.shiftright(hashed, 6 * BITS_SET).bitwiseAND(F.lit(bits // 64 - 1)), mask


def key_words(source: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """One row: the filter's words, of which there are ``bits`` / 64. Rows with a null in their key are left out."""
    whole = source.where(reduce(and_, (F.col(k).isNotNull() for k in keys)))
    word, mask = _place(keys, bits)
    # words without a key are zero; an empty batch has a filter too
    every = source.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    known = whole.select(word.alias("word"), mask.alias("bits")).unionByName(every)
    words = known.groupBy("word").agg(F.bit_or("bits").alias("bits"))
    # in order: first within blocks, then the blocks, so that no task sorts more than some thousand items
    pairs = F.sort_array(F.collect_list(F.struct("word", "bits")))
    in_block = F.floor(F.col("word") / _BLOCK).alias("block")
    block = words.groupBy(in_block).agg(F.transform(pairs, lambda x: x["bits"]).alias("part"))
    parts = F.sort_array(F.collect_list(F.struct("block", "part")))
    return block.agg(F.flatten(F.transform(parts, lambda x: x["part"])).alias("words"))


def may_hold(words: Column, keys: Sequence[str], bits: int) -> Column:
    """Whether a row's key may be in the filter; never null. ``words`` is the scalar subquery of ``key_words``."""
    word, mask = _place(keys, bits)
    unset = F.bitwise_not(F.get(words, word.cast("int"))).bitwiseAND(mask)
    return F.coalesce(unset == 0, F.lit(False))


def batch_filter(target: DataFrame, source: DataFrame, keys: Sequence[str], rows: int) -> Column | None:
    """The condition that a target row may have a partner in a batch of ``rows`` rows, or None where there can be no filter."""
    bits = filter_bits(rows)
    if bits is None or not can_filter(target, source, keys):
        return None
    return may_hold(key_words(source, keys, bits).scalar(), list(keys), bits)
