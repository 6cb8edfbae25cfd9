"""Merging a change batch into a target, as DataFrame joins.

``update_when`` is a SQL condition over the aliases ``source`` and ``target``,
for example ``source.updated_at > target.updated_at``; ``None`` means always.
A condition that is null on either side counts as false, and null keys never
match.

Both sides are shaped for a batch much smaller than its target. Every join that
reads the target keeps it on the streamed side, so Spark can broadcast the batch
when its size is under the broadcast threshold, and the target is then not
shuffled at all. A larger batch falls back to sort-merge joins whose skewed
partitions AQE can split (see ``spread``), as it cannot for a full outer join.
Given ``batch_rows``, the number of its rows, target rows without a partner are
kept out of these joins, and of their shuffles, by a filter of the batch's keys
(see ``key_filter``); batches too large for one are joined as before.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.key_filter import batch_filter
from lakeloom.operators.spread import SPREAD, spread_join, with_spread

ACTION = "merge_action"
_HIT = "__hit"
_REPLACE = "__replace"


def conform(source: DataFrame, target: DataFrame) -> DataFrame:
    """``source`` with exactly the target's columns, in its order and types."""
    missing = [name for name in target.columns if name not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    return source.select(
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields)
    )


def _paired(
    target: DataFrame, source: DataFrame, keys: Sequence[str], how: str, by: Sequence[str] | None
) -> DataFrame:
    """Target and source joined on the keys, under the aliases of a condition."""
    t = with_spread(target, keys, by).alias("target")
    s = with_spread(source, keys, keys).alias("source")
    on = (F.col(f"target.{k}") == F.col(f"source.{k}") for k in (*keys, SPREAD))
    return t.join(s, reduce(and_, on), how)


def _condition(update_when: str | None) -> Column:
    if update_when is None:
        return F.lit(True)
    return F.coalesce(F.expr(update_when), F.lit(False))


def _possible(
    target: DataFrame, source: DataFrame, keys: Sequence[str], batch_rows: int | None
) -> DataFrame:
    """The target without rows that surely have no partner in a batch of ``batch_rows`` rows."""
    held = None if batch_rows is None else batch_filter(target, source, keys, batch_rows)
    return target if held is None else target.where(held)


def unmatched(
    source: DataFrame, target: DataFrame, keys: Sequence[str], batch_rows: int | None = None
) -> DataFrame:
    """Source rows whose key the target does not hold.

    The target's keys are first cut down to those of the batch; an anti-join
    against the whole target would have to shuffle it.
    """
    keys = list(keys)
    target = _possible(target, source, keys, batch_rows)
    matched = spread_join(
        target.select(*keys), source.select(*keys), keys, "left_semi", by=keys
    ).distinct()
    return spread_join(source, matched, keys, "left_anti").select(*source.columns)


def new_rows(
    target: DataFrame, source: DataFrame, keys: Sequence[str], batch_rows: int | None = None
) -> DataFrame:
    """The same for a batch that is too large to broadcast: one join, for which
    the target's keys are shuffled once."""
    keys = list(keys)
    held = _possible(target, source, keys, batch_rows).select(*keys)
    return spread_join(source, held, keys, "left_anti").select(*source.columns)


def insert_only(
    target: DataFrame, source: DataFrame, keys: Sequence[str], batch_rows: int | None = None
) -> DataFrame:
    """Target rows untouched, plus source rows with a new key."""
    source = conform(source, target)
    return target.unionByName(unmatched(source, target, keys, batch_rows))


def update_matched(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_when: str | None = None,
    batch_rows: int | None = None,
) -> DataFrame:
    """Target rows, each replaced by its source row where the condition holds.

    With ``batch_rows`` the target is scanned twice: for rows that may have a partner, and for the others,
    which reach the result without a join.
    """
    hits = conform(source, target)
    held = None if batch_rows is None else batch_filter(target, hits, keys, batch_rows)
    if held is not None:
        near = _replaced(target.where(held), hits, keys, update_when)
        return near.unionByName(target.where(~held))
    return _replaced(target, hits, keys, update_when)


def _replaced(
    target: DataFrame, hits: DataFrame, keys: Sequence[str], update_when: str | None
) -> DataFrame:
    joined = _paired(target, hits.withColumn(_HIT, F.lit(True)), keys, "left", by=None)
    replace = F.col(f"source.{_HIT}").isNotNull() & _condition(update_when)
    picked = joined.withColumn(_REPLACE, replace)
    return picked.select(
        *(
            F.when(F.col(_REPLACE), F.col(f"source.{name}"))
            .otherwise(F.col(f"target.{name}"))
            .alias(name)
            for name in target.columns
        )
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_when: str | None = None,
    large_batch: bool = False,
    batch_rows: int | None = None,
) -> DataFrame:
    """The merged table: updated and kept target rows, plus new source rows.

    Source keys must be unique (see ``duplicate_keys``).

    large_batch: one full join, which computes either side once but shuffles the
                 whole target: for a batch of about the target's size whose keys
                 are unique there too, so that no key can be hot.
    batch_rows:  how many rows the batch has, to filter the target by its keys.
    """
    source = conform(source, target)
    if large_batch:
        return _full_merge(target, source, keys, update_when)
    return update_matched(target, source, keys, update_when, batch_rows).unionByName(
        unmatched(source, target, keys, batch_rows)
    )


def _full_merge(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update_when: str | None
) -> DataFrame:
    """Rows without a key match nothing and would all meet in one task: they stay out of the join."""
    keyed = reduce(and_, (F.col(k).isNotNull() for k in keys))
    t = target.where(keyed).withColumn(_HIT, F.lit(True)).alias("target")
    s = source.where(keyed).withColumn(_HIT, F.lit(True)).alias("source")
    on = reduce(and_, (F.col(f"target.{k}") == F.col(f"source.{k}") for k in keys))
    take = F.col(f"target.{_HIT}").isNull() | (
        F.col(f"source.{_HIT}").isNotNull() & _condition(update_when)
    )
    joined = t.join(s, on, "full").withColumn(_REPLACE, take)
    merged = joined.select(
        *(
            F.when(F.col(_REPLACE), F.col(f"source.{c}")).otherwise(F.col(f"target.{c}")).alias(c)
            for c in target.columns
        )
    )
    return merged.unionByName(target.where(~keyed)).unionByName(source.where(~keyed))


def update_candidates(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update_when: str | None = None
) -> DataFrame:
    """Source rows that would replace a target row."""
    joined = _paired(target, source, keys, "inner", by=keys)
    return joined.where(_condition(update_when)).select(
        *(F.col(f"source.{name}") for name in source.columns)
    )


def classify(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_when: str | None = None,
    batch_rows: int | None = None,
) -> DataFrame:
    """Source rows plus ``merge_action``: ``insert``, ``update`` or ``none``.

    Reads only the target's keys and the columns the condition names.
    """
    keys = list(keys)
    target = _possible(target, source, keys, batch_rows)
    pairs = _paired(target, source, keys, "inner", by=keys)
    hits = (
        pairs.select(
            *(F.col(f"source.{k}").alias(k) for k in keys),
            _condition(update_when).alias(_REPLACE),
        )
        .groupBy(*keys)
        .agg(F.bool_or(_REPLACE).alias(_REPLACE))
    )
    action = (
        F.when(F.col(_REPLACE).isNull(), F.lit("insert"))
        .when(F.col(_REPLACE), F.lit("update"))
        .otherwise(F.lit("none"))
    )
    return spread_join(source, hits, keys, "left").select(*source.columns, action.alias(ACTION))


def upsert_summary(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update_when: str | None = None
) -> DataFrame:
    """One row of reconciliation counts of a merge, without doing it."""
    actions = classify(target, source, keys, update_when)
    counts = actions.agg(
        F.count(F.lit(1)).alias("incoming_count"),
        F.count_if(F.col(ACTION) == "update").alias("update_count"),
        F.count_if(F.col(ACTION) == "insert").alias("insert_count"),
    )
    before = target.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.withColumn("before_count", before).select(
        "before_count",
        "incoming_count",
        "update_count",
        "insert_count",
        (F.col("before_count") + F.col("insert_count")).alias("after_count"),
        (F.col("insert_count") + F.col("update_count")).alias("row_count"),
    )


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; rows with a null key part are left out."""
    whole = reduce(and_, (F.col(k).isNotNull() for k in keys))
    counted = source.where(whole).groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
    return counted.where(F.col("occurrences") > 1)
