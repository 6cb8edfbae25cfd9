"""Connected components of links that no one machine could hold.

Each task first reduces the links of its partition to a forest, with the smallest
node of each of its trees as root. The rest is the large-star and small-star
iteration (Kiveris and others, 2014): each round ties every node's neighbours to
its smallest neighbour, until every node hangs on its component's smallest
one. Rounds are few (a logarithm of the size) and each is written to the shared
folder, so lost executors cost one round at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.rows import materialise
from lakeloom.operators.spread import spread_join

_LINK = "a long, b long"


def _forest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = root[up]
        return x

    for frame in frames:
        for a, b in zip(frame["a"].tolist(), frame["b"].tolist(), strict=True):
            one, two = find(a), find(b)
            if one != two:
                root[max(one, two)] = min(one, two)
    hang = [(x, find(x)) for x in list(root)]
    yield pd.DataFrame([p for p in hang if p[0] != p[1]], columns=["a", "b"], dtype="int64")


def _smallest(links: DataFrame) -> DataFrame:
    """For each a the least of itself and its b."""
    return links.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    tied = spread_join(both, _smallest(both), ["a"], "inner")
    return tied.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """links: a > b."""
    tied = spread_join(links, _smallest(links), ["a"], "inner")
    onto = tied.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return onto.unionByName(tied.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b) but the roots; a root is its component's smallest node."""
    ahead = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = materialise(ahead.mapInPandas(_forest, _LINK), "links")
    while True:
        # stars: no node that hangs on another has one hanging on itself, and each hangs on one
        parents = now.select(F.col("b").alias("a")).distinct()
        chained = now.join(parents, "a", "left_semi").select("a")
        twice = now.groupBy("a").count().filter("count > 1").select("a")
        if chained.unionByName(twice).isEmpty():
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        now = materialise(_small_star(_large_star(now)), "links")
