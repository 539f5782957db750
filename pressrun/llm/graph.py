"""Connected components by union-find inside partitions and star contraction between them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressrun.llm._base import join_hot, materialize


def forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges (u, v) of one partition to (node, least node of its tree), by union-find."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for u, v in zip(batch["u"].tolist(), batch["v"].tolist()):
            a, b = find(u), find(v)
            parent.setdefault(u, a)
            parent.setdefault(v, b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if find(x) != x]
    yield pd.DataFrame({"u": [find(x) for x in nodes], "v": nodes}, dtype="int64")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component (least node reachable) of every node of edges (u, v: long).

    Each round links every node's larger neighbours to its least neighbour, then every node's smaller ones
    (large-star and small-star); it ends when no edge changes. Joins on a node split off the hot ones.
    """
    now = materialize(edges.where("u <> v").mapInPandas(forest, "u long, v long").distinct(), "stars")
    before = None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n"))
        total = 2 * now.count()
        if not total:
            break
        large = join_hot(both, least, "u", "n", total).where("v > u").select(F.col("m").alias("u"), "v").where("u <> v").distinct()
        large = materialize(large, "stars")
        # Small-star: neighbours not above a node, and itself, go to the least of them.
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        met = join_hot(down, least, "u", "n", down.count())
        small = met.select(F.col("m").alias("u"), "v").where("u <> v").unionByName(least.select(F.col("m").alias("u"), F.col("u").alias("v"))).distinct()
        now = materialize(small, "stars")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    stars = now.select(F.col("v").alias("node"), F.col("u").alias("component"))
    return stars.unionByName(now.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
