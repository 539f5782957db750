"""Clusters: components of the edges that may form one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressrun.config import ClusterConfig
from pressrun.functions.ids import cluster_id
from pressrun.operators.graph import components, join_groups, stored
from pressrun.operators.naming import list_digests
from pressrun.operators.similarity import members, title_ties


def forming_edges(items: DataFrame, config: ClusterConfig = ClusterConfig(), similar: DataFrame | None = None) -> DataFrame:
    """a, b. Equal values are linked to the least item that has them, and of similar titles only as many pairs are taken as connect them: the same components
    as all pairs. similar: `similar_titles` of the items, where they are known."""
    titled = items.withColumn("title_long", F.when(F.length("title_norm") >= config.same_title_min_length, F.col("title_norm")))
    stars = []
    for column in ("url_norm", "title_long"):
        stars.append(members(titled, column).where("id <> class_id").select(F.col("class_id").alias("a"), F.col("id").alias("b")))
    similar = title_ties(items, config) if similar is None else similar
    return stars[0].unionByName(stars[1]).unionByName(similar.select(F.col("item_a").alias("a"), F.col("item_b").alias("b")))


def membership(items: DataFrame, edges: DataFrame) -> DataFrame:
    """id, root, of every item."""
    return stored(components(items.select("id"), edges))


def clusters(members: DataFrame) -> DataFrame:
    """cluster_id, item_count, root of each cluster; the id is the hash of its sorted item ids, which no row holds together."""
    return list_digests(members, "\n").select(F.concat(F.lit("cluster:"), "sha").alias("cluster_id"), F.col("n").alias("item_count"), "root")


def named_members(members: DataFrame, found: DataFrame) -> DataFrame:
    """id, cluster_id, item_count, root of every member. found: `clusters` of them."""
    return join_groups(members.select("id", "root"), stored(found.select("root", "cluster_id", "item_count")), "root", "item_count", members.count())


def listed(members: DataFrame) -> DataFrame:
    """cluster_id, item_ids (sorted), item_count, root: a row holds a cluster, as the documents of a run do."""
    grouped = members.groupBy("root").agg(F.array_sort(F.collect_list("id")).alias("item_ids"))
    return grouped.select(cluster_id(F.col("item_ids")).alias("cluster_id"), "item_ids", F.size("item_ids").cast("long").alias("item_count"), "root")


def violations(items: DataFrame, members: DataFrame) -> DataFrame:
    """Rows that break an invariant: an item in no cluster or several, a member that is no item."""
    lost = items.select("id").join(members, "id", "left_anti").select("id", F.lit("unassigned").alias("rule"))
    extra = members.select("id").join(items, "id", "left_anti").select("id", F.lit("unknown").alias("rule"))
    twice = members.groupBy("id").count().where("count > 1").select("id", F.lit("duplicate").alias("rule"))
    return lost.unionByName(extra).unionByName(twice)


def stats(links: DataFrame, found: DataFrame) -> DataFrame:
    """name, n: clusters by kind and relationships by type, zeros included. links: type, n_links."""
    kinds = found.agg(F.count("*").alias("clusters"), F.count_if(F.col("item_count") > 1).alias("multi"), F.count_if(F.col("item_count") == 1).alias("single"), F.coalesce(F.sum("item_count"), F.lit(0)).alias("items"))
    types = links.agg(*[F.coalesce(F.sum(F.when(F.col("type") == t, F.col("n_links"))), F.lit(0)).alias(t) for t in ("same-url", "same-title", "title-similarity")])
    unpivot = lambda df: df.unpivot([], df.columns, "name", "n")
    return unpivot(kinds.select(*[F.col(c).cast("long") for c in kinds.columns])).unionByName(unpivot(types))
