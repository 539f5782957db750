"""Representatives, signals and base scores of clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressrun.config import AXES, EvaluationConfig
from pressrun.functions.ids import key
from pressrun.functions.text import nonblank, rounded
from pressrun.operators.graph import with_position


def representative_order() -> list[Column]:
    has = lambda c: nonblank(F.col(c)).isNotNull()
    return [F.desc_nulls_last("published_ms"), F.desc_nulls_last("collected_ms"), F.desc(has("title")), F.desc(has("summary")), F.asc("id")]


def ranked_members(items: DataFrame, members: DataFrame, config: EvaluationConfig = EvaluationConfig()) -> DataFrame:
    """The first `max_items` items of each cluster with root and rank; rank 1 represents it.

    A limit on a rank is taken in each task before rows are shuffled, so a cluster of any size sends `max_items` rows a task.
    """
    ranked = items.join(members, "id").withColumn("rank", F.row_number().over(Window.partitionBy("root").orderBy(*representative_order())))
    return ranked.where(F.col("rank") <= max(1, config.max_items))


def representatives(ranked: DataFrame) -> DataFrame:
    return ranked.where("rank = 1")


def supporting(ranked: DataFrame, config: EvaluationConfig = EvaluationConfig()) -> DataFrame:
    return ranked.where((F.col("rank") > 1) & (F.col("rank") <= config.max_items))


SIGNALS = ("item_count", "source_count", "source_diversity", "source_types", "providers")


def signals(items: DataFrame, members: DataFrame) -> DataFrame:
    """root, item_count, source_count, source_diversity, source_types, providers."""
    value = lambda c: nonblank(F.col(c))
    return items.join(members, "id").groupBy("root").agg(
        F.count("*").alias("item_count"), F.count_distinct(value("url")).alias("source_count"), F.count_distinct(value("provider")).alias("source_diversity"),
        F.array_sort(F.collect_set(value("source_type"))).alias("source_types"), F.array_sort(F.collect_set(value("provider"))).alias("providers"),
    )


def breakdown(found: DataFrame) -> DataFrame:
    """kind, name, n: clusters by their set of types and by provider."""
    types = found.groupBy(F.coalesce(nonblank(F.array_join("source_types", "+")), F.lit("(none)")).alias("name")).agg(F.count("*").alias("n"))
    providers = found.select(F.explode("providers").alias("name")).groupBy("name").agg(F.count("*").alias("n"))
    return types.select(F.lit("types").alias("kind"), "name", "n").unionByName(providers.select(F.lit("provider").alias("kind"), "name", "n"))


def complete(scores: dict[str, Column]) -> Column:
    """All five axes are whole numbers from 1 to 5."""
    return F.coalesce(F.forall(F.array(*[scores[a] for a in AXES]), lambda x: x.isNotNull() & (x >= 1) & (x <= 5) & (x == F.floor(x))), F.lit(False))


def base_score(scores: dict[str, Column], weights: dict[str, float]) -> Column:
    total = sum((F.lit(weights[a]) * scores[a] for a in AXES[1:]), F.lit(weights[AXES[0]]) * scores[AXES[0]])
    return F.when(complete(scores), rounded(total))


def evaluation_order(clusters: DataFrame) -> DataFrame:
    """pos: clusters of several items first, then diversity, size, newest, id."""
    order = [F.desc(F.col("item_count") > 1), F.desc("source_diversity"), F.desc("item_count"), F.desc_nulls_last("published_ms"), F.asc("cluster_id")]
    return with_position(clusters, order)


def cache_key(cluster: Column, model: str, version: str) -> Column:
    return key(cluster, F.lit(model), F.lit(version))


def mismatches(stated: DataFrame, items: DataFrame, members: DataFrame) -> DataFrame:
    """root, faults: the clusters whose stated signals differ from recomputed ones, and which; a cluster that one side lacks has all of them."""
    again = signals(items, members).withColumn("there", F.lit(True))
    both = stated.select("root", *[F.col(c).alias(f"stated_{c}") for c in SIGNALS], F.lit(True).alias("said")).join(again, "root", "full_outer")
    lone = F.col("there").isNull() | F.col("said").isNull()
    faults = F.filter(F.array(*[F.when(lone | ~F.col(f"stated_{c}").eqNullSafe(F.col(c)), F.lit(c)) for c in SIGNALS]), lambda x: x.isNotNull())
    return both.select("root", faults.alias("faults")).where(F.size("faults") > 0)
