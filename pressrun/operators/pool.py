"""Union of feeds into one pool, its order, checks and counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressrun.operators.graph import with_position


def union(*feeds: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def with_provenance(feed: DataFrame, input_id: str, path: str, generated_at: str) -> DataFrame:
    return feed.withColumns({"input_id": F.lit(input_id), "input_path": F.lit(path), "input_generated_at": F.lit(generated_at)})


def duplicate_ids(pool: DataFrame, by: tuple[str, ...] = ("id",)) -> DataFrame:
    return pool.groupBy(*by).agg(F.count("*").alias("n")).where("n > 1")


def newest_first(id_col: str = "id") -> list:
    return [F.desc_nulls_last("published_ms"), F.desc_nulls_last("collected_ms"), F.asc(id_col)]


def ordered(pool: DataFrame) -> DataFrame:
    """pos: the place in the pool."""
    return with_position(pool, newest_first())


def count_by(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(F.col(column)).agg(F.count("*").alias("n"))


def stats(pool: DataFrame) -> DataFrame:
    """One pass: totals by type, by provider and overall."""
    sets = pool.groupingSets([["source_type"], ["provider"], []], "source_type", "provider")
    counted = sets.agg(F.count("*").alias("n"), F.grouping("source_type").alias("gt"), F.grouping("provider").alias("gp"))
    kind = F.when(F.col("gt") == 0, "type").when(F.col("gp") == 0, "provider").otherwise("total")
    return counted.select(kind.alias("kind"), F.coalesce("source_type", "provider", F.lit("(all)")).alias("name"), "n")
