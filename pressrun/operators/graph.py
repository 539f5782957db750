"""Stored tables, joins with groups of any size, positions in a total order, connected components."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A group with at least 1/HOT_SHARE of all rows is hot; so there are at most HOT_SHARE of them.
HOT_SHARE = 512


def stored(df: DataFrame) -> DataFrame:
    """df written to the folder in spark.checkpoint.dir and read again; a temporary one only in a session of one process that names none."""
    spark: SparkSession = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_groups(rows: DataFrame, groups: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """rows with the one row of their group. Hot groups, HOT_SHARE at most, are broadcast, so that their rows are not shuffled."""
    least = max(2, -(-total // HOT_SHARE))
    hot, cold = groups.where(F.col(count) >= least), groups.where(F.col(count) < least)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(rest.join(cold, key))


def frequent_keys(rows: DataFrame, key: str, total: int) -> DataFrame:
    """The keys with at least 1/HOT_SHARE of `total` rows."""
    return rows.groupBy(key).agg(F.count("*").alias("rows_of_key")).where(F.col("rows_of_key") >= max(2, -(-total // HOT_SHARE))).select(key)


def join_split(rows: DataFrame, table: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """rows with the one row of `table` for their key. hot: the frequent keys, HOT_SHARE at most, whose rows stay where they are."""
    first = rows.join(F.broadcast(table.join(F.broadcast(hot), key, "left_semi")), key)
    return first.unionByName(rows.join(F.broadcast(hot), key, "left_anti").join(table, key))


def with_position(df: DataFrame, order: list[Column], name: str = "pos") -> DataFrame:
    """df with the place of each row in a total order, from 1. Rows are sorted in ranges, and ranges are offset by their counts."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    row = "row_in_range"
    sorted_ = stored(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn(row, F.monotonically_increasing_id()))
    span = F.shiftright(row, 33)
    counts = sorted_.groupBy(span.alias("range_no")).agg(F.count("*").alias("c"))
    before = counts.select("range_no", (F.sum("c").over(Window.orderBy("range_no")) - F.col("c")).alias("earlier"))  # a row a range
    place = F.col("earlier") + F.col(row).bitwiseAND((1 << 33) - 1) + 1
    return sorted_.withColumn("range_no", span).join(F.broadcast(before), "range_no").withColumn(name, place.cast("long")).drop("range_no", "earlier", row)


def components(nodes: DataFrame, edges: DataFrame, rounds: int = 100) -> DataFrame:
    """nodes: id. edges: a, b. Returns id, root: the least id reachable.

    Each round takes the least label among neighbours and then the label of that label, so a chain of n nodes
    settles in about log n rounds. Only nodes with edges take part. Nodes with many edges, and labels of many nodes, are
    looked up by broadcast, so the centre of a star is no task of its own.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    total = both.count()
    centres = stored(frequent_keys(both, "b", total))
    label = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("root")))
    for _ in range(rounds):
        near = join_split(both, label.withColumnRenamed("id", "b"), "b", centres).groupBy("a").agg(F.min("root").alias("m"))
        lower = stored(label.join(near, F.col("id") == F.col("a")).select("id", F.least("root", "m").alias("root"), F.col("root").alias("old")))
        jump = lower.select(F.col("id").alias("root"), F.col("root").alias("far"))  # a root is a node with edges, or itself
        new = stored(join_split(lower, jump, "root", frequent_keys(lower, "root", total)).select("id", F.least("root", "far").alias("root"), "old"))
        label = new.select("id", "root")
        if not new.where("root <> old").limit(1).count():
            break
    else:
        raise RuntimeError("components did not settle")
    return nodes.select("id").join(label, "id", "left").select("id", F.coalesce("root", "id").alias("root"))
