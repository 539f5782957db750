"""Stable ids and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressrun.functions.text import nonblank, trimmed

SEPARATOR = "\x1f"


def compact_id(c: Column) -> Column:
    """As it is if short and safe, else its SHA-256."""
    t = trimmed(c)
    return F.when((F.length(t) <= 180) & t.rlike(r"^[\w.:/?#@&=+\-%,~]+$"), t).otherwise(F.sha2(t.cast("binary"), 256))


def original_id(guid: Column, url: Column) -> Column:
    return F.coalesce(nonblank(guid), nonblank(url))


def web_id(provider: Column, original: Column) -> Column:
    return F.concat(F.lit("web:"), provider, F.lit(":"), compact_id(original))


def cluster_id(item_ids: Column) -> Column:
    """item_ids: sorted."""
    return F.concat(F.lit("cluster:"), F.sha2(F.array_join(item_ids, "\n").cast("binary"), 256))


def group_id(cluster_ids: Column) -> Column:
    return F.concat(F.lit("rel:"), F.substring(F.sha2(F.array_join(F.array_sort(cluster_ids), "|").cast("binary"), 256), 1, 16))


def key(*parts: Column) -> Column:
    """SHA-256 of the parts; null counts as empty."""
    return F.sha2(F.array_join(F.array(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), SEPARATOR).cast("binary"), 256)


def content_hash(item_id: Column, title: Column, summary: Column, category: Column, published: Column) -> Column:
    return key(item_id, title, summary, category, published)
