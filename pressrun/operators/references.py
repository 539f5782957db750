"""The lane of media references: eligible items, normal media, a partition by value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressrun.config import ReferenceConfig
from pressrun.functions.text import nonblank
from pressrun.functions.url import media_url

# Roles of a picture in their order, and media types.
ROLES = ("evidence", "reference", "diagram", "artwork", "screenshot", "photo", "production-material", "other")
MEDIA_TYPES = ("image", "video", "gif", "unknown")


def visual_value(value: Column, roles: Column) -> Column:
    return F.when(_visual_ok(value, roles), value)


def _visual_ok(value: Column, roles: Column) -> Column:
    return roles.isNotNull() & F.coalesce(value.between(1, 5), F.lit(True)) & F.forall(roles, lambda r: F.coalesce(r.isin(*ROLES), F.lit(False)))


def visual_roles(value: Column, roles: Column) -> Column:
    """In order, once each; `other` only alone; none if any part is invalid."""
    known = F.filter(F.array(*[F.lit(r) for r in ROLES]), lambda r: F.array_contains(roles, r))
    clean = F.when(F.size(known) > 1, F.filter(known, lambda r: r != "other")).otherwise(known)
    return F.when(_visual_ok(value, roles), clean).otherwise(F.array().cast("array<string>"))


def media(entries: Column) -> Column:
    """Entries with a usable URL; unknown types and odd dimensions are neutral."""
    size = lambda x: F.when(x > 0, x)
    normal = F.transform(F.coalesce(entries, F.array().cast("array<struct<type:string,url:string,previewUrl:string,altText:string,width:int,height:int>>")), lambda m: F.struct(
        F.when(m["type"].isin(*MEDIA_TYPES), m["type"]).otherwise("unknown").alias("type"), media_url(m["url"]).alias("url"), media_url(m["previewUrl"]).alias("previewUrl"),
        m["altText"].alias("altText"), size(m["width"]).alias("width"), size(m["height"]).alias("height"),
    ))
    return F.filter(normal, lambda m: m["url"].isNotNull() | m["previewUrl"].isNotNull())


def vision(v: Column) -> Column:
    return F.when((v["status"] == "ok") & nonblank(v["observations"]).isNotNull(), F.struct(v["status"].alias("status"), v["observations"].alias("observations"), v["visibleText"].alias("visibleText")))


def candidates(items: DataFrame, config: ReferenceConfig = ReferenceConfig()) -> DataFrame:
    """items: id, source_type, value, roles, media. Eligible rows in normal form."""
    rows = items.where("source_type = 'x'").withColumns({"norm_value": visual_value(F.col("value"), F.col("roles")), "norm_roles": visual_roles(F.col("value"), F.col("roles")), "norm_media": media(F.col("media"))})
    kept = rows.where((F.col("norm_value") >= config.threshold) & (F.size("norm_media") > 0))
    return kept.drop("value", "roles", "media").withColumnsRenamed({"norm_value": "value", "norm_roles": "roles", "norm_media": "media"})


def selection(found: DataFrame, config: ReferenceConfig = ReferenceConfig()) -> DataFrame:
    main = F.col("value") >= config.primary
    return found.withColumn("selection", F.when(main, "selected").otherwise("secondary")).withColumn("reason", F.when(main, "meets-primary-threshold").otherwise("below-primary-threshold"))


def stats(selected: DataFrame) -> DataFrame:
    return selected.agg(
        F.count("*").alias("input_candidates"), F.count_if(F.col("selection") == "selected").alias("selected"), F.count_if(F.col("selection") == "secondary").alias("secondary"),
        F.count_if(F.array_contains("roles", "evidence")).alias("evidence"),
    )
