"""Validation as rows: one row for each broken rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressrun.config import FreshnessConfig
from pressrun.errors import ValidationError
from pressrun.functions.text import nonblank
from pressrun.functions.time import strict
from pressrun.schema import SCORE_NAMES


def broken(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """key, rule, for every rule (a condition that must hold) that a row breaks; null counts as broken."""
    failed = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]), lambda x: x.isNotNull())
    return rows.select(F.col(key).cast("string").alias("key"), F.explode(failed).alias("rule"))


def item_rules() -> dict[str, Column]:
    """For items of the nested model."""
    return {
        "id": nonblank(F.col("id")).isNotNull(),
        "source": F.col("source").isNotNull(),
        "source-type": nonblank(F.col("source.type")).isNotNull(),
        "source-provider": nonblank(F.col("source.provider")).isNotNull(),
        "scores": F.col("scores").isNotNull(),
        "scores-finite": F.forall(F.array(*[F.col(f"scores.{s}") for s in SCORE_NAMES]), lambda x: x.isNull() | ~(F.isnan(x) | (F.abs(x) == float("inf")))),
    }


#: Top-level and item fields that a feed must have.
FEED_FIELDS = ("schemaVersion", "source", "generatedAt", "scope", "items")
ITEM_FIELDS = ("id", "title", "summary", "category", "sourceType", "sourceUrl", "postedAt", "collectedAt", "author", "scores")
TEXT_FIELDS = ("title", "summary", "category", "sourceType", "sourceUrl", "postedAt", "collectedAt")


def raw_feed_faults(raw: DataFrame, source: str, version: int = 1) -> DataFrame:
    """at (place of the item, null for the document), rule: what is wrong with feeds as they came. raw: value, one JSON text a row.

    Types are those of the JSON, before any schema is laid over it.
    """
    doc = raw.select(F.try_parse_json("value").alias("v"))
    kind = lambda path: F.schema_of_variant(F.try_variant_get("v", path, "variant"))
    text = lambda path: F.try_variant_get("v", path, "string")
    whole = F.try_variant_get("v", "$.scope.itemCount", "double")
    size = F.size(F.try_variant_get("v", "$.items", "array<variant>"))
    rules = {"object": F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))} | {f"field-{n}": kind(f"$.{n}").isNotNull() for n in FEED_FIELDS}
    rules |= {
        "schema-version": F.try_variant_get("v", "$.schemaVersion", "double") == version,
        "source": text("$.source") == source,
        "generated-at": (kind("$.generatedAt") == "STRING") & nonblank(text("$.generatedAt")).isNotNull(),
        "scope": kind("$.scope").startswith("OBJECT"),
        "item-count": (whole >= 0) & (whole == F.floor(whole)),
        "items": kind("$.items").startswith("ARRAY"),
        "item-count-matches": whole == size,
    }
    failed = lambda r: F.explode(F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in r.items()]), lambda x: x.isNotNull()))
    top = doc.select(F.lit(None).cast("int").alias("at"), failed(rules).alias("rule"))
    items = doc.select(F.posexplode(F.try_variant_get("v", "$.items", "array<variant>")).alias("at", "v"))
    nothing = lambda path: F.coalesce(kind(path) == "VOID", F.lit(True))
    rules = {"item-object": F.schema_of_variant("v").startswith("OBJECT")} | {f"item-field-{n}": kind(f"$.{n}").isNotNull() for n in ITEM_FIELDS}
    rules |= {"item-id": (kind("$.id") == "STRING") & nonblank(text("$.id")).isNotNull()} | {f"item-text-{n}": nothing(f"$.{n}") | (kind(f"$.{n}") == "STRING") for n in TEXT_FIELDS}
    rules |= {"item-source-type": nothing("$.sourceType") | (text("$.sourceType") == "x")} | {f"item-object-{n}": nothing(f"$.{n}") | kind(f"$.{n}").startswith("OBJECT") for n in ("author", "scores")}
    rules |= {f"item-author-{n}": nothing(f"$.author.{n}") | (kind(f"$.author.{n}") == "STRING") for n in ("name", "handle")}
    rules |= {f"item-score-{n}": nothing(f"$.scores.{n}") | kind(f"$.scores.{n}").rlike("^(BIGINT|DOUBLE|DECIMAL.*)$") for n in SCORE_NAMES}
    each = items.select("at", failed(rules).alias("rule"))
    ids = items.select("at", text("$.id").alias("id")).where("id IS NOT NULL")
    again = ids.groupBy("id").agg(F.min("at").alias("first"))
    twice = ids.join(again, "id").where("at > first").select("at", F.lit("item-duplicate").alias("rule"))
    return top.unionByName(each).unionByName(twice)


def feed_rules(source: str) -> dict[str, Column]:
    """For a whole feed document, one row, in the order in which they are reported."""
    return {
        "schema-version": F.col("schemaVersion") == 1,
        "source": F.col("source") == source,
        "generated-at": nonblank(F.col("generatedAt")).isNotNull(),
        "items": F.col("items").isNotNull(),
        "item-count": F.col("scope.itemCount") == F.size("items"),
        "item-ids": F.forall("items", lambda x: nonblank(x["id"]).isNotNull()),
        "unique-ids": F.size(F.array_distinct(F.transform("items", lambda x: x["id"]))) == F.size("items"),
        "source-types": F.forall("items", lambda x: F.coalesce(x["sourceType"] == "x", F.lit(True))),
    }


def cluster_rules() -> dict[str, Column]:
    """For clusters that evaluation reads: cluster_id, item_ids."""
    return {
        "cluster-id": nonblank(F.col("cluster_id")).isNotNull(),
        "items": F.size("item_ids") >= 1,
        "item-ids": F.forall("item_ids", lambda x: nonblank(x).isNotNull()),
        "unique-items": F.size(F.array_distinct("item_ids")) == F.size("item_ids"),
    }


def selected_rules() -> dict[str, Column]:
    """For selected clusters that the digest reads: cluster_id, rank."""
    return {"cluster-id": nonblank(F.col("cluster_id")).isNotNull(), "rank": F.col("rank") >= 1}


def reference_rules(roles: tuple[str, ...], threshold: int) -> dict[str, Column]:
    """For references that selection reads: id, value, roles, media."""
    return {
        "id": nonblank(F.col("id")).isNotNull(),
        "value": F.col("value").between(threshold, 5),
        "roles": F.forall("roles", lambda r: F.coalesce(r.isin(*roles), F.lit(False))),
        "media": F.size("media") >= 1,
    }


def repeated(rows: DataFrame, key: str) -> DataFrame:
    """key, rule of every value of key in several rows."""
    return rows.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("key")).agg(F.count("*").alias("n")).where("n > 1").select("key", F.lit("duplicate").alias("rule"))


def stage_input(rows: DataFrame, rules: dict[str, Column], key: str = "cluster_id", least: int = 0) -> DataFrame:
    """Everything that is wrong with a stage's input: broken rules, repeated keys, too few rows."""
    few = rows.agg(F.count("*").alias("n")).where(F.col("n") < least).select(F.lit(None).cast("string").alias("key"), F.lit("empty").alias("rule"))
    return broken(rows, key, rules).unionByName(repeated(rows, key)).unionByName(few)


def membership_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """cluster_id of clusters (cluster_id, item_ids) whose items or their order differ, or that only one side has."""
    a, b = before.select("cluster_id", F.col("item_ids").alias("x")), after.select("cluster_id", F.col("item_ids").alias("y"))
    return a.join(b, "cluster_id", "full_outer").where(~F.col("x").eqNullSafe(F.col("y"))).select("cluster_id")


def digest_faults(selected: DataFrame, items: DataFrame) -> DataFrame:
    """cluster_id, rule of digest items (cluster_id, rank, display_order) that do not follow the selected clusters (cluster_id, rank)."""
    a, b = selected.select("cluster_id", F.col("rank").alias("chosen")), items.select("cluster_id", "rank", "display_order")
    rule = F.when(F.col("chosen").isNull(), "not-selected").when(F.col("rank").isNull(), "missing").when(F.col("rank") != F.col("chosen"), "rank-changed").when(F.col("display_order") != F.col("rank"), "order")
    return a.join(b, "cluster_id", "full_outer").select("cluster_id", rule.alias("rule")).where("rule IS NOT NULL")


def require(violations: DataFrame, what: str) -> None:
    """Fails on the first broken rule."""
    first = violations.limit(1).collect()
    if first:
        raise ValidationError(f"{what}: {first[0]['rule']} at {first[0]['key']}")


def freshness(config: FreshnessConfig = FreshnessConfig()) -> Column:
    """The first gate that a feed fails; null if it is fresh.

    Columns: fetch_status, fetch_run, run_id, fetched_at, started_at, collected_at, exported_at, now.
    """
    ms = lambda c: F.unix_millis(strict(F.col(c)))
    ahead = F.lit(int(config.future_minutes * 60_000))
    same_run = (F.col("fetch_status") == "succeeded") & (F.col("fetch_run") == F.col("run_id")) & (ms("fetched_at") >= ms("started_at"))
    return (
        F.when(~F.coalesce(same_run, F.lit(False)), "x_same_run_fetch_required").when(F.col("collected_at").isNull(), "x_collection_unverified").when(ms("collected_at").isNull(), "x_collection_invalid")
        .when(ms("exported_at").isNull(), "x_export_invalid").when(ms("fetched_at") > ms("now") + ahead, "x_same_run_fetch_required").when(ms("now") - ms("collected_at") > int(config.max_age_hours * 3_600_000), "x_collection_stale")
        .when(ms("collected_at") - ms("now") > ahead, "x_collection_future").when(ms("exported_at") < ms("collected_at") - ahead, "x_export_before_collection").when(ms("exported_at") - ms("now") > ahead, "x_export_future")
    )


def web_age(published_ms: Column, now_ms: Column, config: FreshnessConfig = FreshnessConfig()) -> Column:
    return F.when(now_ms - published_ms > int(config.old_days * 86_400_000), "web_metadata_old")
