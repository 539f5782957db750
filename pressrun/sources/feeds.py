"""Landed feeds: JSON envelopes and RSS or Atom documents as items of the nested model."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressrun.errors import ValidationError
from pressrun.functions import ids, text, time
from pressrun.operators.checks import raw_feed_faults
from pressrun.operators.references import media, vision, visual_roles, visual_value
from pressrun.schema import FEED, POOL, SCORES

#: A feed body above this is refused.
MOST_BYTES = 8 * 1024 * 1024
FEED_SOURCE = "x-timeline-collector"
DEFAULT_CATEGORY = "uncategorized"

_text = T.StructType([T.StructField("_VALUE", T.StringType())])
_s = T.StringType()
_category = T.ArrayType(T.StructType([T.StructField("_VALUE", _s), T.StructField("_term", _s), T.StructField("_label", _s)]))
RSS = T.StructType([T.StructField("channel", T.StructType([
    T.StructField("title", _s), T.StructField("lastBuildDate", _s), T.StructField("pubDate", _s),
    T.StructField("item", T.ArrayType(T.StructType([
        T.StructField("title", _s), T.StructField("link", _s), T.StructField("guid", _text), T.StructField("description", _s), T.StructField("content:encoded", _s), T.StructField("content", _s),
        T.StructField("pubDate", _s), T.StructField("dc:date", _s), T.StructField("category", _category), T.StructField("dc:creator", _s), T.StructField("author", _s),
    ]))),
]))])
ATOM = T.StructType([
    T.StructField("title", _text), T.StructField("updated", _s),
    T.StructField("entry", T.ArrayType(T.StructType([
        T.StructField("title", _text), T.StructField("id", _s), T.StructField("link", T.ArrayType(T.StructType([T.StructField("_rel", _s), T.StructField("_href", _s)]))),
        T.StructField("published", _s), T.StructField("updated", _s), T.StructField("summary", _text), T.StructField("content", _text), T.StructField("category", _category),
        T.StructField("author", T.ArrayType(T.StructType([T.StructField("name", _s)]))),
    ]))),
])


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """One row: the envelope of a JSON feed."""
    return spark.read.schema(FEED).option("mode", "FAILFAST").json(path, multiLine=True)


def read_document(spark: SparkSession, path: str, schema: T.StructType, label: str) -> DataFrame:
    """A JSON document as a row; missing and unreadable ones are told apart."""
    try:
        found = spark.read.schema(schema).option("mode", "FAILFAST").json(path, multiLine=True)
        found.limit(1).collect()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise ValidationError(f"{label} is missing: {path}", "MISSING") from e
        raise
    except (PySparkException, Py4JJavaError) as e:
        if "MALFORMED" in str(e) or "BAD_RECORD" in str(e):
            raise ValidationError(f"{label} is not valid JSON", "INVALID_JSON") from e
        raise
    return found


def read_pool(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(POOL).json(path, multiLine=True).select("generatedAt", F.inline("items"))


def feed_items(feed: DataFrame, provider: str = FEED_SOURCE) -> DataFrame:
    """Normal items of a feed envelope that has passed feed_rules."""
    rows = feed.select("generatedAt", F.inline("items"))
    value, roles = F.col("visual.value"), F.col("visual.roles")
    source = F.struct(F.coalesce("sourceType", F.lit("x")).alias("type"), F.lit(provider).alias("provider"), F.col("sourceUrl").alias("url"), F.col("id").alias("originalId"), F.col("author").alias("author"))
    scores = F.struct(*[F.col(f"scores.{n}").alias(n) for n in SCORES.fieldNames()])
    return rows.select(
        F.concat(F.lit(f"x:{provider}:"), "id").alias("id"), source.alias("source"), "title", "summary", "category", F.col("postedAt").alias("publishedAt"), F.coalesce("collectedAt", "generatedAt").alias("collectedAt"), scores.alias("scores"),
        media(F.col("media")).alias("media"), vision(F.col("vision")).alias("vision"), F.struct(visual_value(value, roles).alias("value"), visual_roles(value, roles).alias("roles")).alias("visual"),
    )


def ingest_feed(spark: SparkSession, path: str) -> DataFrame:
    """Items of a landed feed. Its raw text is checked before a schema is laid over it."""
    faults = raw_feed_faults(spark.read.text(path, wholetext=True), FEED_SOURCE).orderBy(F.col("at").isNotNull(), "at", "rule").limit(1).collect()
    if faults:
        raise ValidationError(f"{path}: {faults[0]['rule']} at {faults[0]['at']}")
    return feed_items(read_feed(spark, path))


def envelope(feed: DataFrame, items: DataFrame, now: str, url: str | None, provider: str = FEED_SOURCE) -> DataFrame:
    """One row about normalised items: when they were made, from which feed."""
    counted = items.agg(F.count("*").alias("itemCount"))
    one = feed.select("generatedAt").join(F.broadcast(counted))  # one row each
    source = F.struct(F.lit(provider).alias("provider"), F.lit("x").alias("type"), F.lit(url).cast("string").alias("url"), F.col("generatedAt").alias("sourceGeneratedAt"), "itemCount")
    return one.select(F.lit(1).alias("schemaVersion"), F.lit(now).alias("generatedAt"), F.array(source).alias("sourceFeeds"))


def _escaped(xml: Column) -> Column:
    """Ampersands outside CDATA escaped once more, so that one decoding gives the text as it stands in the feed."""
    body = F.regexp_replace(xml, "^﻿", "")
    return F.regexp_replace(body, r"(?s)&(?!(?:(?!<!\[CDATA\[).)*?\]\]>)", "&amp;")


def _category_of(c: Column) -> Column:
    return F.get(F.filter(F.transform(F.coalesce(c, F.array().cast(_category)), lambda x: F.coalesce(text.nonblank(x["_VALUE"]), text.nonblank(x["_term"]), text.nonblank(x["_label"]))), lambda x: x.isNotNull()), F.lit(0))


def too_large() -> Column:
    return F.octet_length("xml") > MOST_BYTES


def document_faults(documents: DataFrame) -> DataFrame:
    """provider, error of documents that are too large or no feed at all."""
    kind = F.col("xml").rlike(r"(?i)<(rss|feed)[\s>]")
    closed = F.col("xml").rlike(r"(?is)</(rss|feed)\s*>\s*$")
    error = F.when(too_large(), "body-too-large").when(~F.coalesce(kind & closed, F.lit(False)), "malformed-xml")
    return documents.select("provider", error.alias("fault")).where("fault IS NOT NULL")


def parse_xml(documents: DataFrame) -> DataFrame:
    """documents: provider, xml. Flat entries: provider, guid, url, title, summary, published, category, author."""
    kind = F.when(F.col("xml").rlike(r"(?i)<rss[\s>]"), "rss").when(F.col("xml").rlike(r"(?i)<feed[\s>]"), "atom")
    rows = documents.where(~too_large()).select("provider", kind.alias("kind"), _escaped(F.col("xml")).alias("xml"))
    options = {"ignoreNamespace": "false"}
    n = text.nonblank
    rss = rows.where("kind = 'rss'").select("provider", F.explode(F.from_xml("xml", RSS, options)["channel"]["item"]).alias("i"))
    i = lambda name: F.col("i").getField(name)
    rss = rss.select(
        "provider", n(i("guid")["_VALUE"]).alias("guid"), n(i("link")).alias("url"), n(i("title")).alias("title"), F.coalesce(n(i("description")), n(i("content:encoded")), n(i("content"))).alias("summary"),
        F.coalesce(n(i("pubDate")), n(i("dc:date"))).alias("published"), _category_of(i("category")).alias("category"), F.coalesce(n(i("dc:creator")), n(i("author"))).alias("author"),
    )
    atom = rows.where("kind = 'atom'").select("provider", F.explode(F.from_xml("xml", ATOM, options)["entry"]).alias("i"))
    main = F.get(F.filter(i("link"), lambda x: x["_rel"].isNull() | (x["_rel"] == "alternate")), F.lit(0))["_href"]
    atom = atom.select(
        "provider", n(i("id")).alias("guid"), n(F.coalesce(main, F.get(i("link"), F.lit(0))["_href"])).alias("url"), n(i("title")["_VALUE"]).alias("title"), F.coalesce(n(i("summary")["_VALUE"]), n(i("content")["_VALUE"])).alias("summary"),
        F.coalesce(n(i("published")), n(i("updated"))).alias("published"), _category_of(i("category")).alias("category"), n(F.get(i("author"), F.lit(0))["name"]).alias("author"),
    )
    return rss.unionByName(atom)


def web_items(entries: DataFrame, sources: DataFrame, collected_at: str) -> DataFrame:
    """Normal items of parsed entries; entries with neither guid nor URL have a null id."""
    original = ids.original_id(F.col("guid"), F.col("url"))
    rows = entries.join(F.broadcast(sources.select(F.col("id").alias("provider"), F.col("defaultCategory").alias("default_category"))), "provider")  # one row a configured source
    category = F.coalesce(text.nonblank(F.col("category")), text.nonblank(F.col("default_category")), F.lit(DEFAULT_CATEGORY))
    author = F.when(F.col("author").isNotNull(), F.struct(F.col("author").alias("name"), F.lit(None).cast("string").alias("handle")))
    return rows.select(
        ids.web_id(F.col("provider"), original).alias("id"), F.struct(F.lit("web").alias("type"), F.col("provider"), F.col("url"), original.alias("originalId"), author.alias("author")).alias("source"),
        text.plain_text(F.col("title")).alias("title"), text.plain_text(F.col("summary")).alias("summary"), category.alias("category"), time.iso(time.lenient(F.col("published"))).alias("publishedAt"), F.lit(collected_at).alias("collectedAt"),
        F.struct(*[F.lit(None).cast("double").alias(s) for s in SCORES.fieldNames()]).alias("scores"),
    )


def ingest_web(spark: SparkSession, paths: dict[str, str], sources: DataFrame, collected_at: str) -> tuple[DataFrame, DataFrame]:
    """Items of all sources that succeed, and provider, status, item_count, error of every enabled source.

    A source fails alone: no entries, an entry without identity, or one id twice.
    """
    enabled = sources.where("enabled")
    documents = None
    for provider, path in paths.items():
        one = spark.read.text(path, wholetext=True).select(F.lit(provider).alias("provider"), F.col("value").alias("xml"))
        documents = one if documents is None else documents.unionByName(one)
    if documents is None:
        raise ValueError("no feed was landed")
    items = web_items(parse_xml(documents), enabled, collected_at)
    each = items.groupBy(F.col("source.provider").alias("provider")).agg(F.count("*").alias("item_count"), F.count_if(F.col("id").isNull()).alias("nameless"), F.count_distinct("id").alias("distinct_ids"))
    error = F.when(F.col("item_count").isNull(), "no-items").when(F.col("nameless") > 0, "no-identity").when(F.col("distinct_ids") < F.col("item_count"), "duplicate-id")
    error = F.coalesce("fault", error)
    status = enabled.select(F.col("id").alias("provider")).join(each, "provider", "left").join(document_faults(documents), "provider", "left").select("provider", F.when(error.isNull(), "ok").otherwise("error").alias("status"), F.coalesce("item_count", F.lit(0)).alias("item_count"), error.alias("error"))
    good = status.where("status = 'ok'").select(F.col("provider").alias("p"))
    return items.join(F.broadcast(good), items["source.provider"] == good["p"], "left_semi"), status  # one row a configured source


def read_inputs(spark: SparkSession, inputs: list[dict]) -> list[DataFrame]:
    """Pools of the inputs {id, path, required}; a missing one is skipped unless it is required."""
    out = []
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for entry in inputs:
        path = jvm.org.apache.hadoop.fs.Path(entry["path"])
        if path.getFileSystem(conf).exists(path):
            out.append(read_pool(spark, entry["path"]).drop("generatedAt"))
        elif entry.get("required", True):
            raise FileNotFoundError(entry["path"])
    return out
