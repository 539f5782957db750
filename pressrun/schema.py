"""The item model."""

from __future__ import annotations

from pyspark.sql import types as T

_s = lambda name, nullable=True: T.StructField(name, T.StringType(), nullable)

AUTHOR = T.StructType([_s("name"), _s("handle")])
SOURCE = T.StructType([_s("type"), _s("provider"), _s("url"), _s("originalId"), T.StructField("author", AUTHOR)])
SCORE_NAMES = ("informationValue", "personalRelevance", "impact", "attentionSignal", "importance")
SCORES = T.StructType([T.StructField(x, T.DoubleType()) for x in SCORE_NAMES])
MEDIA = T.ArrayType(T.StructType([_s("type"), _s("url"), _s("previewUrl"), _s("altText"), T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]))
VISION = T.StructType([_s("status"), _s("observations"), _s("visibleText")])
VISUAL = T.StructType([T.StructField("value", T.IntegerType()), T.StructField("roles", T.ArrayType(T.StringType()))])
ITEM = T.StructType([
    _s("id"), T.StructField("source", SOURCE), _s("title"), _s("summary"), _s("category"), _s("publishedAt"), _s("collectedAt"),
    T.StructField("scores", SCORES), T.StructField("media", MEDIA), T.StructField("vision", VISION), T.StructField("visual", VISUAL),
])
POOL = T.StructType([T.StructField("schemaVersion", T.IntegerType()), _s("generatedAt"), T.StructField("items", T.ArrayType(ITEM))])
FEED_ITEM = T.StructType([
    _s("id"), _s("title"), _s("summary"), _s("category"), _s("sourceType"), _s("sourceUrl"), _s("postedAt"), _s("collectedAt"),
    T.StructField("author", AUTHOR), T.StructField("scores", SCORES), T.StructField("media", MEDIA), T.StructField("vision", VISION), T.StructField("visual", VISUAL),
])
FEED = T.StructType([
    T.StructField("schemaVersion", T.IntegerType()), _s("source"), _s("generatedAt"), T.StructField("scope", T.StructType([_s("type"), T.StructField("itemCount", T.IntegerType())])),
    _s("collectionCompletedAt"), T.StructField("items", T.ArrayType(FEED_ITEM)),
])
