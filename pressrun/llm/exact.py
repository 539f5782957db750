"""Exact de-duplication with a heavy-hitter split, in DataFrame functions only.

Texts are compared by the SHA-256 of the text without white space. `freqItems` is the Misra-Gries summary of the
digests: it names at most HOT_SHARE digests, among them every digest with more than 1/HOT_SHARE of the rows.
Their winners and sizes are counted exactly and broadcast, so their rows are settled on the map side; the rows
of all other digests are shuffled, each digest with a small share of the rows.

Defined cases: null text counts as empty; the row with most code points stays, then the smallest doc_id; rows with
a null doc_id never win over others, however long, and stay (with a null keep_id) only where a text has no other rows;
rows are told apart by doc_id alone, so repeated rows of the doc_id that stays all stay; an empty table gives an
empty result; columns besides doc_id, text and those to carry are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressrun.llm._base import HOT_SHARE, SPACE_RUN, materialize, text_or_empty


def digests(docs: DataFrame, carry: list[str]) -> DataFrame:
    text = docs.select("doc_id", *carry, text_or_empty().alias("text"))
    return text.select("doc_id", *carry, F.length("text").alias("chars"), F.unhex(F.sha2(F.regexp_replace("text", SPACE_RUN, "").cast("binary"), 256)).alias("digest"))


def dedup(docs: DataFrame, carry: list[str] = []) -> DataFrame:  # noqa: B006
    """doc_id, keep_id, group_size, kept, text_sha256 of each row, and its columns `carry`."""
    rows = materialize(digests(docs, carry), "exact")
    order = F.struct(F.col("doc_id").isNull(), -F.col("chars"), F.col("doc_id"))
    names = rows.freqItems(["digest"], 1 / HOT_SHARE).select(F.explode("digest_freqItems").alias("digest"))
    frequent = rows.join(F.broadcast(names), "digest", "left_semi")
    winners = materialize(frequent.groupBy("digest").agg(F.min_by("doc_id", order).alias("keep_id"), F.count("*").alias("group_size")), "exact-hot")
    columns = ["doc_id", "digest", "keep_id", "group_size", *carry]
    hot = rows.join(F.broadcast(winners), "digest").select(*columns)
    own = Window.partitionBy("digest")
    cold = (
        rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
        .withColumn("keep_id", F.first("doc_id").over(own.orderBy(order)))
        .withColumn("group_size", F.count("*").over(own))
        .select(*columns)
    )
    found = hot.unionByName(cold)
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), *carry)


ORACLE = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS kept, text_sha256
FROM d
"""
