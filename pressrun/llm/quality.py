"""Host-level quality rules, in DataFrame functions only.

Each document gets base figures and a base verdict. Failures are counted by host (`source`), the failure
rates of hosts are shrunk towards an empirical beta prior fitted by the method of moments over all hosts,
and the verdict on each host is joined back to its documents.

Defined cases: null or blank text has no words and fails the base rules; a null host is the host ''; repeated
rows and equal or null doc_ids are judged row by row; an empty table gives an empty result; columns besides
doc_id, text and source are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressrun.llm._base import SPACE_RUN, SPACES, join_hot, materialize, text_or_empty


@dataclass(frozen=True)
class QualityRules:
    min_words: int = 20
    window: int = 8
    max_repeat_percent: int = 30
    #: A host whose shrunk failure rate is above this is rejected with all its documents.
    max_host_rate: float = 0.5
    min_prior_strength: float = 1.0
    max_prior_strength: float = 10_000.0

    def __post_init__(self) -> None:
        if self.window < 2 or not 0 < self.max_host_rate <= 1:
            raise ValueError("window must be 2 or more and max_host_rate in (0, 1]")


def features(docs: DataFrame, rules: QualityRules = QualityRules(), carry: list[str] = []) -> DataFrame:  # noqa: B006
    """The columns `carry`, doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each row; no shuffle.

    Windows are compared by 64-bit hashes of their words. Places are sorted only in texts where a hash repeats.
    """
    w = rules.window
    text = docs.select(*carry, "doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"), text_or_empty().alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    words = text.select(
        *carry,
        "doc_id",
        "host",
        F.length(F.regexp_replace("text", SPACE_RUN, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.transform(F.filter(F.split("text", SPACE_RUN), lambda x: x != ""), lambda x: F.xxhash64(x)).alias("words"),
    )
    windows = words.select(
        *carry,
        "doc_id",
        "host",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("words").cast("long").alias("n_words"),
        F.when(F.size("words") > w, F.transform(F.sequence(F.lit(1), F.size("words") - (w - 1)), lambda i: F.xxhash64(F.slice("words", i, w)))).alias("win"),
    )
    ranked = windows.withColumn("win", F.when(F.size("win") > F.size(F.array_distinct("win")), F.sort_array(F.transform("win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    hash_at = lambda j: F.get("win", j)["h"]
    repeated = F.filter(F.sequence(F.lit(0), F.size("win") - 1), lambda j: hash_at(j).eqNullSafe(hash_at(j - 1)) | hash_at(j).eqNullSafe(hash_at(j + 1)))
    placed = ranked.withColumn("win", F.when(F.col("win").isNotNull(), F.sort_array(F.transform(repeated, lambda j: F.get("win", j)["i"]))))
    covered = F.aggregate(
        "win",
        F.struct(F.lit(-w).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, x: F.struct(x.alias("last"), (acc["n"] + F.least(F.lit(w), x - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    return placed.select(*carry, "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def beta_prior(hosts: DataFrame, rules: QualityRules = QualityRules()) -> tuple[float, float]:
    """(a, b) of the beta prior over host failure rates, from one row of moments of all hosts."""
    m = hosts.agg(F.count("*").alias("h"), F.sum("n").alias("n"), F.sum("fails").alias("f"), F.sum(F.col("fails") * F.col("fails") / F.col("n")).alias("q")).first()
    if not m["h"]:
        return 0.5, 0.5
    mean = m["f"] / m["n"]
    within = mean * (1 - mean)
    between = m["q"] / m["n"] - mean * mean - within * m["h"] / m["n"]
    strength = within / between - 1 if between > 0 else rules.max_prior_strength
    strength = min(max(strength, rules.min_prior_strength), rules.max_prior_strength)
    return mean * strength, (1 - mean) * strength


def judge(docs: DataFrame, rules: QualityRules = QualityRules(), carry: list[str] = []) -> DataFrame:  # noqa: B006
    """One row per input row: doc_id, figures, base_failed, kept, host, host_rate, and its columns `carry`."""
    failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    stored = materialize(features(docs, rules, carry).withColumn("base_failed", failed), "quality")
    hosts = stored.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("fails"))
    hosts = materialize(hosts, "quality-hosts")
    a, b = beta_prior(hosts, rules)
    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    verdicts = hosts.select("host", "n", ((F.col("fails") + F.lit(a)) / (F.col("n") + F.lit(a + b))).alias("host_rate"))
    joined = join_hot(stored, verdicts, "host", "n", total)
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.col("host_rate") <= rules.max_host_rate)).alias("kept"), "host", "host_rate", *carry)


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS s
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) > 7)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM dup) GROUP BY doc_id),
f AS (SELECT w.doc_id, host, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id),
b AS (SELECT *, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed FROM f),
h AS (SELECT host, count(*) AS n, sum(base_failed::BIGINT) AS fails FROM b GROUP BY host),
m AS (SELECT count(*)::DOUBLE AS h, sum(n)::DOUBLE AS n, sum(fails)::DOUBLE / sum(n)::DOUBLE AS mean, sum(fails * fails / n::DOUBLE) AS q FROM h),
v AS (SELECT mean, mean * (1 - mean) AS inside, q / n - mean * mean - mean * (1 - mean) * h / n AS outside FROM m),
p AS (SELECT mean, least(greatest(CASE WHEN outside > 0 THEN inside / outside - 1 ELSE 10000.0 END, 1.0), 10000.0) AS s FROM v)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND (h.fails + p.mean * p.s) / (h.n + p.s) <= 0.5) AS kept
FROM b JOIN h USING (host), p
"""
