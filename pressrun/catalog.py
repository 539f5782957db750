"""The registered queries over the synthetic tables, and the same in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressrun.config import AXES, CandidateConfig, DigestConfig, EvaluationConfig, SelectConfig
from pressrun.functions import ids, text, time, url
from pressrun.operators import answers, candidates, checks, clusters, digest, evaluation, judging, pool, references, selection, similarity
from pressrun.operators.graph import stored, with_position
from pressrun.plans import documents
from pressrun.sources import feeds, fetching
from pressrun.sources.tables import ITEMS_SQL, NORM_SQL, featured, items, table, told

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def joined(c: Column | str) -> Column:
    return F.array_join(c, "|")


def normal(spark: SparkSession, d: str) -> DataFrame:
    return featured(items(spark, d))


# ---------------------------------------------------------------- pool


@query(f"WITH {ITEMS_SQL} SELECT id, source_type, provider, title, category, published_ms, collected_ms FROM items")
def pool_union(spark: SparkSession, d: str) -> DataFrame:
    return items(spark, d).select("id", "source_type", "provider", "title", "category", "published_ms", "collected_ms")


@query(f"WITH {ITEMS_SQL} SELECT provider, title, count(*) AS n FROM items GROUP BY ALL HAVING count(*) > 1")
def pool_duplicate_ids(spark: SparkSession, d: str) -> DataFrame:
    return pool.duplicate_ids(items(spark, d), ("provider", "title"))


@query(f"WITH {ITEMS_SQL} SELECT id, row_number() OVER (ORDER BY published_ms DESC NULLS LAST, collected_ms DESC NULLS LAST, id) AS pos FROM items")
def pool_ordered(spark: SparkSession, d: str) -> DataFrame:
    return pool.ordered(items(spark, d)).select("id", "pos")


@query(f"""WITH {ITEMS_SQL} SELECT 'type' AS kind, source_type AS name, count(*) AS n FROM items GROUP BY source_type
UNION ALL SELECT 'provider', provider, count(*) FROM items GROUP BY provider UNION ALL SELECT 'total', '(all)', count(*) FROM items""")
def pool_stats(spark: SparkSession, d: str) -> DataFrame:
    return pool.stats(items(spark, d))


@query(f"WITH {ITEMS_SQL} SELECT provider, count(*) AS n FROM items GROUP BY provider")
def count_by_provider(spark: SparkSession, d: str) -> DataFrame:
    return pool.count_by(items(spark, d), "provider")


# ---------------------------------------------------------------- normal forms


@query(f"""WITH {NORM_SQL} SELECT id, url_norm FROM norm WHERE url IS NOT NULL UNION ALL SELECT id || ':host', replace(url_norm, '.example.', '.xn--exmple-cua.') FROM norm WHERE url IS NOT NULL
UNION ALL SELECT id || ':path', regexp_replace(url_norm, '/([a-z][a-z])/', '/\\1/%C3%A9%20%7Bx%7D/a%2fb/') FROM norm WHERE url IS NOT NULL
UNION ALL SELECT id || ':query', url_norm || CASE WHEN contains(url_norm, '?') THEN '&' ELSE '?' END || 'z+%C3%A9=%26*' FROM norm WHERE url IS NOT NULL""")
def url_normalized(spark: SparkSession, d: str) -> DataFrame:
    """The URLs as they are, and with planted foreign hosts, characters of paths and coded parameters."""
    given = items(spark, d).where("url IS NOT NULL").select("id", "url")
    bare = F.regexp_replace("url", "#.*$", "")
    variants = {
        ":host": F.replace("url", F.lit(".example."), F.lit(".EXÄMPLE.")), ":path": F.regexp_replace("url", "/([a-z][a-z])/", "/$1/é {x}/./q/../a%2fb/"),
        ":query": F.concat(bare, F.when(F.contains(bare, F.lit("?")), "&").otherwise("?"), F.lit("z%20é=%26%2A")),
    }
    rows = given
    for mark, c in variants.items():
        rows = rows.unionByName(given.select(F.concat("id", F.lit(mark)).alias("id"), c.alias("url")))
    return rows.select("id", url.normalized_url(F.col("url")).alias("url_norm"))


@query(f"WITH {NORM_SQL} SELECT id, host FROM norm")
def url_host(spark: SparkSession, d: str) -> DataFrame:
    return normal(spark, d).select("id", "host")


@query(f"WITH {NORM_SQL} SELECT id, title_norm FROM norm")
def title_normalized(spark: SparkSession, d: str) -> DataFrame:
    return normal(spark, d).select("id", "title_norm")


GRAMS_SQL = r"""distinct_titles AS (SELECT DISTINCT title_norm AS t FROM norm WHERE length(title_norm) >= 12),
gram_rows AS (SELECT t, unnest(CASE WHEN length(t) >= 3 THEN list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3)) ELSE [t] END) AS gram FROM distinct_titles),
gram_counts AS (SELECT t, gram, count(*) AS c FROM gram_rows GROUP BY ALL), gram_sizes AS (SELECT t, count(*) AS n FROM gram_rows GROUP BY t),
dice AS (SELECT a.t AS ta, b.t AS tb, floor(2.0 * sum(least(a.c, b.c)) / (any_value(x.n) + any_value(y.n)) * 10000 + 0.5) / 10000 AS score
  FROM gram_counts a JOIN gram_counts b ON a.gram = b.gram AND a.t < b.t JOIN gram_sizes x ON x.t = a.t JOIN gram_sizes y ON y.t = b.t GROUP BY a.t, b.t),
similar_pairs AS (SELECT least(x.id, y.id) AS item_a, greatest(x.id, y.id) AS item_b, score FROM dice JOIN norm x ON x.title_norm = ta JOIN norm y ON y.title_norm = tb WHERE score >= 0.9),
title_reps AS (SELECT title_norm AS t, min(id) AS m, count(*) AS n FROM norm WHERE title_norm IS NOT NULL GROUP BY title_norm),
similar_reps AS (SELECT least(x.m, y.m) AS item_a, greatest(x.m, y.m) AS item_b, score, x.n * y.n AS n_links FROM dice JOIN title_reps x ON x.t = ta JOIN title_reps y ON y.t = tb WHERE score >= 0.9)"""


@query(f"WITH {NORM_SQL}, {GRAMS_SQL} SELECT gram, sum(c)::BIGINT AS n FROM gram_counts GROUP BY gram")
def title_ngrams(spark: SparkSession, d: str) -> DataFrame:
    titles = normal(spark, d).where("length(title_norm) >= 12").select("title_norm").distinct()
    return titles.select(F.explode(text.grams(F.col("title_norm"))).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- pairs and clusters


def class_sql(column: str) -> str:
    return f"WITH {NORM_SQL} SELECT id, min(id) OVER (PARTITION BY {column}) AS class_id, count(*) OVER (PARTITION BY {column}) - 1 AS n_links FROM norm WHERE {column} IS NOT NULL"


@query(class_sql("url_norm"))
def same_url_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Each item with a URL, its class and its number of links."""
    return similarity.members(normal(spark, d), "url_norm")


@query(class_sql("title_norm"))
def same_title_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Each item with a title, its class and its number of links."""
    return similarity.members(normal(spark, d), "title_norm")


@query(f"WITH {NORM_SQL}, {GRAMS_SQL} SELECT item_a, item_b, score, n_links FROM similar_reps")
def title_similarity_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Similar titles, named by the least item of each, and the item pairs they stand for."""
    return similarity.similar_titles(normal(spark, d).select("id", "title_norm"))


EDGES_SQL = rf"""{NORM_SQL}, {GRAMS_SQL},
edges AS (SELECT a.id AS item_a, b.id AS item_b, 'same-url' AS type, 1.0::DOUBLE AS confidence, NULL::DOUBLE AS score FROM norm a JOIN norm b ON a.url_norm = b.url_norm AND a.id < b.id
  UNION ALL SELECT a.id, b.id, 'same-title', 0.98, NULL FROM norm a JOIN norm b ON a.title_norm = b.title_norm AND a.id < b.id
  UNION ALL SELECT item_a, item_b, 'title-similarity', score, score FROM similar_pairs)"""
CLUSTERS_SQL = rf"""{EDGES_SQL},
forming AS (SELECT e.item_a AS a, e.item_b AS b FROM edges e JOIN norm n ON n.id = e.item_a WHERE type <> 'same-title' OR length(n.title_norm) >= 8),
both_ways AS (SELECT a, b FROM forming UNION SELECT b, a FROM forming),
reach AS (SELECT id, id AS l FROM norm UNION SELECT e.b, r.l FROM reach r JOIN both_ways e ON r.id = e.a),
members AS (SELECT id, min(l) AS root FROM reach GROUP BY id),
found AS (SELECT root, 'cluster:' || sha256(string_agg(id, chr(10) ORDER BY id)) AS cluster_id, string_agg(id, '|' ORDER BY id) AS item_ids, count(*) AS item_count FROM members GROUP BY root)"""
WITH_CLUSTERS = f"WITH RECURSIVE {CLUSTERS_SQL}"


RELATED_SQL = f"""{NORM_SQL}, {GRAMS_SQL},
url_class AS (SELECT id, min(id) OVER (PARTITION BY url_norm) AS class_id FROM norm WHERE url_norm IS NOT NULL), title_class AS (SELECT id, min(id) OVER (PARTITION BY title_norm) AS class_id FROM norm WHERE title_norm IS NOT NULL),
related AS (SELECT class_id AS item_a, id AS item_b, 'same-url' AS type, 1.0::DOUBLE AS confidence, NULL::DOUBLE AS score FROM url_class WHERE id <> class_id
  UNION ALL SELECT class_id, id, 'same-title', 0.98, NULL FROM title_class WHERE id <> class_id UNION ALL SELECT item_a, item_b, 'title-similarity', score, score FROM similar_reps)"""


@query(f"""WITH {RELATED_SQL} SELECT item_a, item_b, type, confidence, score,
row_number() OVER (ORDER BY CASE type WHEN 'same-url' THEN 0 WHEN 'same-title' THEN 1 ELSE 2 END, item_a, item_b) AS pos FROM related""")
def relationships_all(spark: SparkSession, d: str) -> DataFrame:
    return similarity.with_position(similarity.relationships(stored(normal(spark, d).select("id", "title_norm", "url_norm"))))


def brief_items(spark: SparkSession, d: str) -> DataFrame:
    return stored(featured(items(spark, d, brief=True)).drop("title_nfkc", "host", "terms", "proper"))


def clustered(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Brief items and their cluster membership."""
    rows = brief_items(spark, d)
    return rows, clusters.membership(rows, clusters.forming_edges(rows))


def linked(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """As `clustered`, and the similar titles, which are compared once."""
    rows = brief_items(spark, d)
    similar = stored(similarity.similar_titles(rows))
    return rows, clusters.membership(rows, clusters.forming_edges(rows, similar=similar)), similar


@query(f"{WITH_CLUSTERS} SELECT m.id, cluster_id, item_count FROM members m JOIN found f USING (root)")
def clusters_found(spark: SparkSession, d: str) -> DataFrame:
    """Every item with its cluster and the size of that."""
    members = clustered(spark, d)[1]
    return clusters.named_members(members, clusters.clusters(members)).select("id", "cluster_id", "item_count")


@query(f"""{WITH_CLUSTERS} SELECT 'clusters' AS name, count(*) AS n FROM found UNION ALL SELECT 'multi', count(*) FILTER (item_count > 1) FROM found UNION ALL SELECT 'single', count(*) FILTER (item_count = 1) FROM found
UNION ALL SELECT 'items', sum(item_count)::BIGINT FROM found UNION ALL SELECT t, (SELECT count(*) FROM edges WHERE type = t) FROM (VALUES ('same-url'), ('same-title'), ('title-similarity')) v(t)""")
def cluster_stats(spark: SparkSession, d: str) -> DataFrame:
    rows, members, similar = linked(spark, d)
    return clusters.stats(similarity.link_counts(rows, similar=similar), clusters.clusters(members))


@query(f"""{WITH_CLUSTERS} SELECT f.cluster_id, f.item_count, count(*) AS n_edges FROM edges e JOIN members a ON a.id = e.item_a JOIN members b ON b.id = e.item_b AND a.root = b.root JOIN found f ON f.root = a.root
GROUP BY ALL""")
def cluster_review(spark: SparkSession, d: str) -> DataFrame:
    rows, members, similar = linked(spark, d)
    inner = similarity.link_counts(rows, members, similar=similar).groupBy("root").agg(F.sum("n_links").alias("n_edges"))
    return clusters.clusters(members).join(inner, "root").select("cluster_id", "item_count", "n_edges")


@query(f"WITH {ITEMS_SQL} SELECT id, 'unassigned' AS rule FROM items WHERE key % 50 = 0 UNION ALL SELECT id, 'duplicate' FROM items WHERE key % 50 <> 0 AND key % 70 = 1 UNION ALL SELECT 'lost:' || id, 'unknown' FROM items WHERE key % 90 = 2")
def invariant_checks(spark: SparkSession, d: str) -> DataFrame:
    """A membership with planted faults: items without a cluster, with two, and members that are no items."""
    rows, members = clustered(spark, d)
    keyed = members.join(rows.select("id", "key"), "id")
    kept = keyed.where("key % 50 <> 0").select("id", "root")
    faulty = kept.unionByName(keyed.where("key % 50 <> 0 AND key % 70 = 1").select("id", "root")).unionByName(keyed.where("key % 90 = 2").select(F.concat(F.lit("lost:"), "id").alias("id"), "root"))
    return clusters.violations(rows, faulty)


# ---------------------------------------------------------------- scalar functions


@query(r"""WITH t AS (SELECT page_id, html FROM pages),
a AS (SELECT page_id, replace(replace(replace(replace(replace(replace(html, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', ' '), '&mdash;', '—'), '&amp;', '&') AS h FROM t),
b AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(h, '(?is)<script\b[^>]*>.*?</script>', ' ', 'g'), '(?is)<style\b[^>]*>.*?</style>', ' ', 'g'), '(?i)<br\s*/?>|</p>', chr(10), 'g') AS h FROM a),
c AS (SELECT page_id, regexp_replace(h, '<[^>]+>', ' ', 'g') AS h FROM b)
SELECT page_id, nullif(trim(regexp_replace(h, '\s+', ' ', 'g')), '') AS plain FROM c""")
def html_plain_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", text.plain_text(F.col("html")).alias("plain"))


@query(r"""WITH p AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, trim(url) AS u FROM pages)
SELECT page_id, 'web:' || host || ':' || CASE WHEN length(u) <= 180 AND regexp_matches(u, '^[A-Za-z0-9_.:/?#@&=+\-%,~]+$') THEN u ELSE sha256(u) END AS id FROM p""")
def stable_ids(spark: SparkSession, d: str) -> DataFrame:
    host = F.regexp_extract("url", r"^https?://([^/?#]+)", 1)
    return table(spark, d, "pages").select("page_id", ids.web_id(host, ids.original_id(F.lit(None).cast("string"), F.col("url"))).alias("id"))


@query(r"""SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S.000Z') AS from_rfc822, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S.000Z') AS from_iso, NULL::VARCHAR AS from_text FROM events""")
def iso_dates(spark: SparkSession, d: str) -> DataFrame:
    """Times written as RFC 822 and ISO 8601, and a text that is no time, parsed back."""
    ts = F.date_trunc("second", F.col("ts").cast("timestamp"))
    rows = table(spark, d, "events").select("event_id", F.concat(F.lit("Mon, "), F.date_format(ts, "dd MMM yyyy HH:mm:ss"), F.lit(" GMT")).alias("a"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("b"), F.lit("soon").alias("c"))
    return rows.select("event_id", *[time.iso(time.lenient(F.col(c))).alias(n) for c, n in (("a", "from_rfc822"), ("b", "from_iso"), ("c", "from_text"))])


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN lang WHEN doc_id % 3 = 1 THEN source ELSE 'uncategorized' END AS category FROM documents")
def category_resolved(spark: SparkSession, d: str) -> DataFrame:
    """Item, then source default, then constant."""
    own, default = F.when(F.col("doc_id") % 3 == 0, F.col("lang")).otherwise("  "), F.when(F.col("doc_id") % 3 == 1, F.col("source"))
    return table(spark, d, "documents").select("doc_id", F.coalesce(text.nonblank(own), text.nonblank(default), F.lit("uncategorized")).alias("category"))


STOP_SQL = "(" + ",".join(f"'{w}'" for w in text.STOPWORDS) + ")"
TERMS_SQL = rf"""{NORM_SQL},
proper_rows AS (SELECT id, list_sort(list_distinct(list_transform(list_filter(regexp_split_to_array(coalesce(title, ''), '[^A-Za-z0-9_]+'), lambda w: regexp_matches(w, '^[A-Z][A-Za-z0-9]{{2,}}$')), lambda w: lower(w)))) AS proper FROM norm),
term_rows AS (SELECT n.id, p.proper, list_sort(list_distinct(list_concat(list_filter(regexp_split_to_array(lower(coalesce(title, '')), '[^\p{{L}}\p{{N}}]+'), lambda w: length(w) >= 3 AND w NOT IN {STOP_SQL}), p.proper))) AS terms
  FROM norm n JOIN proper_rows p USING (id))"""


@query(f"WITH {TERMS_SQL} SELECT id, array_to_string(proper, '|') AS proper FROM proper_rows")
def proper_nouns(spark: SparkSession, d: str) -> DataFrame:
    return normal(spark, d).select("id", joined("proper").alias("proper"))


@query(f"WITH {TERMS_SQL} SELECT id, array_to_string(terms, '|') AS terms FROM term_rows")
def title_terms(spark: SparkSession, d: str) -> DataFrame:
    return normal(spark, d).select("id", joined("terms").alias("terms"))


@query(f"""WITH {TERMS_SQL}, firsts AS (SELECT id, min(id) OVER (PARTITION BY host) AS first FROM norm WHERE host IS NOT NULL)
SELECT f.first AS item_a, f.id AS item_b, floor(len(list_intersect(x.terms, y.terms)) / len(list_distinct(list_concat(x.terms, y.terms)))::DOUBLE * 10000 + 0.5) / 10000 AS overlap
FROM firsts f JOIN term_rows x ON x.id = f.first JOIN term_rows y ON y.id = f.id WHERE f.id <> f.first AND len(x.terms) + len(y.terms) > 0""")
def term_jaccard_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Overlap of title terms of each page with the least page of its host."""
    rows = stored(normal(spark, d).select("id", "host", "terms"))
    a, b = (rows.select(F.col("id").alias(f"item_{s}"), F.col("terms").alias(s)) for s in "ab")
    stars = similarity.members(rows, "host").where("id <> class_id").select(F.col("class_id").alias("item_a"), F.col("id").alias("item_b"))
    met = stars.join(a, "item_a").join(b, "item_b").where(F.size("a") + F.size("b") > 0)
    return met.select("item_a", "item_b", text.rounded(text.jaccard(F.col("a"), F.col("b"))).alias("overlap"))


@query(f"""WITH {NORM_SQL}, firsts AS (SELECT id, min(id) OVER (PARTITION BY title_norm) AS first FROM norm WHERE title_norm IS NOT NULL)
SELECT a.id AS item_a, b.id AS item_b, floor(abs(a.published_ms - b.published_ms) / 3600000.0::DOUBLE * 10000 + 0.5) / 10000 AS hours,
coalesce(floor(abs(a.published_ms - b.published_ms) / 3600000.0::DOUBLE * 10000 + 0.5) / 10000 <= 168, true) AS in_window FROM firsts f JOIN norm a ON a.id = f.first JOIN norm b ON b.id = f.id WHERE f.id <> f.first""")
def hours_apart_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Hours between each item and the least item of its title."""
    rows = stored(normal(spark, d))
    a, b = (rows.select(F.col("id").alias(f"item_{s}"), F.col("published_ms").alias(s)) for s in "ab")
    stars = similarity.members(rows, "title_norm").where("id <> class_id").select(F.col("class_id").alias("item_a"), F.col("id").alias("item_b"))
    met = stars.join(a, "item_a").join(b, "item_b")
    return met.select("item_a", "item_b", time.rounded_hours(F.col("a"), F.col("b")).alias("hours_apart")).select("item_a", "item_b", F.col("hours_apart").alias("hours"), candidates.in_window().alias("in_window"))


# ---------------------------------------------------------------- candidates

PAIR_SQL = rf"""{TERMS_SQL},
all_titles AS (SELECT DISTINCT title_norm AS t FROM norm WHERE title_norm IS NOT NULL),
gram_rows AS (SELECT t, unnest(CASE WHEN length(t) >= 3 THEN list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3)) ELSE [t] END) AS gram FROM all_titles),
gram_counts AS (SELECT t, gram, count(*) AS c FROM gram_rows GROUP BY ALL), gram_sizes AS (SELECT t, count(*) AS n FROM gram_rows GROUP BY t),
dice AS (SELECT a.t AS ta, b.t AS tb, floor(2.0 * sum(least(a.c, b.c)) / (any_value(x.n) + any_value(y.n)) * 10000 + 0.5) / 10000 AS score
  FROM gram_counts a JOIN gram_counts b ON a.gram = b.gram AND a.t < b.t JOIN gram_sizes x ON x.t = a.t JOIN gram_sizes y ON y.t = b.t GROUP BY a.t, b.t),
base AS (SELECT a.id AS item_a, b.id AS item_b, a.title_norm IS NOT NULL AND b.title_norm IS NOT NULL AND least(length(a.title_norm), length(b.title_norm)) >= 8 AS comparable,
  CASE WHEN a.title_norm = b.title_norm THEN 1.0 ELSE coalesce(s.score, 0.0) END AS score, coalesce(a.title_norm = b.title_norm, false) AS exact, x.terms AS xt, y.terms AS yt,
  list_intersect(x.terms, y.terms) AS st, list_intersect(x.proper, y.proper) AS sp, abs(a.published_ms - b.published_ms) / 3600000.0::DOUBLE AS h, coalesce(a.host = b.host, false) AS same_hostname,
  coalesce(a.category = b.category AND a.category <> '', false) AS same_category, a.provider <> b.provider AS different_provider
  FROM norm a JOIN norm b ON a.id < b.id JOIN term_rows x ON x.id = a.id JOIN term_rows y ON y.id = b.id LEFT JOIN dice s ON s.ta = least(a.title_norm, b.title_norm) AND s.tb = greatest(a.title_norm, b.title_norm)),
sig AS (SELECT item_a, item_b, CASE WHEN comparable THEN score END AS title_similarity, CASE WHEN comparable OR exact THEN score ELSE 0.0 END AS raw,
  CASE WHEN len(list_distinct(list_concat(xt, yt))) = 0 THEN 1.0 ELSE floor(len(st) / len(list_distinct(list_concat(xt, yt)))::DOUBLE * 10000 + 0.5) / 10000 END AS token_overlap,
  len(st)::INT AS n_terms, len(sp)::INT AS n_proper, h, floor(h * 10000 + 0.5) / 10000 AS hours_apart, same_hostname, same_category, different_provider FROM base),
pair_scores AS (SELECT item_a, item_b, title_similarity, token_overlap, n_terms, n_proper, hours_apart, same_hostname, same_category, different_provider,
  floor(least(1.0, 0.5::DOUBLE * raw + 0.2::DOUBLE * token_overlap + 0.2::DOUBLE * least(1.0, n_proper / 2.0::DOUBLE) + 0.05::DOUBLE * CASE WHEN h IS NULL THEN 0.5::DOUBLE ELSE greatest(0.0, 1 - h / 168.0::DOUBLE) END
  + 0.05::DOUBLE * same_category::INT + CASE WHEN different_provider THEN 0.05::DOUBLE ELSE 0 END) * 10000 + 0.5) / 10000 AS candidate_score FROM sig),
gated AS (SELECT * FROM pair_scores WHERE (hours_apart IS NULL OR hours_apart <= 168) AND (coalesce(title_similarity >= 0.3, false) OR token_overlap >= 0.25 AND n_proper >= 1 OR n_proper >= 2))"""


def flat(pairs: DataFrame) -> DataFrame:
    return pairs.select("item_a", "item_b", "title_similarity", "token_overlap", F.size("shared_terms").alias("n_terms"), F.size("shared_proper").alias("n_proper"), "hours_apart", "same_hostname", "same_category", "different_provider", "candidate_score")


@query(f"WITH {PAIR_SQL}, {RELATED_SQL.removeprefix(NORM_SQL).lstrip().lstrip(',').replace('gram_', 'long_gram_').replace('dice', 'long_dice')}, links AS (SELECT DISTINCT item_a, item_b FROM related) SELECT s.* FROM pair_scores s JOIN links USING (item_a, item_b)")
def candidate_scores(spark: SparkSession, d: str) -> DataFrame:
    """Signals and scores of all relationships."""
    normal_ = stored(normal(spark, d).select("id", "title", "title_norm", "url_norm", "terms", "proper", *candidates.ITEM))
    pairs = similarity.relationships(normal_).select(F.col("item_a").alias("id_a"), F.col("item_b").alias("id_b")).distinct()
    return flat(candidates.signals(pairs, normal_))


@query(f"WITH {PAIR_SQL} SELECT * FROM gated")
def candidate_gate(spark: SparkSession, d: str) -> DataFrame:
    """Every pair of items that passes the gate, with its signals and score."""
    return flat(candidates.gated_items(normal(spark, d)))


FLAT_SQL = "item_a, item_b, title_similarity, token_overlap, n_terms, n_proper, hours_apart, same_hostname, same_category, different_provider, candidate_score"


@query(f"""WITH RECURSIVE {PAIR_SQL.replace("gated AS (", "gated AS MATERIALIZED (")},
ordered AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY candidate_score DESC, item_a, item_b) AS place FROM gated),
greedy AS (SELECT 0::BIGINT AS place, []::VARCHAR[] AS used, 0 AS n, false AS taken
  UNION ALL SELECT place, CASE WHEN taken THEN list_concat(used, [item_a, item_b]) ELSE used END, n + taken::INT, taken
  FROM (SELECT o.place, o.item_a, o.item_b, g.used, g.n, len(list_filter(g.used, lambda x: x = o.item_a)) < 5 AND len(list_filter(g.used, lambda x: x = o.item_b)) < 5 AS taken
    FROM greedy g JOIN ordered o ON o.place = g.place + 1 WHERE g.n < 200))
SELECT {FLAT_SQL} FROM ordered JOIN greedy USING (place) WHERE taken""")
def candidate_topk(spark: SparkSession, d: str) -> DataFrame:
    return flat(candidates.candidates(normal(spark, d)))


# ---------------------------------------------------------------- judgments

JUDG_SQL = """judg AS (SELECT least('x:' || d.doc_id, 'x:' || e.doc_id) AS item_a, greatest('x:' || d.doc_id, 'x:' || e.doc_id) AS item_b,
  CASE WHEN e.doc_id = d.doc_id + 2 THEN 'different-event' WHEN d.doc_id % 3 < 2 THEN 'same-event' WHEN (d.doc_id // 3) % 2 = 0 THEN 'related-event' ELSE 'different-event' END AS relationship,
  (d.doc_id % 100) / 100.0::DOUBLE AS confidence, CASE WHEN d.doc_id % 70 = 0 THEN 'failed' ELSE 'ok' END AS status, d.doc_id FROM documents d JOIN documents e ON e.doc_id = d.doc_id + 1 OR e.doc_id = d.doc_id + 2)"""
HASH_SQL = rf"""{ITEMS_SQL}, {JUDG_SQL}, hashes AS (SELECT id, sha256(id || chr(31) || coalesce(title, '') || chr(31) || coalesce(summary, '') || chr(31) || coalesce(category, '') || chr(31) || coalesce(published_ms::VARCHAR, '')) AS content_hash FROM items),
keyed AS (SELECT j.*, sha256(item_a || chr(31) || item_b || chr(31) || a.content_hash || chr(31) || b.content_hash || chr(31) || 'external' || chr(31) || 'judge-v1') AS cache_key FROM judg j JOIN hashes a ON a.id = item_a JOIN hashes b ON b.id = item_b)"""


def judgments(spark: SparkSession, d: str) -> DataFrame:
    """External judgments stand in as a table: of every document with the next two by doc_id, labelled by arithmetic.

    Threes are the same event by their neighbours, which the judgment of the outer two contradicts.
    """
    docs = table(spark, d, "documents").select("doc_id")
    both = docs.select("doc_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("step")).join(docs.select(F.col("doc_id").alias("other")), F.expr("other = doc_id + step"))
    a, b = F.concat(F.lit("x:"), F.col("doc_id").cast("string")), F.concat(F.lit("x:"), F.col("other").cast("string"))
    kind = F.expr("CASE WHEN step = 2 THEN 'different-event' WHEN doc_id % 3 < 2 THEN 'same-event' WHEN (doc_id div 3) % 2 = 0 THEN 'related-event' ELSE 'different-event' END")
    return both.select(F.least(a, b).alias("item_a"), F.greatest(a, b).alias("item_b"), kind.alias("relationship"), ((F.col("doc_id") % 100) / 100.0).alias("confidence"), F.expr("CASE WHEN doc_id % 70 = 0 THEN 'failed' ELSE 'ok' END").alias("status"), "doc_id")


def keyed_judgments(spark: SparkSession, d: str) -> DataFrame:
    named = items(spark, d).withColumn("published_at", F.col("published_ms").cast("string"))
    return judging.with_cache_key(judgments(spark, d), named, CandidateConfig().model, CandidateConfig().judge_version)


@query(f"WITH {HASH_SQL} SELECT id, content_hash FROM hashes")
def content_hashes(spark: SparkSession, d: str) -> DataFrame:
    return judging.hashed(items(spark, d).withColumn("published_at", F.col("published_ms").cast("string")))


@query(f"WITH {HASH_SQL}, cache AS (SELECT * FROM keyed WHERE doc_id % 2 = 0) SELECT k.item_a, k.item_b, c.relationship, c.confidence, c.cache_key IS NOT NULL AS cache_hit FROM keyed k LEFT JOIN cache c ON c.cache_key = k.cache_key AND c.status = 'ok'")
def cache_probe(spark: SparkSession, d: str) -> DataFrame:
    """The cache holds the judgments of even doc_ids."""
    keyed = stored(keyed_judgments(spark, d))
    cache = keyed.where("doc_id % 2 = 0").select("cache_key", "relationship", "confidence", "status")
    return judging.probe(keyed.select("item_a", "item_b", "cache_key"), cache).select("item_a", "item_b", "relationship", "confidence", "cache_hit")


@query(f"""WITH {HASH_SQL}, cache AS (SELECT cache_key FROM keyed WHERE doc_id % 2 = 0 AND status = 'ok'), p AS (SELECT k.item_a, k.item_b, c.cache_key IS NOT NULL AS cache_hit FROM keyed k LEFT JOIN cache c USING (cache_key))
SELECT item_a, item_b, cache_hit, NOT cache_hit AND sum((NOT cache_hit)::INT) OVER (ORDER BY item_a, item_b ROWS UNBOUNDED PRECEDING) <= 20 AS requested FROM p""")
def request_limit(spark: SparkSession, d: str) -> DataFrame:
    keyed = stored(keyed_judgments(spark, d))
    cache = keyed.where("doc_id % 2 = 0").select("cache_key", "relationship", "confidence", "status")
    probed = judging.probe(keyed.select("item_a", "item_b", "cache_key"), cache).select("item_a", "item_b", "cache_hit")
    return judging.limited(probed, [F.asc("item_a"), F.asc("item_b")], 20, ["item_a", "item_b"])


@query(f"WITH {JUDG_SQL} SELECT status, relationship, count(*) AS n FROM judg GROUP BY ALL")
def judgment_counts(spark: SparkSession, d: str) -> DataFrame:
    return judging.status_counts(judgments(spark, d))


#: The same merge pair by pair: a row of `walk` for each same-event pair of a component, with what its clusters belong to.
MERGE_SQL = f"""{CLUSTERS_SQL}, {JUDG_SQL},
judged AS (SELECT relationship, item_a, item_b, p.root AS x, q.root AS y FROM judg JOIN members p ON p.id = item_a JOIN members q ON q.id = item_b WHERE status = 'ok'),
ways AS (SELECT x AS a, y AS b FROM judged WHERE relationship = 'same-event' UNION SELECT y, x FROM judged WHERE relationship = 'same-event'),
part_reach AS (SELECT a AS id, a AS l FROM ways UNION SELECT w.b, r.l FROM part_reach r JOIN ways w ON r.id = w.a),
part_of AS MATERIALIZED (SELECT id AS root, min(l) AS part FROM part_reach GROUP BY id),
apart AS MATERIALIZED (SELECT least(item_a, item_b) AS a, greatest(item_a, item_b) AS b, x, y FROM judged WHERE relationship = 'different-event'),
lists AS MATERIALIZED (SELECT u.part, list({{'a': a, 'b': b, 'x': x, 'y': y}}) AS forbidden FROM apart JOIN part_of u ON u.root = x JOIN part_of v ON v.root = y AND v.part = u.part GROUP BY u.part),
steps AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY item_a, item_b) AS turn, item_a, item_b, x, y FROM judged JOIN part_of ON root = x WHERE relationship = 'same-event'),
walk AS (SELECT part, 0::BIGINT AS turn, map_from_entries(list((root, root))) AS belongs, NULL::VARCHAR AS item_a, NULL::VARCHAR AS item_b, NULL::VARCHAR AS conflict_a, NULL::VARCHAR AS conflict_b FROM part_of GROUP BY part
  UNION ALL SELECT part, turn, CASE WHEN rx <> ry AND bad IS NULL THEN map_from_entries(list_transform(map_entries(belongs), lambda e: (e.key, CASE WHEN e.value IN (rx, ry) THEN least(rx, ry) ELSE e.value END))) ELSE belongs END,
    item_a, item_b, CASE WHEN rx <> ry THEN bad.a END, CASE WHEN rx <> ry THEN bad.b END
  FROM (SELECT s.*, list_min(list_filter(coalesce(l.forbidden, []), lambda p: belongs[p.x] IN (rx, ry) AND belongs[p.y] IN (rx, ry))) AS bad
    FROM (SELECT s.part, s.turn, s.item_a, s.item_b, w.belongs, w.belongs[s.x] AS rx, w.belongs[s.y] AS ry FROM walk w JOIN steps s ON s.part = w.part AND s.turn = w.turn + 1) s LEFT JOIN lists l ON l.part = s.part)),
ends AS (SELECT part, arg_max(belongs, turn) AS belongs FROM walk GROUP BY part),
merged AS (SELECT m.id, coalesce(e.belongs[m.root], m.root) AS root FROM members m LEFT JOIN part_of p ON p.root = m.root LEFT JOIN ends e ON e.part = p.part)"""


@query(f"""WITH RECURSIVE {MERGE_SQL}, named AS (SELECT root, 'cluster:' || sha256(string_agg(id, chr(10) ORDER BY id)) AS cluster_id, count(*) AS item_count FROM merged GROUP BY root)
SELECT id, cluster_id, item_count FROM merged JOIN named USING (root)""")
def semantic_clusters(spark: SparkSession, d: str) -> DataFrame:
    merged, _ = judging.merge(clustered(spark, d)[1], judgments(spark, d))
    merged = stored(merged)
    return clusters.named_members(merged, clusters.clusters(merged)).select("id", "cluster_id", "item_count")


@query(f"""WITH RECURSIVE {MERGE_SQL} SELECT item_a AS attempted_a, item_b AS attempted_b, conflict_a, conflict_b FROM walk WHERE conflict_a IS NOT NULL
UNION ALL SELECT NULL, NULL, a, b FROM apart JOIN merged u ON u.id = a JOIN merged v ON v.id = b AND v.root = u.root""")
def semantic_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return judging.merge(clustered(spark, d)[1], judgments(spark, d))[1]


# ---------------------------------------------------------------- evaluation

EVAL_SQL = rf"""{CLUSTERS_SQL},
ranked AS (SELECT n.*, m.root, row_number() OVER (PARTITION BY m.root ORDER BY published_ms DESC NULLS LAST, collected_ms DESC NULLS LAST, title IS NOT NULL DESC, coalesce(regexp_matches(summary, '\S'), false) DESC, n.id) AS rank
  FROM norm n JOIN members m ON m.id = n.id),
signals AS (SELECT root, count(*) AS item_count, count(DISTINCT nullif(url, '')) AS source_count, count(DISTINCT provider) AS source_diversity, array_to_string(list_sort(list(DISTINCT source_type)), '|') AS source_types,
  array_to_string(list_sort(list(DISTINCT provider)), '|') AS providers FROM ranked GROUP BY root),
scored AS (SELECT f.cluster_id, r.root, f.item_count, r.id AS rep_id, r.key, r.title, r.summary, r.category, r.provider, r.url, r.published_ms, CASE WHEN key % 11 = 0 THEN 'unevaluated' ELSE 'evaluated' END AS status,
  (1 + (key + f.item_count) % 5)::INT AS importance, (1 + (key // 5) % 5)::INT AS "informationValue", (1 + (key // 3) % 5)::INT AS impact, (1 + (key * 2 + 1) % 5)::INT AS novelty, (1 + (key // 7) % 5)::INT AS "personalRelevance"
  FROM ranked r JOIN found f USING (root) WHERE rank = 1),
based AS (SELECT *, floor((0.3::DOUBLE * importance + 0.25::DOUBLE * "informationValue" + 0.2::DOUBLE * impact + 0.15::DOUBLE * novelty + 0.1::DOUBLE * "personalRelevance") * 10000 + 0.5) / 10000 AS base_score FROM scored)"""
WITH_EVAL = f"WITH RECURSIVE {EVAL_SQL}"


def evaluated(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Items, membership, and one row a cluster with its representative, axes (by arithmetic) and base score."""
    rows, members = clustered(spark, d)
    found = clusters.clusters(members).select("root", "cluster_id", "item_count")
    rep = evaluation.representatives(evaluation.ranked_members(rows, members)).join(found, "root")
    axes = {"importance": "1 + (key + item_count) % 5", "informationValue": "1 + (key div 5) % 5", "impact": "1 + (key div 3) % 5", "novelty": "1 + (key * 2 + 1) % 5", "personalRelevance": "1 + (key div 7) % 5"}
    scored = rep.select(
        "cluster_id", "root", "item_count", F.col("id").alias("rep_id"), "key", "title", "summary", "category", "provider", "url", "published_ms", F.expr("CASE WHEN key % 11 = 0 THEN 'unevaluated' ELSE 'evaluated' END").alias("status"),
        *[F.expr(axes[a]).cast("int").alias(a) for a in AXES],
    )
    return rows, members, stored(scored.withColumn("base_score", evaluation.base_score(selection.axes(), EvaluationConfig().weights)))


@query(f"{WITH_EVAL} SELECT f.cluster_id, r.id, r.title FROM ranked r JOIN found f USING (root) WHERE rank = 1")
def representatives(spark: SparkSession, d: str) -> DataFrame:
    return evaluated(spark, d)[2].select("cluster_id", F.col("rep_id").alias("id"), "title")


@query(f"{WITH_EVAL} SELECT root, id, rank::INT AS rank FROM ranked WHERE rank BETWEEN 2 AND 5")
def supporting_items(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.supporting(evaluation.ranked_members(*clustered(spark, d))).select("root", "id", "rank")


@query(f"{WITH_EVAL} SELECT * FROM signals")
def cluster_signals(spark: SparkSession, d: str) -> DataFrame:
    found = evaluation.signals(*clustered(spark, d))
    return found.withColumns({"source_types": joined("source_types"), "providers": joined("providers")})


@query(f"""{WITH_EVAL} SELECT 'types' AS kind, replace(source_types, '|', '+') AS name, count(*) AS n FROM signals GROUP BY ALL
UNION ALL SELECT 'provider', name, count(*) FROM (SELECT unnest(string_split(providers, '|')) AS name FROM signals) GROUP BY name""")
def cluster_breakdown(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.breakdown(evaluation.signals(*clustered(spark, d)))


@query(f"""{WITH_EVAL} SELECT root, concat_ws('|', CASE WHEN key % 5 = 0 THEN 'item_count' END, CASE WHEN key % 7 = 0 THEN 'source_count' END, CASE WHEN key % 3 = 0 AND contains(providers, '|') THEN 'providers' END) AS faults
FROM signals JOIN scored USING (root) WHERE key % 11 <> 1 AND (key % 5 = 0 OR key % 7 = 0 OR key % 3 = 0 AND contains(providers, '|'))
UNION ALL SELECT root, 'item_count|source_count|source_diversity|source_types|providers' FROM scored WHERE key % 11 = 1""")
def evaluated_mismatches(spark: SparkSession, d: str) -> DataFrame:
    """Signals recomputed from items against stated ones with planted faults: counts, an order of providers, clusters that are not stated."""
    rows, members, scored = evaluated(spark, d)
    said = evaluation.signals(rows, members).join(scored.select("root", "key"), "root").where("key % 11 <> 1")
    plant = {"item_count": F.expr("item_count + CAST(key % 5 = 0 AS INT)"), "source_count": F.expr("source_count - CAST(key % 7 = 0 AS INT)"), "providers": F.when(F.col("key") % 3 == 0, F.reverse("providers")).otherwise(F.col("providers"))}
    return evaluation.mismatches(said.withColumns(plant), rows, members).select("root", joined("faults").alias("faults"))


@query(f"{WITH_EVAL} SELECT cluster_id, base_score FROM based")
def base_score(spark: SparkSession, d: str) -> DataFrame:
    return evaluated(spark, d)[2].select("cluster_id", "base_score")


@query(f"""{WITH_EVAL} SELECT b.cluster_id, row_number() OVER (ORDER BY b.item_count > 1 DESC, source_diversity DESC, b.item_count DESC, published_ms DESC NULLS LAST, b.cluster_id)::INT AS pos FROM based b JOIN signals s USING (root)""")
def evaluation_order(spark: SparkSession, d: str) -> DataFrame:
    rows, members, scored = evaluated(spark, d)
    return evaluation.evaluation_order(scored.join(evaluation.signals(rows, members).select("root", "source_diversity"), "root")).select("cluster_id", "pos")


# ---------------------------------------------------------------- selection

ELIGIBLE_SQL = rf"""{EVAL_SQL},
eligible AS (SELECT *, CASE WHEN status <> 'evaluated' THEN 'not-evaluated' WHEN "informationValue" <= 1 OR importance <= 2 AND impact <= 1 AND "informationValue" <= 2 THEN 'below-quality-floor' END AS reason FROM based),
lanes AS (SELECT *, floor((0.5::DOUBLE * importance + 0.3::DOUBLE * impact + 0.2::DOUBLE * "informationValue") * 10000 + 0.5) / 10000 AS major_rank,
  floor((0.4::DOUBLE * "personalRelevance" + 0.4::DOUBLE * "informationValue" + 0.2::DOUBLE * novelty) * 10000 + 0.5) / 10000 AS personal_rank,
  reason IS NULL AND importance >= 4 AND impact >= 3 AS major, reason IS NULL AND "personalRelevance" >= 4 AND "informationValue" >= 3 AS personal, reason IS NULL AND base_score >= 2.7 AS general FROM eligible)"""
WITH_LANES = f"WITH RECURSIVE {ELIGIBLE_SQL}"


def records(spark: SparkSession, d: str) -> DataFrame:
    return stored(selection.with_lanes(evaluated(spark, d)[2]))


@query(f"{WITH_LANES} SELECT cluster_id, reason IS NULL AS eligible, reason FROM eligible")
def eligibility(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).select("cluster_id", "eligible", "reason")


@query(f"""{WITH_LANES} SELECT cluster_id, major_rank, personal_rank, concat_ws('|', CASE WHEN major THEN 'major' END, CASE WHEN personal THEN 'personal' END, CASE WHEN general THEN 'general' END) AS lanes FROM lanes""")
def lanes_ranks(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).select("cluster_id", "major_rank", "personal_rank", joined("lanes").alias("lanes"))


def _hit_sql(keyword: str) -> str:
    escaped = keyword.lower().replace("'", "''")
    if len(keyword) >= 4 or not keyword.isascii() or not keyword.isalnum():
        return f"contains(h, '{escaped}')"
    return rf"regexp_matches(h, '(^|[^\p{{L}}\p{{N}}]){escaped}($|[^\p{{L}}\p{{N}}])')"


def _topic_sql() -> tuple[str, str]:
    """The same choice in SQL, over words that the synthetic texts have."""
    config = topic_config()
    hits = ", ".join("(" + " + ".join(f"{_hit_sql(k)}::INT" for k in config.keywords[g]) + f") AS {g}" for g in config.priority if g in config.keywords)
    best = "greatest(" + ", ".join(g for g in config.priority if g in config.keywords) + ")"
    cases = " ".join(f"WHEN {g} = {best} THEN '{g}'" for g in config.priority if g in config.keywords)
    fallback = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in config.fallback.items())
    return f"CASE WHEN {best} > 0 THEN CASE {cases} END ELSE CASE category {fallback} ELSE 'other' END END", hits


def topic_config() -> SelectConfig:
    """Keywords and categories that occur in the synthetic texts, beside the usual ones."""
    usual = SelectConfig()
    keywords = dict(usual.keywords) | {"space": (*usual.keywords["space"], "thed", "ing"), "economy": (*usual.keywords["economy"], "ou", "ntea"), "science": (*usual.keywords["science"], "der", "und")}
    return SelectConfig(keywords=keywords, fallback=dict(usual.fallback) | {"fr": "politics", "es": "social"})


_TOPIC, _HITS = _topic_sql()


@query(f"{WITH_LANES}, hay AS (SELECT cluster_id, category, lower(coalesce(title, '') || chr(10) || coalesce(summary, '')) AS h FROM based), hits AS (SELECT cluster_id, category, {_HITS} FROM hay) SELECT cluster_id, {_TOPIC} AS topic_group FROM hits")
def topic_groups(spark: SparkSession, d: str) -> DataFrame:
    return selection.with_topic(told(spark, d, evaluated(spark, d)[2], "rep_id"), topic_config()).select("cluster_id", "topic_group")


OVERLAP_SQL = r"""tt AS (SELECT DISTINCT title, title_norm, terms, proper FROM norm JOIN term_rows USING (id) WHERE title IS NOT NULL),
ov AS (SELECT * FROM (SELECT a.title AS title_a, b.title AS title_b, CASE WHEN a.title_norm = b.title_norm THEN 'exact-title'
  WHEN least(length(a.title_norm), length(b.title_norm)) >= 16 AND coalesce(s.score, 0) >= 0.72 AND len(list_intersect(a.proper, b.proper)) >= 2 THEN 'high-dice'
  WHEN len(list_intersect(a.terms, b.terms)) >= 3 AND len(list_filter(list_intersect(a.proper, b.proper), lambda t: length(t) >= 6 AND list_contains(list_intersect(a.terms, b.terms), t))) >= 1 THEN 'long-shared-term' END AS detail
  FROM tt a JOIN tt b ON a.title < b.title LEFT JOIN dice s ON s.ta = least(a.title_norm, b.title_norm) AND s.tb = greatest(a.title_norm, b.title_norm)) WHERE detail IS NOT NULL)"""
OVERLAP_PRELUDE = PAIR_SQL[: PAIR_SQL.index("base AS (SELECT a.id")].rstrip().rstrip(",")


@query(f"WITH {OVERLAP_PRELUDE}, {OVERLAP_SQL} SELECT title_a, title_b, detail FROM ov")
def title_overlap(spark: SparkSession, d: str) -> DataFrame:
    return selection.overlapping_titles(normal(spark, d).select("title"))


def judged_clusters(spark: SparkSession, d: str, members: DataFrame, recs: DataFrame) -> DataFrame:
    named = members.join(recs.select("root", "cluster_id"), "root").select("id", "cluster_id")
    related = judgments(spark, d).where("status = 'ok' AND relationship = 'related-event'")
    a = related.join(named.select(F.col("id").alias("item_a"), F.col("cluster_id").alias("cluster_a")), "item_a")
    return a.join(named.select(F.col("id").alias("item_b"), F.col("cluster_id").alias("cluster_b")), "item_b").select("cluster_a", "cluster_b")


def grouped_records(spark: SparkSession, d: str) -> DataFrame:
    rows, members, scored = evaluated(spark, d)
    recs = stored(selection.with_lanes(scored))
    return selection.related_groups(recs, judged_clusters(spark, d, members, recs))


TERMS_ONLY_SQL = TERMS_SQL.removeprefix(NORM_SQL).lstrip().lstrip(",")
GROUPS_SQL = rf"""{ELIGIBLE_SQL}, {JUDG_SQL}, {TERMS_ONLY_SQL}, {OVERLAP_SQL.replace("JOIN dice s", "JOIN dice_all s")},
group_edges AS (SELECT a.cluster_id AS a, b.cluster_id AS b FROM based a JOIN based b ON a.title = b.title AND a.cluster_id <> b.cluster_id
  UNION SELECT x.cluster_id, y.cluster_id FROM ov JOIN based x ON x.title = title_a JOIN based y ON y.title = title_b
  UNION SELECT x.cluster_id, y.cluster_id FROM judg j JOIN members p ON p.id = j.item_a JOIN members q ON q.id = j.item_b JOIN found x ON x.root = p.root JOIN found y ON y.root = q.root
    WHERE j.status = 'ok' AND j.relationship = 'related-event' AND x.cluster_id <> y.cluster_id),
group_ways AS (SELECT a, b FROM group_edges UNION SELECT b, a FROM group_edges),
group_reach AS (SELECT cluster_id AS id, cluster_id AS l FROM found UNION SELECT e.b, r.l FROM group_reach r JOIN group_ways e ON r.id = e.a),
group_of AS (SELECT id AS cluster_id, min(l) AS g FROM group_reach GROUP BY id),
group_ids AS (SELECT g, 'rel:' || left(sha256(string_agg(cluster_id, '|' ORDER BY cluster_id)), 16) AS related_group_id FROM group_of GROUP BY g),
roles AS (SELECT l.cluster_id, related_group_id, CASE WHEN row_number() OVER (PARTITION BY o.g ORDER BY major_rank DESC, "informationValue" DESC, published_ms DESC NULLS LAST, l.cluster_id) = 1 THEN 'main-event' ELSE 'related' END AS editorial_role
  FROM lanes l JOIN group_of o USING (cluster_id) JOIN group_ids USING (g))"""
DICE_ALL_SQL = PAIR_SQL[PAIR_SQL.index("all_titles AS") : PAIR_SQL.index("base AS (SELECT a.id")].rstrip().rstrip(",")
for _old in ("gram_rows", "gram_counts", "gram_sizes", "dice"):
    DICE_ALL_SQL = DICE_ALL_SQL.replace(_old, f"{_old}_all")
GROUPS_SQL = GROUPS_SQL.replace(", tt AS", f", {DICE_ALL_SQL}, tt AS", 1)


@query(f"WITH RECURSIVE {GROUPS_SQL} SELECT cluster_id, related_group_id FROM roles")
def related_groups(spark: SparkSession, d: str) -> DataFrame:
    return grouped_records(spark, d).select("cluster_id", "related_group_id")


@query(f"WITH RECURSIVE {GROUPS_SQL} SELECT cluster_id, editorial_role FROM roles")
def main_event(spark: SparkSession, d: str) -> DataFrame:
    return grouped_records(spark, d).select("cluster_id", "editorial_role")


def packed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    recs = stored(selection.with_topic(told(spark, d, grouped_records(spark, d), "rep_id"), topic_config()))
    return recs, stored(selection.pack(recs))


#: The same choice one by one: a row of `walk` for each place of the three lanes.
PACK_SQL = rf"""{GROUPS_SQL}, hay AS (SELECT cluster_id, category, lower(coalesce(title, '') || chr(10) || coalesce(summary, '')) AS h FROM based), hits AS (SELECT cluster_id, category, {_HITS} FROM hay),
recs AS MATERIALIZED (SELECT l.*, editorial_role, {_TOPIC.replace("category", "hits.category")} AS topic_group FROM lanes l JOIN roles USING (cluster_id) JOIN hits ON hits.cluster_id = l.cluster_id),
mains AS (SELECT * FROM recs WHERE reason IS NULL AND editorial_role = 'main-event'),
queue AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY lane_no, place) AS turn FROM (
  SELECT cluster_id, topic_group, 'major' AS lane, 1 AS lane_no, row_number() OVER (ORDER BY major_rank DESC, "informationValue" DESC, published_ms DESC NULLS LAST, cluster_id) AS place, major_rank AS priority FROM mains WHERE major
  UNION ALL SELECT cluster_id, topic_group, 'personal', 2, row_number() OVER (ORDER BY personal_rank DESC, published_ms DESC NULLS LAST, cluster_id), personal_rank FROM mains WHERE personal
  UNION ALL SELECT cluster_id, topic_group, 'general', 3, row_number() OVER (ORDER BY base_score DESC, importance DESC, published_ms DESC NULLS LAST, cluster_id), base_score FROM mains WHERE general)),
walk AS (SELECT 0::BIGINT AS turn, []::VARCHAR[] AS chosen, []::VARCHAR[] AS topics, []::VARCHAR[] AS filled, NULL::VARCHAR AS outcome
  UNION ALL SELECT turn, CASE WHEN outcome = 'selected' THEN list_append(chosen, cluster_id) ELSE chosen END, CASE WHEN outcome = 'selected' THEN list_append(topics, topic_group) ELSE topics END,
    CASE WHEN outcome = 'selected' THEN list_append(filled, lane) ELSE filled END, outcome
  FROM (SELECT q.*, w.chosen, w.topics, w.filled, len(list_filter(w.topics, lambda x: x = q.topic_group)) AS n, CASE WHEN list_contains(w.chosen, q.cluster_id) THEN 'again'
    WHEN len(w.chosen) >= CASE WHEN lane = 'general' THEN 10 ELSE 14 END THEN 'digest-size' WHEN len(list_filter(w.filled, lambda x: x = q.lane)) >= CASE lane WHEN 'major' THEN 7 WHEN 'personal' THEN 4 ELSE 14 END THEN 'lower-priority'
    WHEN NOT (n < 2 OR n < 3 AND lane <> 'general' OR n >= 3 AND lane = 'major' AND q.place <= 3) THEN 'category-saturation' ELSE 'selected' END AS outcome FROM walk w JOIN queue q ON q.turn = w.turn + 1)),
picked AS (SELECT q.*, row_number() OVER (ORDER BY turn) AS rank FROM walk JOIN queue q USING (turn) WHERE outcome = 'selected'),
skipped AS (SELECT cluster_id, arg_min(outcome, turn) AS why FROM walk JOIN queue USING (turn) WHERE outcome NOT IN ('selected', 'again') GROUP BY cluster_id),
decided AS (SELECT r.cluster_id, CASE WHEN p.rank IS NULL THEN 'rejected' ELSE 'selected' END AS decision,
  CASE p.lane WHEN 'major' THEN 'major-news' WHEN 'personal' THEN 'personal-interest' WHEN 'general' THEN 'general-high-value'
    ELSE CASE WHEN r.reason IS NOT NULL THEN r.reason WHEN editorial_role = 'related' THEN 'redundant' ELSE coalesce(s.why, 'below-lane-threshold') END END AS reason,
  coalesce(p.lane, CASE WHEN major THEN 'major' WHEN personal THEN 'personal' WHEN general THEN 'general' END) AS lane, p.rank::INT AS rank, p.priority AS priority
  FROM recs r LEFT JOIN picked p USING (cluster_id) LEFT JOIN skipped s ON s.cluster_id = r.cluster_id)"""


@query(f"WITH RECURSIVE {PACK_SQL} SELECT * FROM decided")
def pack_selection(spark: SparkSession, d: str) -> DataFrame:
    return packed(spark, d)[1]


@query(f"WITH RECURSIVE {PACK_SQL} SELECT decision, CASE WHEN decision = 'selected' THEN lane ELSE reason END AS name, count(*) AS n FROM decided GROUP BY ALL")
def select_stats(spark: SparkSession, d: str) -> DataFrame:
    return selection.stats(packed(spark, d)[1])


@query(f"{WITH_EVAL} SELECT cluster_id FROM based WHERE key % 13 = 0 UNION ALL SELECT cluster_id FROM based WHERE key % 13 <> 0 AND key % 17 = 1")
def select_partition(spark: SparkSession, d: str) -> DataFrame:
    """Decisions with planted faults: clusters that none names and clusters that two name."""
    scored = evaluated(spark, d)[2]
    decided = scored.where("key % 13 <> 0").select("cluster_id").unionByName(scored.where("key % 13 <> 0 AND key % 17 = 1").select("cluster_id"))
    return selection.partition_errors(scored, decided)


# ---------------------------------------------------------------- digest

DIGEST_SQL = rf"{EVAL_SQL}, top AS (SELECT *, row_number() OVER (ORDER BY base_score DESC, item_count DESC, cluster_id) AS rank FROM based)"


def all_selected(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Every cluster as if it were selected, in order of its score, and their items: what an edition's join works on."""
    rows, members, scored = evaluated(spark, d)
    ranked = with_position(scored, [F.desc("base_score"), F.desc("item_count"), F.asc("cluster_id")], "rank").withColumn("lane", F.expr("CASE WHEN key % 2 = 0 THEN 'major' ELSE 'personal' END"))
    joined_ = digest.joined(ranked.select("cluster_id", "rank", "lane"), clusters.named_members(members, clusters.clusters(members)), rows)
    return ranked, joined_.join(ranked.select("cluster_id", "rep_id"), "cluster_id").withColumn("is_representative", F.col("id") == F.col("rep_id"))


def edition(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The clusters that the packing selected, and their items."""
    rows, members, scored = evaluated(spark, d)
    recs = stored(selection.with_lanes(scored))
    recs = stored(selection.with_topic(told(spark, d, selection.related_groups(recs, judged_clusters(spark, d, members, recs)), "rep_id"), topic_config()))
    chosen = selection.pack(recs).where("decision = 'selected'").select("cluster_id", "lane", "rank")
    top = stored(recs.drop("lane", "rank").join(chosen, "cluster_id"))
    joined_ = digest.joined(top.select("cluster_id", "rank", "lane"), clusters.named_members(members, clusters.clusters(members)), rows)
    return top, joined_.join(top.select("cluster_id", "rep_id"), "cluster_id").withColumn("is_representative", F.col("id") == F.col("rep_id"))


@query(f"WITH RECURSIVE {DIGEST_SQL.replace('members AS (', 'members AS MATERIALIZED (', 1)} SELECT t.cluster_id, t.rank AS sel_rank, m.id, i.provider FROM top t JOIN members m ON m.root = t.root JOIN items i ON i.id = m.id")
def digest_join(spark: SparkSession, d: str) -> DataFrame:
    return all_selected(spark, d)[1].select("cluster_id", "sel_rank", "id", "provider")


@query(f"""WITH RECURSIVE {DIGEST_SQL}, m AS (SELECT t.cluster_id, r.id, r.id = t.rep_id AS rep, coalesce(r.provider, '') AS p, coalesce(r.url, '') AS u, coalesce('url:' || nullif(r.url, ''), 'id:' || r.id) AS same FROM top t JOIN ranked r USING (root)),
f AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY cluster_id, same ORDER BY rep DESC, p, u, id) = 1) SELECT cluster_id, id, row_number() OVER (PARTITION BY cluster_id ORDER BY rep DESC, p, u, id)::INT AS pos FROM f""")
def digest_sources(spark: SparkSession, d: str) -> DataFrame:
    return digest.sources(all_selected(spark, d)[1]).select("cluster_id", "id", "pos")


@query(f"""WITH RECURSIVE {DIGEST_SQL} SELECT cluster_id, id, pos::INT AS pos FROM (SELECT t.cluster_id, r.id, row_number() OVER (PARTITION BY t.cluster_id ORDER BY r.published_ms DESC NULLS LAST, r.id) AS pos
FROM top t JOIN ranked r USING (root) WHERE r.id <> t.rep_id) WHERE pos <= {DigestConfig().max_supporting}""")
def digest_supporting(spark: SparkSession, d: str) -> DataFrame:
    return digest.supporting(all_selected(spark, d)[1]).select("cluster_id", "id", "pos")


@query(f"WITH RECURSIVE {DIGEST_SQL} SELECT cluster_id, title AS headline, summary, NULL::VARCHAR AS why FROM top")
def digest_fallback(spark: SparkSession, d: str) -> DataFrame:
    text_ = digest.fallback(F.col("title"), F.col("summary"))
    return told(spark, d, all_selected(spark, d)[0], "rep_id").select("cluster_id", *[c.alias(n) for n, c in text_.items()])


@query("SELECT event_id, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d') AS digest_date FROM events")
def digest_date(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", time.civil_date(F.col("ts").cast("timestamp"), DigestConfig().zone).alias("digest_date"))


@query()
def digest_markdown(spark: SparkSession, d: str) -> DataFrame:
    top, members = edition(spark, d)
    n = digest.sources(members).groupBy("cluster_id").agg(F.count("*").cast("int").alias("n_sources"))
    rows = top.join(n, "cluster_id").select("lane", "rank", F.col("title").alias("headline"), "summary", F.lit(None).cast("string").alias("why"), "provider", "url", "n_sources")
    return digest.markdown(rows, F.lit("2024-01-31"))


@query(r"""SELECT page_id, page_id % 2 = 0 AS grounded FROM pages""")
def url_grounding(spark: SparkSession, d: str) -> DataFrame:
    given = F.concat(F.lit("see "), F.col("url"), F.lit(" now"))
    made = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("as "), F.col("url"))).otherwise("as https://elsewhere.example/x")
    return table(spark, d, "pages").select("page_id", text.urls_grounded(made, given).alias("grounded"))


PHRASES = ["idiot", "stupid", "Der", "ü"]


@query(r"""SELECT doc_id, CASE WHEN contains(lower(text), 'idiot') THEN 'idiot' WHEN contains(lower(text), 'stupid') THEN 'stupid' WHEN contains(lower(text), 'der') THEN 'Der' WHEN contains(text, 'ü') THEN 'ü' END AS phrase FROM documents""")
def banned_phrases(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", text.banned_phrase(F.col("text"), PHRASES).alias("phrase"))


@query(r"""SELECT doc_id, 'sent [redacted] with Bearer [redacted] and Authorization: [redacted] by ' || source AS redacted FROM documents""")
def redaction(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("doc_id").cast("string")
    raw = F.concat(F.lit("sent sk-ab_"), n, F.lit(" with bearer tok"), n, F.lit(" and authorization: Q"), n, F.lit(" by "), F.col("source"))
    return table(spark, d, "documents").select("doc_id", text.redacted(raw).alias("redacted"))


# ---------------------------------------------------------------- references

REF_SQL = r"""r AS (SELECT doc_id, 'x:' || doc_id AS id, (doc_id % 7)::INT AS v FROM documents WHERE doc_id % 4 <> 3),
cand AS (SELECT doc_id, id, v AS value, CASE WHEN doc_id % 3 = 0 THEN 'evidence|photo' WHEN doc_id % 3 = 1 THEN 'other' ELSE 'diagram' END AS roles,
  'https://pbs.twimg.com/media/' || doc_id || '?format=jpg&name=small' AS media_url FROM r WHERE v BETWEEN 3 AND 5 AND doc_id % 5 <> 0)"""


def reference_rows(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("doc_id")
    url = F.concat(F.lit("https://pbs.twimg.com/media/"), n.cast("string"), F.when(n % 5 == 0, F.lit("?token=1")).otherwise(F.lit("?name=small&size=4&format=jpg#x")))
    entry = F.struct(F.lit("image").alias("type"), url.alias("url"), F.lit(None).cast("string").alias("previewUrl"), F.lit(None).cast("string").alias("altText"), F.lit(640).alias("width"), F.lit(-1).alias("height"))
    roles = F.when(n % 3 == 0, F.array(F.lit("photo"), F.lit("other"), F.lit("evidence"))).when(n % 3 == 1, F.array(F.lit("other"))).otherwise(F.array(F.lit("diagram"), F.lit("diagram")))
    kind = F.when(n % 4 == 3, F.lit("web")).otherwise("x")
    return table(spark, d, "documents").select("doc_id", F.concat(F.lit("x:"), n.cast("string")).alias("id"), kind.alias("source_type"), (n % 7).cast("int").alias("value"), roles.alias("roles"), F.array(entry).alias("media"))


@query(f"WITH {REF_SQL} SELECT id, value, roles, media_url FROM cand")
def references_candidates(spark: SparkSession, d: str) -> DataFrame:
    return references.candidates(reference_rows(spark, d)).select("id", "value", joined("roles").alias("roles"), F.col("media")[0]["url"].alias("media_url"))


@query(f"WITH {REF_SQL} SELECT count(*) AS input_candidates, count(*) FILTER (value >= 4) AS selected, count(*) FILTER (value < 4) AS secondary, count(*) FILTER (contains(roles, 'evidence')) AS evidence FROM cand")
def references_selection(spark: SparkSession, d: str) -> DataFrame:
    return references.stats(references.selection(references.candidates(reference_rows(spark, d))))


@query("SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN 'https://pbs.twimg.com/media/' || doc_id || '?format=jpg&name=small' END AS url, CASE WHEN doc_id % 5 <> 0 THEN 640 END AS width, NULL::INT AS height FROM documents")
def media_normalized(spark: SparkSession, d: str) -> DataFrame:
    first = F.get(references.media(F.col("media")), F.lit(0))
    return reference_rows(spark, d).select("doc_id", first["url"].alias("url"), first["width"].alias("width"), first["height"].alias("height"))


@query("SELECT doc_id, CASE WHEN doc_id % 7 BETWEEN 1 AND 5 THEN CASE WHEN doc_id % 3 = 0 THEN 'evidence|photo' WHEN doc_id % 3 = 1 THEN 'other' ELSE 'diagram' END ELSE '' END AS roles FROM documents")
def visual_roles(spark: SparkSession, d: str) -> DataFrame:
    return reference_rows(spark, d).select("doc_id", joined(references.visual_roles(F.col("value"), F.col("roles"))).alias("roles"))


# ---------------------------------------------------------------- checks


@query(r"""SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 'x_same_run_fetch_required' WHEN event_id % 11 = 0 THEN 'x_collection_unverified' WHEN event_id % 7 = 0 THEN 'x_collection_invalid' WHEN event_id % 72 > 36 THEN 'x_collection_stale' END AS fault FROM events""")
def freshness_gate(spark: SparkSession, d: str) -> DataFrame:
    n, now = F.col("event_id"), F.lit("2024-03-01T00:00:00Z")
    late = F.timestamp_seconds(F.unix_timestamp(F.lit("2024-03-01 00:00:00")) - (n % 72) * 3600)
    at = F.date_format(late, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = table(spark, d, "events").select(
        "event_id", F.lit("succeeded").alias("fetch_status"), F.when(n % 13 == 0, "other").otherwise("run").alias("fetch_run"), F.lit("run").alias("run_id"), now.alias("fetched_at"), F.lit("2024-02-29T23:00:00Z").alias("started_at"),
        F.when(n % 11 == 0, F.lit(None).cast("string")).when(n % 7 == 0, "2024-02-30T00:00:00Z").otherwise(at).alias("collected_at"), now.alias("exported_at"), now.alias("now"),
    )
    return rows.select("event_id", checks.freshness().alias("fault"))


@query(f"WITH {ITEMS_SQL} SELECT id, CASE WHEN 1706659200000 - published_ms > 604800000 THEN 'web_metadata_old' END AS diagnostic FROM items WHERE source_type = 'web'")
def web_age_diagnostic(spark: SparkSession, d: str) -> DataFrame:
    return items(spark, d).where("source_type = 'web'").select("id", checks.web_age(F.col("published_ms"), F.lit(1706659200000)).alias("diagnostic"))


@query("SELECT 'x:' || doc_id AS key, rule FROM documents, (VALUES ('source-provider', 17), ('scores', 19)) v(rule, k) WHERE doc_id % k = 0")
def schema_violations(spark: SparkSession, d: str) -> DataFrame:
    """Documents as nested items, some without provider or scores."""
    n = F.col("doc_id")
    source = F.struct(F.lit("x").alias("type"), F.when(n % 17 == 0, " ").otherwise(F.col("source")).alias("provider"))
    scores = F.when(n % 19 != 0, F.struct(*[F.lit(1.0).alias(s) for s in ("informationValue", "personalRelevance", "impact", "attentionSignal", "importance")]))
    rows = table(spark, d, "documents").select(F.concat(F.lit("x:"), n.cast("string")).alias("id"), source.alias("source"), scores.alias("scores"))
    return checks.broken(rows, "id", checks.item_rules())


# ---------------------------------------------------------------- what stages hand on


@query(f"{WITH_CLUSTERS} SELECT cluster_id, item_count, row_number() OVER (ORDER BY item_count DESC, cluster_id) AS pos FROM found")
def cluster_order(spark: SparkSession, d: str) -> DataFrame:
    return documents.cluster_order(clusters.clusters(clustered(spark, d)[1])).select("cluster_id", "item_count", "pos")


@query(f"WITH RECURSIVE {GROUPS_SQL} SELECT related_group_id, n, row_number() OVER (ORDER BY n DESC, related_group_id) AS pos FROM (SELECT related_group_id, count(*) AS n FROM roles GROUP BY related_group_id)")
def group_order(spark: SparkSession, d: str) -> DataFrame:
    return documents.group_order(grouped_records(spark, d))


@query(f"""WITH RECURSIVE {GROUPS_SQL}, of_title AS (SELECT title, min(cluster_id) AS first FROM based WHERE title IS NOT NULL GROUP BY title),
evidence AS (SELECT least(x.cluster_id, y.cluster_id) AS cluster_a, greatest(x.cluster_id, y.cluster_id) AS cluster_b, 'semantic-related-event' AS kind, 'related-event' AS detail
    FROM judg j JOIN members p ON p.id = j.item_a JOIN members q ON q.id = j.item_b JOIN found x ON x.root = p.root JOIN found y ON y.root = q.root WHERE j.status = 'ok' AND j.relationship = 'related-event' AND x.cluster_id <> y.cluster_id
  UNION SELECT t.first, b.cluster_id, 'title-overlap', 'exact-title' FROM based b JOIN of_title t USING (title) WHERE b.cluster_id <> t.first
  UNION SELECT least(x.first, y.first), greatest(x.first, y.first), 'title-overlap', detail FROM ov JOIN of_title x ON x.title = title_a JOIN of_title y ON y.title = title_b)
SELECT cluster_a, cluster_b, kind, detail, related_group_id, row_number() OVER (PARTITION BY related_group_id ORDER BY kind, cluster_a, cluster_b, detail) AS pos FROM evidence JOIN roles ON roles.cluster_id = cluster_a""")
def evidence_order(spark: SparkSession, d: str) -> DataFrame:
    rows, members, scored = evaluated(spark, d)
    recs = stored(selection.with_lanes(scored))
    judged = stored(judged_clusters(spark, d, members, recs))
    named = selection.related_groups(recs, judged).select(F.col("cluster_id").alias("cluster_a"), "related_group_id")
    return documents.evidence_order(selection.group_edges(recs, judged).join(named, "cluster_a"))


@query(f"WITH RECURSIVE {PACK_SQL} SELECT *, row_number() OVER (PARTITION BY decision ORDER BY CASE WHEN decision = 'selected' THEN rank END, cluster_id) AS pos FROM decided")
def decision_order(spark: SparkSession, d: str) -> DataFrame:
    return documents.decision_order(packed(spark, d)[1])


@query(f"WITH {REF_SQL} SELECT id, value, row_number() OVER (ORDER BY value DESC, id) AS pos FROM cand")
def reference_order(spark: SparkSession, d: str) -> DataFrame:
    return documents.reference_order(references.candidates(reference_rows(spark, d))).select("id", "value", "pos")


@query(f"{WITH_EVAL} SELECT cluster_id, rep_id AS item_id, title, category, provider, url FROM based")
def representative_fields(spark: SparkSession, d: str) -> DataFrame:
    rows = evaluated(spark, d)[2].withColumnRenamed("rep_id", "id").withColumns({"source_type": F.split("id", ":")[0], "published_at": F.col("published_ms").cast("string")})
    r = documents.representative()
    return rows.select("cluster_id", r["itemId"].alias("item_id"), r["title"].alias("title"), r["category"].alias("category"), r["source"]["provider"].alias("provider"), r["source"]["url"].alias("url"))


@query(f"""WITH {HASH_SQL}, cache AS (SELECT cache_key FROM keyed WHERE doc_id % 2 = 0 AND status = 'ok'), p AS (SELECT k.*, c.cache_key IS NOT NULL AS hit FROM keyed k LEFT JOIN cache c USING (cache_key))
SELECT count(*) AS candidates, count(*) FILTER (hit) AS cache_hits, count(*) FILTER (NOT hit) AS cache_misses, count(*) FILTER (NOT hit) AS estimated_requests,
  count(*) FILTER (status = 'ok' AND relationship = 'same-event') AS same_event, count(*) FILTER (status = 'ok' AND relationship = 'related-event') AS related_event, count(*) FILTER (status = 'ok' AND relationship = 'different-event') AS different_event,
  count(*) FILTER (status = 'failed') AS failed, count(*) AS judged, 0::BIGINT AS unjudged, false AS dry_run FROM p""")
def semantic_stats(spark: SparkSession, d: str) -> DataFrame:
    keyed = stored(keyed_judgments(spark, d))
    cache = keyed.where("doc_id % 2 = 0").select("cache_key", "relationship", "confidence", "status")
    probed = judging.probe(keyed.select("item_a", "item_b", "cache_key"), cache)
    return documents.semantic_stats(judging.limited(probed, [], None, []), True, keyed)


@query(f"""WITH {NORM_SQL}, firsts AS (SELECT id, min(id) OVER (PARTITION BY title_norm) AS first FROM norm WHERE title_norm IS NOT NULL),
h AS (SELECT f.first AS item_a, f.id AS item_b, floor(abs(a.published_ms - b.published_ms) / 3600000.0::DOUBLE * 10000 + 0.5) / 10000 AS h FROM firsts f JOIN norm a ON a.id = f.first JOIN norm b ON b.id = f.id WHERE f.id <> f.first)
SELECT item_a, item_b, CASE WHEN h IS NULL THEN 'n/a' WHEN h < 10 THEN printf('%.1f', floor(h * 10 + 0.5) / 10) || 'h' ELSE floor(h + 0.5)::BIGINT || 'h' END AS hours FROM h""")
def hours_text(spark: SparkSession, d: str) -> DataFrame:
    return hours_apart_pairs(spark, d).select("item_a", "item_b", documents.hours_text(F.col("hours")).alias("hours"))


# ---------------------------------------------------------------- models


@query(f"""{WITH_EVAL} SELECT b.cluster_id, b.rep_id, CASE WHEN length(b.summary) > 400 THEN left(b.summary, 400) || '…' ELSE b.summary END AS summary, s.item_count, s.providers,
  (SELECT count(*) FROM ranked r WHERE r.root = b.root AND r.rank BETWEEN 2 AND 5) AS n_supporting FROM based b JOIN signals s USING (root)""")
def evaluation_requests(spark: SparkSession, d: str) -> DataFrame:
    """What an evaluator is given, read back from its JSON."""
    rows, members = clustered(spark, d)
    ranked = told(spark, d, evaluation.ranked_members(rows, members), most=EvaluationConfig().clip + 1)
    ranked = stored(ranked.withColumn("published_at", F.col("published_ms").cast("string")))
    found = clusters.clusters(members).select("root", "cluster_id")
    facts = evaluation.representatives(ranked).join(evaluation.signals(rows, members), "root").join(found, "root")
    asked = answers.evaluation_requests(facts, evaluation.supporting(ranked).withColumnRenamed("rank", "pos"))
    get = lambda p: F.get_json_object("request", p)
    listed = F.array_join(F.from_json(get("$.signals.providers"), "array<string>"), "|")
    return asked.select("cluster_id", F.col("id").alias("rep_id"), get("$.representative.summary").alias("summary"), get("$.signals.itemCount").cast("long").alias("item_count"), listed.alias("providers"), F.json_array_length(get("$.supportingItems")).cast("long").alias("n_supporting"))


@query("SELECT doc_id, doc_id % 5 IN (0, 2, 3) AS hidden FROM documents")
def hidden_fields(spark: SparkSession, d: str) -> DataFrame:
    """Requests of which some show a verdict: on top, in the representative, deep inside, only in a quoted text, nowhere."""
    n = F.col("doc_id")
    quoted = F.lit('he said "reason": none')
    request = (
        F.when(n % 5 == 0, F.to_json(F.struct(F.lit(1).alias("rank"), "text"))).when(n % 5 == 1, F.to_json(F.struct(quoted.alias("title"), "text")))
        .when(n % 5 == 2, F.to_json(F.struct(F.struct(F.lit(2).alias("personalRelevance")).alias("representative")))).when(n % 5 == 3, F.to_json(F.struct(F.array(F.struct(F.lit(3.5).alias("baseScore"))).alias("list")))).otherwise(F.to_json(F.struct("text")))
    )
    return table(spark, d, "documents").select("doc_id", answers.shows_hidden(request).alias("hidden"))


def _evaluator(request: dict) -> dict:
    n = request["doc_id"]
    if n % 23 == 0:
        raise ValueError("service down")
    scores = {a: 1 + (n + k) % 5 for k, a in enumerate(AXES)}
    if n % 19 == 0:
        scores.pop(AXES[2])
    return {"scores": scores | ({AXES[0]: 2.5} if n % 17 == 0 else {}), "reason": None if n % 13 == 0 else " r "}


@query("""WITH e AS (SELECT doc_id, CASE WHEN doc_id % 23 = 0 THEN 'service down' WHEN doc_id % 13 = 0 THEN 'invalid-reason' WHEN doc_id % 17 = 0 THEN 'invalid-score' WHEN doc_id % 19 = 0 THEN 'missing-axis' END AS error FROM documents)
SELECT doc_id, error, CASE WHEN error IS NULL THEN 'ok' ELSE 'failed' END AS status, CASE WHEN error IS NULL THEN (1 + doc_id % 5)::INT END AS importance, CASE WHEN error IS NULL THEN (1 + (doc_id + 4) % 5)::INT END AS "personalRelevance",
CASE WHEN error IS NULL THEN 'r' END AS reason FROM e""")
def evaluator_answers(spark: SparkSession, d: str) -> DataFrame:
    """A model by arithmetic, some of whose answers break a rule."""
    rows = table(spark, d, "documents").select("doc_id", F.to_json(F.struct("doc_id")).alias("request"))
    return answers.evaluate(rows, _evaluator).select("doc_id", "error", "status", "importance", "personalRelevance", "reason")


def _generator(request: dict) -> dict:
    n = request["doc_id"]
    text = {"headline": f"Headline of {n:06}", "summary": f"Summary of {n}.", "whyItMatters": "Because."}
    bad = {0: {"headline": "short"}, 1: {"summary": "https://made.up/x"}, 2: {"whyItMatters": "今後が注目される"}, 3: {"summary": 5}}
    return text | (bad[n // 7 % 4] if n % 7 == 0 else {})


@query("""WITH e AS (SELECT doc_id, text, source, CASE WHEN doc_id % 7 = 0 THEN ['invalid-headline-length', 'ungrounded-url', 'banned-why-phrase', 'invalid-fields'][1 + (doc_id // 7) % 4] END AS error FROM documents)
SELECT doc_id, error, CASE WHEN error IS NULL THEN 'ok' ELSE 'fallback' END AS status, CASE WHEN error IS NULL THEN printf('Headline of %06d', doc_id) ELSE source END AS headline,
CASE WHEN error IS NULL THEN 'Summary of ' || doc_id || '.' ELSE text END AS body, CASE WHEN error IS NULL THEN 'Because.' END AS why FROM e""")
def generator_answers(spark: SparkSession, d: str) -> DataFrame:
    """A generator by arithmetic; texts that break a rule give way to the item's own."""
    rows = table(spark, d, "documents").select("doc_id", F.col("source").alias("title"), F.col("text").alias("summary"), F.to_json(F.struct("doc_id")).alias("request"))
    return answers.generate(rows, _generator).select("doc_id", "error", "status", "headline", "body", "why")


# ---------------------------------------------------------------- input checks


@query(f"""WITH {ITEMS_SQL} SELECT CASE WHEN key % 31 = 0 THEN ' ' ELSE id END AS key, r AS rule FROM items, (VALUES ('cluster-id', 31, 0), ('items', 37, 1), ('unique-items', 41, 2), ('item-ids', 43, 3)) v(r, m, s)
WHERE key % m = 0 AND (s = 0 OR s = 1 OR s = 2 AND key % 37 <> 0 OR s = 3 AND key % 37 <> 0 AND key % 41 <> 0)
UNION ALL SELECT ' ', 'duplicate' FROM items WHERE key % 31 = 0 HAVING count(*) > 1""")
def stage_input_faults(spark: SparkSession, d: str) -> DataFrame:
    """Clusters of one item with planted faults: a blank id, no items, an item twice, a blank item."""
    n = F.col("key")
    ids_ = F.when(n % 37 == 0, F.array().cast("array<string>")).when(n % 41 == 0, F.array("id", "id")).when(n % 43 == 0, F.array("id", F.lit(""))).otherwise(F.array("id"))
    rows = items(spark, d).select(F.when(n % 31 == 0, " ").otherwise(F.col("id")).alias("cluster_id"), ids_.alias("item_ids"))
    return checks.stage_input(rows, checks.cluster_rules())


@query(f"WITH {ITEMS_SQL} SELECT id AS cluster_id FROM items WHERE key % 29 = 0 OR key % 31 = 0 OR key % 37 = 0")
def membership_changes(spark: SparkSession, d: str) -> DataFrame:
    """Clusters that lost an item, that changed its order, that are gone."""
    before = items(spark, d).select("key", F.col("id").alias("cluster_id"), F.array("id", F.concat("id", F.lit("b"))).alias("item_ids"))
    now = F.when(F.col("key") % 29 == 0, F.slice("item_ids", 1, 1)).when(F.col("key") % 31 == 0, F.reverse("item_ids")).otherwise(F.col("item_ids"))
    after = before.where("key % 37 <> 0").select("cluster_id", now.alias("item_ids"))
    return checks.membership_changes(before, after)


@query("SELECT doc_id::VARCHAR AS cluster_id, CASE WHEN doc_id % 11 = 0 THEN 'missing' WHEN doc_id % 13 = 0 THEN 'rank-changed' ELSE 'order' END AS rule FROM documents WHERE doc_id % 11 = 0 OR doc_id % 13 = 0 OR doc_id % 17 = 0")
def digest_order_faults(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("doc_id")
    chosen = table(spark, d, "documents").select("doc_id", n.cast("string").alias("cluster_id"), (n + 1).cast("int").alias("rank"))
    rank = F.when(n % 13 == 0, F.col("rank") + 1).otherwise(F.col("rank"))
    made = chosen.where("doc_id % 11 <> 0").select("cluster_id", rank.alias("rank"), F.when(n % 17 == 0, rank + 1).otherwise(rank).alias("display_order"))
    return checks.digest_faults(chosen, made)


@query("""SELECT page_id::VARCHAR AS provider, CASE WHEN page_id % 7 > 1 AND page_id % 5 > 0 THEN 'succeeded' ELSE 'failed' END AS status,
CASE WHEN page_id % 7 = 0 THEN 'fetch_malformed' WHEN page_id % 7 = 1 THEN 'fetch_timeout' WHEN page_id % 5 = 0 THEN 'fetch_malformed' WHEN page_id % 3 = 0 THEN 'web_metadata_old' END AS diagnostic FROM pages""")
def fetch_receipts(spark: SparkSession, d: str) -> DataFrame:
    """Sources and what was seen of them: some never fetched, some too late, some not parsed, some old."""
    n = F.col("page_id")
    rows = table(spark, d, "pages").select("page_id", n.cast("string").alias("provider"), F.concat(F.lit("https://s.example/"), n.cast("string")).alias("url"))
    sources = rows.select("provider", "url", F.when(n % 5 == 0, "error").otherwise("ok").alias("status"), F.when(n % 3 == 0, "2024-01-01T00:00:00Z").alias("generated_at"), F.lit(1).alias("item_count"))
    late = n % 7 == 1
    seen = rows.where("page_id % 7 <> 0").select("url", F.when(late, "failed").otherwise("succeeded").alias("status"), F.when(~late, "2024-02-01T00:00:00Z").alias("fetched_at"), F.when(late, "fetch_timeout").alias("diagnostic"))
    return fetching.with_observation(sources, seen, F.to_timestamp(F.lit("2024-02-01T00:00:00Z"))).select("provider", "status", "diagnostic")


@query("""SELECT rule, n FROM (SELECT unnest(['schema-version', 'generated-at', 'item-count-matches', 'item-id', 'item-text-title', 'item-score-impact', 'item-source-type', 'item-field-author']) AS rule,
unnest([count(*) FILTER (doc_id % 11 = 0), count(*) FILTER (doc_id % 13 = 0), count(*) FILTER (doc_id % 17 = 0), count(*) FILTER (doc_id % 19 = 0), count(*) FILTER (doc_id % 23 = 0), count(*) FILTER (doc_id % 29 = 0), count(*) FILTER (doc_id % 31 = 0), count(*) FILTER (doc_id % 37 = 0)]) AS n FROM documents) WHERE n > 0""")
def raw_feed_faults(spark: SparkSession, d: str) -> DataFrame:
    """Each document as a feed of one item, with planted faults, counted by rule."""
    n = F.col("doc_id")
    text_ = lambda bad, good: F.when(n % bad == 0, F.lit("5")).otherwise(F.concat(F.lit('"'), good, F.lit('"')))
    item = F.concat(
        F.lit('{"id":'), F.when(n % 19 == 0, F.lit('" "')).otherwise(F.concat(F.lit('"'), n.cast("string"), F.lit('"'))), F.lit(',"title":'), text_(23, F.col("source")), F.lit(',"summary":'), F.to_json(F.struct("text")).substr(F.lit(9), F.length(F.to_json(F.struct("text"))) - 9),
        F.lit(',"category":null,"sourceType":'), F.when(n % 31 == 0, F.lit('"web"')).otherwise(F.lit('"x"')), F.lit(',"sourceUrl":null,"postedAt":null,"collectedAt":null'), F.when(n % 37 == 0, F.lit("")).otherwise(F.lit(',"author":{"name":"a"}')),
        F.lit(',"scores":{"impact":'), F.when(n % 29 == 0, F.lit('"high"')).otherwise(F.lit("2.5")), F.lit("}}"),
    )
    value = F.concat(
        F.lit('{"schemaVersion":'), F.when(n % 11 == 0, F.lit("2")).otherwise(F.lit("1")), F.lit(f',"source":"{feeds.FEED_SOURCE}","generatedAt":'), F.when(n % 13 == 0, F.lit('" "')).otherwise(F.lit('"2024-01-01T00:00:00Z"')),
        F.lit(',"scope":{"type":"x","itemCount":'), F.when(n % 17 == 0, F.lit("2")).otherwise(F.lit("1")), F.lit('},"items":['), item, F.lit("]}"),
    )
    return checks.raw_feed_faults(table(spark, d, "documents").select(value.alias("value")), feeds.FEED_SOURCE).groupBy("rule").agg(F.count("*").alias("n"))
