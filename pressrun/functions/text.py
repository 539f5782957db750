"""Titles, grams, terms, HTML text: column expressions."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Words that carry no topic.
STOPWORDS = (
    "the a an and or of to in on for from with by at as is are was were be been has have had this that it its about after over into than then us uk new news says said "
    "の を が は に で と も へ や"
).split()
CJK = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}"
EDGE_SPACE = r"^[\s\p{Z}\x{FEFF}]+|[\s\p{Z}\x{FEFF}]+$"


def trimmed(c: Column) -> Column:
    """Without any Unicode white space at its ends."""
    return F.regexp_replace(c, EDGE_SPACE, "")


def nonblank(c: Column) -> Column:
    t = trimmed(c)
    return F.when(t != "", t)


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def normalized_title(c: Column) -> Column:
    """For comparison, of a title in NFKC; null if nothing is left."""
    t = F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}\p{M}]+", " "))
    return F.when(t != "", t)


def utf16_length(c: Column) -> Column:
    return F.length(c) + F.length(c) - F.length(F.regexp_replace(c, r"[\x{10000}-\x{10FFFF}]", ""))


def grams(c: Column, n: int = 3) -> Column:
    """Character n-grams in order, the whole text if it is shorter; the time grows with its length only."""
    chars = F.regexp_extract_all(c, F.lit("(?s)(.)"), F.lit(1))
    many = F.size(chars) - (n - 1)
    whole = F.when(F.length(c) > 0, F.array(c)).otherwise(F.array().cast("array<string>"))
    joined = F.slice(chars, 1, F.greatest(many, F.lit(0)))
    for k in range(1, n):
        joined = F.zip_with(joined, F.slice(chars, k + 1, F.greatest(many, F.lit(0))), lambda x, y: F.concat(x, y))
    return F.when(many > 0, joined).otherwise(whole)


def numbered_grams(rows: DataFrame, key: str, text: Column, n: int = 3) -> DataFrame:
    """key, gram: a row for each gram of each text, hashed with its occurrence number, so that multiset overlap is set overlap."""
    each = rows.select(key, F.explode(F.transform(grams(text, n), lambda x: F.xxhash64(x))).alias("gram"))
    counted = each.groupBy(key, "gram").agg(F.count("*").cast("int").alias("c"))
    return counted.select(key, F.explode(F.transform(F.sequence(F.lit(1), F.col("c")), lambda k: F.xxhash64("gram", k))).alias("gram"))


def rounded(c: Column) -> Column:
    return F.floor(c * 10000 + 0.5) / 10000


def dice(a: Column, b: Column) -> Column:
    """Of numbered grams."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / total)


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def proper_nouns(raw: Column) -> Column:
    """Of the title as it came: capitalised ASCII words of three letters or more, and katakana runs."""
    latin = F.regexp_extract_all(raw, F.lit(r"(?<![A-Za-z0-9_])([A-Z][A-Za-z0-9]{2,})(?![A-Za-z0-9_])"), F.lit(1))
    katakana = F.regexp_extract_all(raw, F.lit("([ァ-ヶー]{3,})"), F.lit(1))
    return F.coalesce(F.array_sort(F.array_distinct(F.transform(F.concat(latin, katakana), F.lower))), F.array().cast("array<string>"))


def terms(normal: Column, raw: Column) -> Column:
    """normal: the title in NFKC. Words, pairs of CJK characters and proper nouns, sorted."""
    words = F.filter(F.split(F.lower(normal), r"[^\p{L}\p{N}]+"), lambda w: ~w.isin(STOPWORDS) & (F.length(w) >= F.when(w.rlike(f"[{CJK}]"), 2).otherwise(3)))
    chars = F.regexp_replace(raw, f"[^{CJK}]", "")
    pairs = F.when(F.length(chars) >= 2, F.transform(F.sequence(F.lit(1), F.length(chars) - 1), lambda i: F.substring(chars, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))
    return F.coalesce(F.array_sort(F.array_distinct(F.concat(words, pairs, proper_nouns(raw)))), F.array().cast("array<string>"))


def cjk_runs(raw: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(raw, F.lit("")), F.lit(f"([{CJK}ー]{{2,}})"), F.lit(1))


def longest_shared_run(left: Column, right: Column) -> Column:
    """The first of the longest CJK runs of either title that the other contains."""
    a, b = F.coalesce(left, F.lit("")), F.coalesce(right, F.lit(""))
    runs = F.concat(F.filter(cjk_runs(a), lambda r: F.contains(b, r)), F.filter(cjk_runs(b), lambda r: F.contains(a, r)))
    return F.aggregate(runs, F.lit(""), lambda best, r: F.when(F.length(r) > F.length(best), r).otherwise(best))


def distinctive_run(run: Column, least: int) -> Column:
    return (F.length(run) >= least) & (run.rlike("[ァ-ヶー]{3,}") | run.rlike(r"\p{IsHan}{3,}"))


def keyword_hit(haystack: Column, keyword: str) -> Column:
    """haystack: NFKC and lower case."""
    needle = unicodedata.normalize("NFKC", keyword).lower()
    if re.search(r"[\W_]", needle) or len(needle) >= 4 or re.search(r"[぀-ヿ㐀-鿿豈-﫿]", needle):
        return F.contains(haystack, F.lit(needle))
    return haystack.rlike(rf"(?<![\p{{L}}\p{{N}}]){re.escape(needle)}(?![\p{{L}}\p{{N}}])")


def topic(haystack: Column, category: Column, priority: tuple[str, ...], keywords: dict[str, tuple[str, ...]], fallback: dict[str, str]) -> Column:
    """The group with most keywords in the text, the earlier at a tie; else the category's; else other."""
    named = [g for g in priority if g != "other"]
    hits = [sum((keyword_hit(haystack, k).cast("int") for k in keywords.get(g, ())), F.lit(0)) for g in named]
    best = F.aggregate(F.array(*[F.struct(h.alias("n"), F.lit(g).alias("g")) for h, g in zip(hits, named)]), F.struct(F.lit(0).alias("n"), F.lit("").alias("g")), lambda acc, x: F.when(x["n"] > acc["n"], x).otherwise(acc))
    by_category = F.create_map(*[F.lit(v) for pair in fallback.items() for v in pair])
    other = F.coalesce(F.try_element_at(by_category, F.coalesce(category, F.lit(""))), F.lit("other"))
    return F.when(best["n"] > 0, best["g"]).otherwise(other)


# Named character references of feeds.
ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "ndash": "–", "mdash": "—", "rsquo": "’", "lsquo": "‘", "rdquo": "”", "ldquo": "“"}


def _decode(m: re.Match[str]) -> str:
    name = m[1]
    if name[0] == "#":
        n = int(name[2:], 16) if name[1] in "xX" else int(name[1:])
        return chr(n) if n <= 0x10FFFF and not 0xD800 <= n <= 0xDFFF else m[0]
    return ENTITIES.get(name.lower(), m[0])


_reference = re.compile(r"&(#[xX][0-9a-fA-F]+|#[0-9]+|[a-zA-Z]+);")


@F.pandas_udf(StringType())
def decode_entities(s: pd.Series) -> pd.Series:
    return s.map(lambda x: _reference.sub(_decode, x) if "&" in x else x, na_action="ignore")


def plain_text(c: Column) -> Column:
    """Text of an HTML fragment in one line: references are decoded before and after tags go."""
    t = decode_entities(c)
    t = F.regexp_replace(t, r"(?is)<(script|style)\b[^>]*>.*?</\1>", " ")
    t = F.regexp_replace(t, r"(?i)<br\s*/?>|</p>", "\n")
    t = decode_entities(F.regexp_replace(t, "<[^>]+>", " "))
    return nonblank(F.regexp_replace(t, r"[\s\p{Z}\x{FEFF}]+", " "))


def clipped(c: Column, n: int) -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("…"))).otherwise(c)


def redacted(c: Column) -> Column:
    c = F.regexp_replace(c, r"sk-[a-zA-Z0-9_-]+", "[redacted]")
    c = F.regexp_replace(c, r"(?i)Bearer\s+\S+", "Bearer [redacted]")
    return F.regexp_replace(c, r"(?i)Authorization:\s*\S+", "Authorization: [redacted]")


def http_urls(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"((?i)https?://[^\s\"'<>]+)"), F.lit(1)))


def urls_grounded(generated: Column, given: Column) -> Column:
    return F.size(F.array_except(http_urls(generated), http_urls(given))) == 0


def banned_phrase(c: Column, phrases: list[str]) -> Column:
    """The first phrase found; phrases with Latin letters in any case."""
    found = F.filter(F.array(*[F.when(F.contains(F.lower(c) if re.search("[A-Za-z]", p) else c, F.lit(p.lower() if re.search("[A-Za-z]", p) else p)), F.lit(p)) for p in phrases if p]), lambda x: x.isNotNull())
    return F.get(found, F.lit(0))


def escape_markdown(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"([\[\]])", r"\\$1")
