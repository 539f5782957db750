"""URLs: column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pressrun.config import TRACKING_PARAMS
from pressrun.functions.text import trimmed

# Hosts of media, path parts and query keys that are refused.
MEDIA_HOSTS = ("pbs.twimg.com", "video.twimg.com", "ton.twimg.com")
MEDIA_PATHS = "profile_images|profile_banners|emoji|hashflags|sticky"
BLOCKED_KEYS = r"token|auth|authorization|access[_-]?token|signature|sig|expires?|expiry|key|api[_-]?key|secret|cookie|session|sid|hmac|private|oauth|bearer|jwt"


def host(c: Column) -> Column:
    """Lower-case host of any URL; null if it cannot be parsed."""
    return F.lower(F.try_parse_url(trimmed(c), F.lit("HOST")))


def without_dots(path: Column) -> Column:
    """A path with its . and .. segments resolved; the walk is made only where there are any."""
    none = F.array().cast("array<string>")
    dots = lambda s, n: F.lower(F.regexp_replace(s, "(?i)%2e", ".")) == "." * n
    step = lambda acc, s: F.when(dots(s, 1), acc).when(dots(s, 2), F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1)))).otherwise(F.concat(acc, F.array(s)))
    end = F.when(path.rlike(r"(?i)/(\.|%2e){1,2}$"), "/").otherwise("")
    walked = F.concat(F.array_join(F.aggregate(F.split(path, "/"), none, step), "/"), end)
    return F.when(path.rlike(r"(?i)/(\.|%2e){1,2}(/|$)"), walked).otherwise(path)


def _ascii_host(name: str) -> str:
    """Labels with other characters than ASCII by the bootstring coding of IDNA, in their compatible lower-case form."""
    name = unicodedata.normalize("NFC", unicodedata.normalize("NFKC", name).lower())
    for stop in "\u3002\uff0e\uff61":
        name = name.replace(stop, ".")
    return ".".join(x if x.isascii() else "xn--" + x.encode("punycode").decode() for x in name.split("."))


@F.pandas_udf(StringType())
def ascii_host(names: pd.Series) -> pd.Series:
    """Null stays null: only hosts that need the coding are given."""
    return names.map(_ascii_host, na_action="ignore")


#: What a path keeps; the URL standard writes all other characters as bytes in %.
PLAIN = r"!$%&'()*+,\-./0-9:;=@A-Z\[\]^_a-z|~"


def encoded_path(path: Column) -> Column:
    runs = F.regexp_extract_all(path, F.lit(rf"(?s)([{PLAIN}]+|[^{PLAIN}]+)"), F.lit(1))
    coded = F.transform(runs, lambda r: F.when(r.rlike(f"^[{PLAIN}]"), r).otherwise(F.replace(F.url_encode(r), F.lit("+"), F.lit("%20"))))
    return F.when(path.rlike(rf"[^{PLAIN}]"), F.array_join(coded, "")).otherwise(path)


def parameters(query: Column) -> Column:
    """Decoded keys and values (k, v) of a query in its order. What is no valid code stays as it is."""
    decoded = lambda x: F.coalesce(F.try_url_decode(x), F.replace(x, F.lit("+"), F.lit(" ")))
    first = lambda p: F.substring_index(p, "=", 1)
    rest = lambda p: F.when(F.contains(p, F.lit("=")), F.substr(p, F.length(first(p)) + 2)).otherwise("")
    return F.transform(F.filter(F.split(query, "&"), lambda p: p != ""), lambda p: F.struct(decoded(first(p)).alias("k"), decoded(rest(p)).alias("v")))


def written(pairs: Column) -> Column:
    return F.array_join(F.transform(pairs, lambda p: F.concat(F.url_encode(p["k"]), F.lit("="), F.url_encode(p["v"]))), "&")


def normalized_url(c: Column, tracking: tuple[str, ...] = TRACKING_PARAMS) -> Column:
    """http(s) without scheme, user, default port, last slash, fragment and tracking parameters; parameters sorted."""
    raw = trimmed(c)
    scheme = F.lower(F.regexp_extract(raw, r"^(?i)(https?)://", 1))
    authority = F.regexp_replace(F.regexp_extract(raw, r"^(?i)https?://([^/?#]*)", 1), "^.*@", "")
    given = F.regexp_replace(F.lower(F.regexp_replace(authority, r":\d*$", "")), r"\.$", "")
    foreign = given.rlike(r"[^\x00-\x7F]") & ~given.rlike(r'[\x00-\x20"#/:<>?@\[\\\]^|%`\x7F]')
    name = F.coalesce(ascii_host(F.when(foreign, given)), given)
    port = F.regexp_extract(authority, r":(\d+)$", 1)
    usual = (port == "") | ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443"))
    path = F.replace(F.regexp_extract(raw, r"^(?i)https?://[^/?#]*([^?#]*)", 1), F.lit("\\"), F.lit("/"))
    path = encoded_path(without_dots(path))
    path = F.when(path == "", "/").when(F.length(path) > 1, F.regexp_replace(path, "/$", "")).otherwise(path)
    pairs = F.filter(parameters(F.regexp_extract(raw, r"^[^?#]*\?([^#]*)", 1)), lambda p: ~F.lower(p["k"]).isin(*tracking))
    query = written(F.array_sort(pairs))
    out = F.concat(F.lit("//"), name, F.when(usual, "").otherwise(F.concat(F.lit(":"), port)), path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    plain_host = F.try_parse_url(F.concat(F.lit("http://"), given), F.lit("HOST")).isNotNull()
    return F.when((scheme != "") & (name != "") & (plain_host | foreign), out)


def media_url(c: Column) -> Column:
    """A public media URL with only `format` and `name`; null if anything about it is private or unknown."""
    named = F.regexp_extract(c, r"^https://([^/?#]*)", 1)
    path = F.regexp_extract(c, r"^https://[^/?#]*([^?#]*)", 1)
    pairs = parameters(F.regexp_extract(c, r"^[^?#]*\?([^#]*)", 1))
    kept = F.array_sort(F.filter(pairs, lambda p: F.lower(p["k"]).isin("format", "name")), lambda x, y: F.when(x["k"] < y["k"], -1).when(x["k"] > y["k"], 1).otherwise(0))
    allowed = F.lower(named).isin(*MEDIA_HOSTS) & ~path.rlike(rf"(?i)/({MEDIA_PATHS})/") & ~F.exists(pairs, lambda p: p["k"].rlike(rf"(?i)^({BLOCKED_KEYS})$"))
    return F.when(allowed, F.concat(F.lit("https://"), F.lower(named), F.when(path == "", "/").otherwise(path), F.when(F.size(kept) > 0, F.concat(F.lit("?"), written(kept))).otherwise("")))
