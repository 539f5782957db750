"""Column expressions against expected values."""

import pytest
from pyspark.sql import functions as F

from pressrun.config import CandidateConfig, ClusterConfig, ConfigError, EvaluationConfig, ReferenceConfig, SelectConfig
from pressrun.functions import ids, text, time, url


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("http://Example.com:80/a/?b=2&utm_source=x&a=1#frag", "//example.com/a?a=1&b=2"), ("https://u:p@example.com./", "//example.com/"), ("https://example.com:8443/x", "//example.com:8443/x"),
        ("https://example.com?UTM_Medium=z", "//example.com/"), ("https://example.com/a?b", "//example.com/a?b="), ("https://example.com/a/../b/./c", "//example.com/b/c"), ("https://example.com/a/b/..", "//example.com/a"), ("https://example.com/../x/%2E%2e/y", "//example.com/y"), ("ftp://example.com/", None), ("nonsense", None),
        ("http://MÜNCHEN.example/", "//xn--mnchen-3ya.example/"), ("https://Ｂücher。example:444/", "//xn--bcher-kva.example:444/"), ("http://日本語.example/日 本?q=日", "//xn--wgv71a119e.example/%E6%97%A5%20%E6%9C%AC?q=%E6%97%A5"),
        ("http://a.example/x\\y%2fz\"<>`{}|^", "//a.example/x/y%2fz%22%3C%3E%60%7B%7D|^"), ("http://a.example/?a-b=1&a=2&%75tm_source=x&c=%zz&d=e+f&g=%2B*", "//a.example/?a=2&a-b=1&c=%25zz&d=e+f&g=%2B*"), ("http://ä b.example/", None), ("  ", None), (None, None),
    ],
)
def test_normalized_url(spark, given, want):
    assert one(spark, given, url.normalized_url) == want


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("https://pbs.twimg.com/media/a?name=x&format=jpg&other=1#f", "https://pbs.twimg.com/media/a?format=jpg&name=x"), ("http://pbs.twimg.com/a", None), ("https://user@pbs.twimg.com/a", None), ("https://pbs.twimg.com:444/a", None),
        ("https://evil.example/a", None), ("https://pbs.twimg.com/profile_images/a", None), ("https://pbs.twimg.com/a?Token=1", None), ("https://pbs.twimg.com/a?%74oken=1", None), ("https://pbs.twimg.com/a?api%5Fkey=1&format=jpg", None), ("https://pbs.twimg.com/a?n%61me=x%20y", "https://pbs.twimg.com/a?name=x+y"), (None, None),
    ],
)
def test_media_url(spark, given, want):
    assert one(spark, given, url.media_url) == want


def test_titles(spark):
    norm = lambda c: text.normalized_title(text.nfkc(c))
    assert one(spark, "  Ｈｅｌｌｏ, World! ", norm) == "hello world"
    assert one(spark, "!!!", norm) is None
    assert one(spark, "ab", text.grams) == ["ab"] and one(spark, "abcd", text.grams) == ["abc", "bcd"] and one(spark, "", text.grams) == []
    assert one(spark, "😀a", text.utf16_length) == 3


def test_terms(spark):
    assert one(spark, "NASA and Artemis II in NASA", text.proper_nouns) == ["artemis", "nasa"]
    assert one(spark, "éNASA日NASA NASA", text.proper_nouns) == ["nasa"]
    got = one(spark, "The ロケット打上 of NASA is new", lambda c: text.terms(c, c))
    assert "nasa" in got and "new" not in got and "of" not in got and "ロケ" in got and "打上" in got


def test_shared_runs(spark):
    df = spark.createDataFrame([("東京都知事選挙の結果", "東京都知事選挙"), ("abc", None)], "a string, b string")
    runs = [r[0] for r in df.select(text.longest_shared_run(F.col("a"), F.col("b"))).collect()]
    assert runs == ["東京都知事選挙", ""]


def test_plain_text(spark):
    assert one(spark, "<p>a &amp;amp; b</p><script>x<y</script>c<br>d&#x41;&nbsp;&bogus;", text.plain_text) == "a & b c dA &bogus;"
    assert one(spark, " <p> </p>", text.plain_text) is None


@pytest.mark.parametrize(
    ("given", "want"),
    [("Wed, 02 Oct 2024 13:00:00 GMT", "2024-10-02T13:00:00.000Z"), ("02 Oct 2024 13:00:00 +0900", "2024-10-02T04:00:00.000Z"), ("2024-10-02T13:00:00+09:00", "2024-10-02T04:00:00.000Z"), ("2024-10-02", "2024-10-02T00:00:00.000Z"), ("soon", None), (None, None)],
)
def test_lenient_dates(spark, given, want):
    assert one(spark, given, lambda c: time.iso(time.lenient(c))) == want


@pytest.mark.parametrize(("given", "ok"), [("2024-02-29T23:59:59Z", True), ("2024-02-30T00:00:00Z", False), ("2024-02-29 10:00:00", False), ("2024-02-29T10:00:60Z", False), ("2024-02-29T10:00:00.5+09:00", True)])
def test_strict_dates(spark, given, ok):
    assert (one(spark, given, time.strict) is not None) == ok


def test_ids(spark):
    assert one(spark, " https://a.example/x ", ids.compact_id) == "https://a.example/x"
    assert len(one(spark, "has space", ids.compact_id)) == 64 and len(one(spark, "x" * 181, ids.compact_id)) == 64
    assert one(spark, "a", lambda c: ids.key(c, F.lit(None).cast("string"))) == one(spark, "a\x1f", lambda c: F.sha2(c.cast("binary"), 256))


def test_generated_text(spark):
    assert one(spark, "sk-abc bearer x authorization: y", text.redacted) == "[redacted] Bearer [redacted] Authorization: [redacted]"
    assert one(spark, "see https://a.example/x", lambda c: text.urls_grounded(c, F.lit("https://a.example/x"))) is True
    assert one(spark, "see https://b.example", lambda c: text.urls_grounded(c, F.lit("none"))) is False
    assert one(spark, "A MUST read", lambda c: text.banned_phrase(c, ["", "absent", "must READ"])) == "must READ"
    assert one(spark, "a[b]", text.escape_markdown) == "a\\[b\\]"


def test_topics(spark):
    config = SelectConfig()
    pick = lambda v, cat=None: one(spark, v, lambda c: text.topic(F.lower(c), F.lit(cat).cast("string"), config.priority, config.keywords, config.fallback))
    assert pick("nasa and ukraine") == "space" and pick("ukraine nato nasa") == "international" and pick("the dna of oil") == "economy"
    assert pick("paid said") == "other" and pick("x", "Books") == "creative" and pick("my ai") == "ai_tech"


@pytest.mark.parametrize("make", [lambda: ClusterConfig(threshold=0), lambda: CandidateConfig(min_title_similarity=0), lambda: EvaluationConfig(weights={"importance": 1}), lambda: SelectConfig(target=20), lambda: ReferenceConfig(threshold=5)])
def test_settings_are_checked(make):
    with pytest.raises(ConfigError):
        make()
