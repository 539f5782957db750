"""URL filter: rules by host and path, and for all other URLs a logistic regression on hashed character n-grams.

The regression is trained on a small labelled URL table (`labelled_urls`, or any DataFrame of url and blocked); at most SAMPLE
rows of it are used, those of least hash. Features are the distinct character n-grams of the host and of the path, each
with its ends marked and kept apart by a prefix, hashed to FEATURES places. The model is fitted by Spark ML in
one partition, so that its sums have one order, and scoring is a projection inside the JVM: pages are not shuffled.

Rules fit a host and all its subdomains if the path starts with theirs; the longest host and path wins, of equal length
the longer host. They are a parameter of the job and become one expression.

Defined cases: a null url, or one without `://`, has an empty host and path, which fit no rule and are judged by the model; the
host ends at the first `/`, `?` or `#` (ports and user names stay in it); only A to Z of a host are lower-cased;
repeated rows and null page_ids are judged like others; long URLs are used whole; an empty table gives an empty result; an
empty label table, or one of a single label, is refused; columns besides page_id and url are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressrun.functions import text

#: Lengths of n-grams, places for them, weight of the penalty, score from which a URL is blocked, rows of the label table.
GRAMS, FEATURES, PENALTY, THRESHOLD, SAMPLE = (3, 4, 5), 1 << 18, 0.003, 0.5, 20_000


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))

#: Words of hosts that a corpus does not want, and of ordinary ones; prefixes, ends and paths that both have.
UNWANTED = "casino bets poker slots jackpot spins win prize pills meds viagra cheap replica loans adult xxx porn sex cams dating ads adserver banner track clicks popup spam farm seo backlink warez crack keygen torrent"
ORDINARY = (
    "news library museum garden weather atlas school history train bread birds engine physics council language trails poetry radio chess hospital orchard linguist northern theatre "
    "another tension handmade thinker entire shipping mention whether bath gathering breathing compiler carpenter ferry notation earth fourth archive notes review daily open city river"
)
PREFIXES, ENDS = ("", "www.", "m.", "blog."), ("example.com", "example.net", "example.org")
PATHS = ("/en/{}", "/fr/{}.html", "/", "/de/{}/", "/es/{}#top", "/index.html", "/en/{}?page=2&ref=x", "", "/about", "/en/{}?utm_source=feed")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """url, blocked of the default table: each word alone and beside three others, on all kinds of hosts and paths."""
    rows = []
    for blocked, words in ((1.0, UNWANTED.split()), (0.0, ORDINARY.split())):
        for i, word in enumerate(words):
            for k, name in enumerate((word, f"{word}-{words[(7 * i + 3) % len(words)]}", f"{words[(5 * i + 11) % len(words)]}-{word}", word + words[(3 * i + 5) % len(words)])):
                at = 4 * i + k
                rows.append((f"http{'s' * (at % 2)}://{PREFIXES[at // 3 % 4]}{name}.{ENDS[at % 3]}{PATHS[(at + i) % len(PATHS)].format(7 * at)}", blocked))
    return spark.createDataFrame(rows, "url string, blocked double")


def parted(urls: DataFrame) -> DataFrame:
    """urls with host and path."""
    found = lambda k: F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)", k)
    return urls.withColumn("host", F.translate(found(1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).withColumn("path", found(2))


def rule_of(rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the rule that wins; null if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host))):
        fits = ((F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)) & F.col("path").startswith(rule.path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def grams() -> Column:
    """The distinct n-grams of host and path. Digits are alike, since numbers of pages say nothing."""


    def of(mark: str, column: str, n: int) -> Column:
        ended = F.concat(F.lit("^"), F.regexp_replace(column, "[0-9]", "0"), F.lit("$"))
        return F.transform(text.grams(ended, n), lambda x: F.concat(F.lit(mark), x))

    return F.array_distinct(F.concat(*[of(mark, column, n) for mark, column in (("h", "host"), ("p", "path")) for n in GRAMS]))


def featured(urls: DataFrame) -> DataFrame:
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="features").transform(urls.withColumn("grams", grams()))


def train(labelled: DataFrame) -> LogisticRegressionModel:
    """The model of url and blocked (0 or 1)."""
    rows = labelled.where("blocked IS NOT NULL").select(F.col("url"), F.col("blocked").cast("double").alias("blocked"))
    rows = parted(rows.orderBy(F.xxhash64("url"), "url", "blocked").limit(SAMPLE)).coalesce(1)
    if rows.select("blocked").distinct().count() < 2:
        raise ValueError("the label table needs URLs of both labels")
    fit = LogisticRegression(featuresCol="features", labelCol="blocked", regParam=PENALTY, maxIter=60, tol=1e-8, aggregationDepth=2)
    return fit.fit(featured(rows).select("features", "blocked"))


def scored(urls: DataFrame, model: LogisticRegressionModel) -> DataFrame:
    """urls (with url) and host, path and score, the chance that the URL is to be blocked."""
    out = model.transform(featured(parted(urls)))
    return out.withColumn("score", vector_to_array("probability")[1]).drop("grams", "features", "rawPrediction", "probability", "prediction")


def judge(pages: DataFrame, labelled: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score of each row."""
    model = train(labelled_urls(pages.sparkSession) if labelled is None else labelled)
    name, verdict = rule_of(rules)
    by_model = F.when(F.col("score") >= THRESHOLD, "block").otherwise("allow")
    found = scored(pages.select("page_id", "url"), model)
    return found.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, by_model).alias("verdict"), "score")
