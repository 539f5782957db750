"""Collocations, URL filter and periodic runs: brute force, odd rows, skew."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import count

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressrun.llm import periodic, phrases, urls

DOCS = "doc_id long, text string, lang string, n long, words string, key string"


def docs_of(spark, rows):
    """Columns besides the used ones clash with inner names."""
    return spark.createDataFrame([(*r, 7, "w", "k") for r in rows], DOCS).repartition(3)


# ---------------------------------------------------------------- phrases


def online(words, depth):
    """A textbook suffix automaton, one word after the other, cut to phrases of `depth` words: phrase to (endpos count, state's endpos)."""
    ends = defaultdict(set)
    for piece_at, piece in words:
        for i in range(len(piece)):
            for k in range(1, depth + 1):
                if i + 1 >= k:
                    ends[tuple(piece[i + 1 - k : i + 1])].add(piece_at + i)
    return {x: frozenset(e) for x, e in ends.items()}


@pytest.mark.parametrize("seed", range(6))
def test_automaton_states_are_endpos_classes(seed):
    rnd = random.Random(seed)
    store = phrases.new_store()
    texts = [" ".join(rnd.choice("abcd") + rnd.choice(["", "", ".", "\n"]) for _ in range(rnd.randint(0, 40))).encode() for _ in range(5)]
    ids = phrases.numbered(texts, store)
    names = [w.decode() for w in list(store)[1:]]
    found = phrases.states(phrases.automaton(ids, phrases.word_hashes("en", list(store)[1:]), 4, []))
    pieces, at = [], 0
    for piece in re.split("\0", "".join(f" {names[i - 1]}" if i else "\0" for i in ids)):
        pieces.append((at, piece.split()))
        at += len(piece.split()) + 1
    expected = online(pieces, 4)
    assert {tuple(x.split(" ")): n for x, n in zip(*phrases.phrases(found, ids, names))} == {x: len(e) for x, e in expected.items()}
    classes = defaultdict(list)
    for x, e in expected.items():
        classes[e].append(x)
    # Of one endpos set may be several states where the depth cuts off the phrase that would join them; never more than phrases.
    spans = Counter((int(a), int(b), int(n)) for a, b, n in zip(found.shortest, found.longest, found.count))
    assert spans == Counter((min(map(len, c)), max(map(len, c)), len(e)) for e, c in classes.items())
    longest = {}
    for s in range(len(found.end)):
        row = ids[found.end[s] + 1 - found.longest[s] : found.end[s] + 1] - 1
        longest[s] = tuple(names[i] for i in row)
    for s, link in enumerate(found.link):
        short = longest[s][len(longest[s]) - int(found.shortest[s]) + 1 :]
        assert (link == -1) == (not short)
        if short:
            assert expected[short] == expected[longest[int(link)]] > expected[longest[s]]


def mined(rows, least, top, depth=4):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, depth + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    candidates = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    inside = lambda x, y: any(y[i : i + len(x)] == x for i in range(len(y) - len(x) + 1))
    out = defaultdict(list)
    for (lang, x), a in candidates.items():
        if any(lang == other and len(y) > len(x) and inside(x, y) and 100 * b >= 80 * a for (other, y), b in candidates.items()):
            continue
        score, k = min((2_000_000 * a // (f[lang, x[:k]] + f[lang, x[k:]]), k) for k in range(1, len(x)))
        out[lang].append((-score, -a, " ".join(x).encode(), f[lang, x[:k]], f[lang, x[k:]]))
    return {(lang, r + 1, x.decode(), -a, l, rr, n[lang], -s) for lang, rows_ in out.items() for r, (s, a, x, l, rr) in enumerate(sorted(rows_)[:top])}


def some_texts(seed, n=60):
    rnd = random.Random(seed)
    words = ["The", "old", "sea", "é́", "日本", "a\x1cb", "Éa", "of", "x", "\u00a0"]
    line = "The old sea of x"
    rows = [(0, None, "en"), (1, "", None), (2, " \t.\n", "de"), (None, "the old sea", None), (3, "ONE", "en")]
    for i in range(4, n):
        body = [rnd.choice(words) + rnd.choice(["", "", "", ",", "!", "\r\n", "\x0b"]) for _ in range(rnd.randint(1, 40))]
        rows.append((i, " ".join([*body, line] if rnd.random() < 0.6 else body), rnd.choice(["en", "en", None, "de"])))
    rows.append((n, " ".join(rnd.choice(words) for _ in range(4000)), "en"))
    return rows + rows[-3:]


@pytest.mark.parametrize("shard", [12_000_000, 500])
def test_phrases_equal_brute_force(spark, shard):
    rows = some_texts(3)
    for least, top in ((5, 2000), (3, 7)):
        found = phrases.mine(docs_of(spark, rows), least=least, top=top, shard_bytes=shard)
        assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert {tuple(r) for r in found.collect()} == mined(rows, least, top)


def test_a_full_bitmap_only_lets_more_pass(spark):
    rows = some_texts(5, 30)
    full = np.full(phrases.BITS // 8, 255, "u1")
    texts = docs_of(spark, rows).select(F.coalesce("text", F.lit("")).cast("binary").alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    assert {tuple(r) for r in phrases.counts(texts, [full, full], 4, 3).collect()} == {tuple(r) for r in phrases.counts(texts, [], 4, 3).collect()}


def test_a_shard_sends_a_row_a_part(spark):
    """More frequent phrases in a shard are no more rows, and no phrase is lost."""
    rows = some_texts(7)
    texts = docs_of(spark, rows).select(F.coalesce("text", F.lit("")).cast("binary").alias("text"), F.coalesce("lang", F.lit("und")).alias("lang")).coalesce(1)
    found = phrases.counts(texts, [], 4, 1).collect()
    sent = phrases.sent(texts, [], 4, 5).collect()
    assert len({(r["lang"], r["part"]) for r in sent}) == len(sent) <= 3 * 5 < len(found)
    told = Counter()
    for r in sent:
        for x, n in zip(r["phrases"].split(b"\n"), np.frombuffer(r["n"], "u4"), strict=True):
            told[r["lang"], x.decode()] += int(n)
    assert told == {(r["lang"], r["phrase"]): r["n"] for r in found}


def test_phrases_of_empty_tables(spark):
    assert phrases.mine(spark.createDataFrame([], DOCS)).count() == 0
    assert phrases.mine(docs_of(spark, [(1, None, None), (2, "", "en")])).count() == 0


def test_scores_pass_64_bits(spark):
    """The expressions of `mine` on counts that no test text can have."""
    row = spark.range(1).select(F.lit(9_000_000_000_000_000_000).alias("a"), F.lit(9_100_000_000_000_000_000).alias("l"), F.lit(9_200_000_000_000_000_000).alias("r"))
    got = row.select(F.expr(f"(CAST(a AS DECIMAL(20,0)) * {phrases.SCALE}BD) DIV (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))").alias("s")).first()["s"]
    assert got == 2_000_000 * 9_000_000_000_000_000_000 // (9_100_000_000_000_000_000 + 9_200_000_000_000_000_000)


# ---------------------------------------------------------------- URLs

URLS = [
    None, "", "no scheme", "http://", "https://Example.ORG/en/17", "https://sub.example.org/es/", "http://example.org/es", "http://org/", "http://org", "x://a.com/fr/1", "x://a.com/de/1#top", "x://acom/de/1",
    "x://a.com?b=/de/", "x://a.com:80/de/1", "http://u@EXAMPLE.org/en/1?x://y/z", "http://\u0130.org/en/", "http://casino-bets.example.net/en/3", "http://a\nb.org/c\nd", "://only.org/x", "http://h.net/" + "p" * 200_000,
]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]


def ruled(host, path):
    fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.name), len(r.host)), default=None)


def test_hosts_paths_and_rules(spark):
    rows = [(i, u, "h", "s") for i, u in enumerate(URLS)] + [(None, URLS[4], "h", "s")] * 2
    found = urls.judge(spark.createDataFrame(rows, "page_id long, url string, host string, score string")).collect()
    assert len(found) == len(rows)
    for r in found:
        url = URLS[r["page_id"]] if r["page_id"] is not None else URLS[4]
        host, path = split(url)
        rule = ruled(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule.name if rule else None)
        assert r["verdict"] == (rule.verdict if rule else "block" if r["score"] >= urls.THRESHOLD else "allow")
    assert {r["page_id"]: r["verdict"] for r in found}[16] == "block"
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_model_by_held_out_urls(spark):
    """Each URL is judged by a model that has not seen it."""
    table = urls.labelled_urls(spark).cache()
    wrong = 0
    for fold in range(3):
        out = F.pmod(F.xxhash64("url"), F.lit(3)) == fold
        found = urls.scored(table.where(out), urls.train(table.where(~out)))
        wrong += found.where((F.col("score") >= urls.THRESHOLD) != (F.col("blocked") == 1)).count()
    assert wrong <= 0.03 * table.count()


def test_scores_are_those_of_a_logistic_regression(spark):
    """Scores from the weights, and the optimum of the penalised likelihood found with numpy."""
    table = urls.labelled_urls(spark)
    model = urls.train(table)
    rows = urls.featured(urls.parted(table)).select("features", "blocked").collect()
    x = np.zeros((len(rows), urls.FEATURES), "f4")
    for i, r in enumerate(rows):
        x[i, r["features"].indices] = 1
    used = x.any(axis=0)
    x, y, w = x[:, used].astype("f8"), np.array([r["blocked"] for r in rows]), model.coefficients.toArray()
    assert not w[~used].any()
    score = 1 / (1 + np.exp(-(x @ w[used] + model.intercept)))
    spread = x.std(axis=0, ddof=1)  # the penalty is on weights of standardised features
    gradient = x.T @ (score - y) / len(y) + urls.PENALTY * w[used] * spread**2
    assert abs(gradient).max() < 1e-3 and abs((score - y).mean()) < 1e-3
    got = [r["score"] for r in urls.scored(table, model).collect()]
    assert np.allclose(sorted(got), sorted(score), atol=1e-9)


def test_label_tables(spark):
    with pytest.raises(ValueError):
        urls.train(spark.createDataFrame([("http://a/b", 1.0)], "url string, blocked double"))
    own = spark.createDataFrame([(f"http://{w}{i}.net/x", b) for i in range(8) for w, b in (("good", 0), ("evil", 1))] + [("http://evil.net", None)], "url string, blocked int")
    found = urls.judge(spark.createDataFrame([(1, "http://evil99.net/x"), (2, "http://good99.net/x")], "page_id long, url string"), own)
    assert {r["page_id"]: r["verdict"] for r in found.collect()} == {1: "block", 2: "allow"}


# ---------------------------------------------------------------- periodic runs


def brute(w, least_words=6, least_periods=4):
    out, n = [], len(w)
    for q in range(1, n // least_periods + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            whole = w[i : i + length]
            if j > i and length >= max(least_words, least_periods * q) and not any(whole[p:] == whole[:-p] for p in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def words_of(rnd):
    k = rnd.choice([1, 2, 3, 30])
    w = [str(rnd.randrange(k)) for _ in range(rnd.randint(0, 40))]
    if rnd.random() < 0.6:
        unit, at = [str(rnd.randrange(k)) for _ in range(rnd.randint(1, 9))], rnd.randint(0, len(w))
        w = w[:at] + unit * rnd.randint(1, 6) + unit[: rnd.randrange(len(unit))] + w[at:]
    return w


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_brute_force(seed):
    rnd = random.Random(seed)
    for _ in range(400):
        texts = [words_of(rnd) for _ in range(rnd.randint(1, 5))]
        for w in texts:
            assert periodic.runs([int(x) for x in w], 6, 3) == brute(w, 6, 3)
        got = periodic.runs_of_texts([[x.encode() for x in w] for w in texts], defaultdict(count().__next__))
        assert got == [brute(w) for w in texts]


def test_hashes_decide_nothing(monkeypatch):
    """With a hash that calls all stretches equal the words still decide."""
    monkeypatch.setattr(periodic.Extensions, "same", lambda self, i, j, n: True)
    rnd = random.Random(9)
    for _ in range(300):
        w = words_of(rnd)
        assert periodic.runs([int(x) for x in w]) == brute(w)


@pytest.mark.parametrize("unit, times", [([1], 200_000), ([1, 2], 100_000), ([0, 1, 1, 0, 1], 40_000), (list(range(5000)), 8)])
def test_long_runs(unit, times):
    assert periodic.runs(unit * times) == [(0, len(unit) * times, len(unit))]


def test_fibonacci_words_have_no_run_of_four_periods():
    a, b = [0], [0, 1]
    while len(b) < 30_000:
        a, b = b, b + a
    assert periodic.runs(b) == []


def op13(rows):
    out = []
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n = len(w)
        if doc_id is not None and n:
            h = zlib.crc32(str(doc_id).encode())
            g = h // 10
            if h % 10 == 0:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found = brute(w)
        gone = {i for s, length, q in found for i in range(s + q, s + length)}
        top = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        said = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        out.append((doc_id, len(found), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None, sha(said), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def test_digests_of_runs(spark):
    rnd = random.Random(4)
    rows = [(0, None), (1, ""), (2, " \n"), (None, "a a a a a a a"), (3, "x\u00a0y " * 9), (4, "\x1c b " * 7), (-5, "a b " * 50), (10**17 + 1, "q r s " * 5)]
    rows += [(i, rnd.choice([" ", "\n", "\t  "]).join(words_of(rnd))) for i in range(5, 400)]
    rows += [(400, " ".join(words_of(rnd) * 20)), rows[9], rows[9]]
    for size in (500_000, 50):
        found = periodic.digests(periodic.collapse(periodic.planted(docs_of(spark, [(*r, "en") for r in rows])), pass_words=size))
        assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, op13(rows)))
    assert periodic.digests(periodic.collapse(periodic.planted(spark.createDataFrame([], DOCS)))).count() == 0


def test_operator_gives_runs_and_texts(spark):
    rows = [(1, "so " + "very " * 6 + "good", "en"), (2, "nothing here", "de")]
    found = {r["doc_id"]: r for r in periodic.collapse(docs_of(spark, rows), carry=["lang", "key"]).collect()}
    assert found[1]["collapsed"] == "so very good" and [tuple(x) for x in found[1]["runs"]] == [(1, 6, 1)]
    assert found[2]["collapsed"] == "nothing here" and found[2]["runs"] == [] and (found[2]["lang"], found[2]["key"]) == ("de", "k")
