"""Operators on small tables, against brute force where order decides."""

import hashlib
import itertools
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pressrun import catalog
from pressrun.config import SelectConfig
from pressrun.operators import candidates, checks, clusters, digest, evaluation, graph, judging, naming, pool, references, selection, similarity
from pressrun.sources import feeds


def test_components(spark):
    rnd = random.Random(3)
    nodes = [f"n{i:03}" for i in range(120)]
    edges = [(nodes[i], nodes[i + 1]) for i in range(40)] + [tuple(rnd.sample(nodes[50:], 2)) for _ in range(40)]
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    found = graph.components(spark.createDataFrame([(n,) for n in nodes], "id string"), spark.createDataFrame(edges, "a string, b string"))
    assert {r["id"]: r["root"] for r in found.collect()} == {n: find(n) for n in nodes}


def counted(t):
    grams = [t[i : i + 3] for i in range(len(t) - 2)] if len(t) >= 3 else [t]
    return {g: grams.count(g) for g in grams}, len(grams)


def test_dice_pairs_equal_brute_force(spark):
    rnd = random.Random(4)
    base = ["".join(rnd.choice("abcab ") for _ in range(rnd.randint(3, 40))).strip() or "x" for _ in range(25)]
    texts = sorted({t[:i] + rnd.choice("xyz") + t[i:] for t in base for i in (1, 2)} | set(base))
    want = {}
    for a, b in itertools.combinations(texts, 2):
        (x, n), (y, m) = counted(a), counted(b)
        score = int(2 * sum(min(c, y.get(g, 0)) for g, c in x.items()) / (n + m) * 10000 + 0.5) / 10000
        if score >= 0.7:
            want[a, b] = score
    found = similarity.dice_pairs(spark.createDataFrame([(f"{i:04}", t) for i, t in enumerate(texts)], "id string, t string"), 0.7)
    assert {(texts[int(r["id_a"])], texts[int(r["id_b"])]): r["score"] for r in found.collect()} == want


def test_similar_texts_are_compared_in_tiles_and_kept_small(spark, monkeypatch):
    """Blocks of sizes and folded sketches of several lengths lose no pair, and what passes the sketches is hardly more than what is similar."""
    monkeypatch.setattr(similarity, "LEAST_BLOCK", 8)
    monkeypatch.setattr(similarity, "LEAST_BITS", 64)
    monkeypatch.setattr(similarity, "STEP", 3)
    monkeypatch.setattr(similarity, "WIDE", 5)
    monkeypatch.setattr(similarity, "HELD", 2_000)
    rnd = random.Random(8)
    texts = set()
    for size in (5, 9, 20, 60, 130, 260, 700, 1500):
        for _ in range(6):
            text = "".join(rnd.choice("abcdefgh ") for _ in range(size))
            texts |= {text, *(text[:i] + "x" * rnd.randint(1, 1 + size // 20) + text[i:] for i in rnd.sample(range(size), 2))}
    texts = sorted(texts)
    want, grams = {}, {t: Counter(t[i : i + 3] for i in range(len(t) - 2)) for t in texts}
    for a, b in itertools.combinations(texts, 2):
        score = int(2 * (grams[a] & grams[b]).total() / (len(a) + len(b) - 4) * 10000 + 0.5) / 10000
        if score >= 0.9:
            want[a, b] = score
    rows = spark.createDataFrame([(f"{i:04}", t) for i, t in enumerate(texts)], "id string, t string")
    assert {(texts[int(r["id_a"])], texts[int(r["id_b"])]): r["score"] for r in similarity.dice_pairs(rows, 0.9).collect()} == want
    assert len(want) > 60 and similarity.sketched_pairs(rows, 0.9).count() < 2 * len(want)


def test_long_texts_are_not_folded_to_the_bits_of_short_ones(spark):
    """One tile of texts of all sizes: unrelated long texts, and of those folded to a short one's bits nearly all would pass."""
    rnd = random.Random(5)
    long_ = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(rnd.randint(9_000, 10_000))) for _ in range(12)]
    near = [t[:4_000] + "#" + t[4_100:] for t in long_[:3]]
    texts = ["short words", "short word", *("".join(rnd.choice("abcdefgh ") for _ in range(n)) for n in (40, 300, 1_100, 2_300, 4_700)), *long_, *near]
    rows = spark.createDataFrame([(f"{i:04}", t) for i, t in enumerate(texts)], "id string, t string")
    found = {(texts[int(r["id_a"])], texts[int(r["id_b"])]) for r in similarity.sketched_pairs(rows, 0.9).collect()}
    assert found == {("short words", "short word"), *zip(long_, near)}


def test_clusters_connect_similar_titles_without_all_pairs(spark, monkeypatch):
    """As few pairs as connect near copies, the same components as all similar pairs, over several tiles and chains of titles."""
    monkeypatch.setattr(similarity, "LEAST_BLOCK", 40)
    rnd = random.Random(6)
    base = "".join(rnd.choice("abcdefgh ") for _ in range(300)) + "z"
    texts = {base[:i] + "#" + base[i:] for i in rnd.sample(range(300), 60)}  # all alike
    for _ in range(4):  # chains: only neighbours are alike
        text = "".join(rnd.choice("abcdefgh ") for _ in range(200)) + "y"
        for i in range(8):
            texts.add(text := text + "".join(rnd.choice("klmnop") for _ in range(len(text) // 6)))
    texts = sorted(texts | {"".join(rnd.choice("rstuvw") for _ in range(n)) for n in range(40, 80)})
    rows = spark.createDataFrame([(f"{i:04}", t, None) for i, t in enumerate(texts)], "id string, title_norm string, url_norm string")
    every = {(r["id_a"], r["id_b"]) for r in similarity.dice_pairs(rows.withColumnRenamed("title_norm", "t"), 0.9).collect()}
    edges = [(r["a"], r["b"]) for r in clusters.forming_edges(rows).collect()]
    assert set(edges) <= every and len(every) > 1_700 and len(edges) < 200

    def reached(pairs):
        root = {f"{i:04}": f"{i:04}" for i in range(len(texts))}
        for _ in root:
            for a, b in pairs:
                root[a] = root[b] = min(root[a], root[b])
        return root

    assert reached(edges) == reached(every) and len(set(reached(every).values())) < len(texts) - 80


@pytest.mark.parametrize("name", ["cluster_stats", "cluster_review"])
def test_titles_are_compared_once_for_clusters_and_their_links(spark, monkeypatch, name):
    compare, calls = similarity.sketched_pairs, []
    monkeypatch.setattr(similarity, "sketched_pairs", lambda *given: (calls.append(1), compare(*given))[1])
    assert catalog.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    assert len(calls) == 1


@pytest.mark.parametrize("seed", range(4))
def test_capped_choice_equals_one_by_one(spark, seed):
    rnd = random.Random(seed)
    pairs = [(f"i{a:02}", f"i{b:02}", rnd.randint(1, 6) / 10) for a, b in itertools.combinations(range(14), 2) if rnd.random() < 0.6]
    used, want = {}, []
    for a, b, s in sorted(pairs, key=lambda p: (-p[2], p[0], p[1])):
        if len(want) < 20 and used.get(a, 0) < 3 and used.get(b, 0) < 3:
            want.append((a, b))
            used[a], used[b] = used.get(a, 0) + 1, used.get(b, 0) + 1
    found = candidates.capped(spark.createDataFrame(pairs, "item_a string, item_b string, candidate_score double"), 3, 20)
    assert sorted((r["item_a"], r["item_b"]) for r in found.collect()) == sorted(want)


def plain_merge(members, judged):
    groups = {}
    for i, r in members:
        groups.setdefault(r, set()).add(i)
    of = dict(members)
    apart = {tuple(sorted(j[:2])) for j in judged if j[2] == "different-event" and j[3] == "ok"}
    conflicts = []
    for a, b in sorted(j[:2] for j in judged if j[2] == "same-event" and j[3] == "ok"):
        x, y = of[a], of[b]
        if x == y:
            continue
        both = groups[x] | groups[y]
        bad = sorted(p for p in apart if p[0] in both and p[1] in both)
        if bad:
            conflicts.append((a, b, *bad[0]))
            continue
        groups[x] = both
        for i in groups.pop(y):
            of[i] = x
    inside = [(None, None, *p) for p in apart if of[p[0]] == of[p[1]]]
    return {frozenset(g) for g in groups.values()}, conflicts + inside


@pytest.mark.parametrize("seed, small", [(0, 100_000), (1, 100_000), (2, 0), (3, 0), (4, 12)])
def test_constrained_merge(spark, seed, small):
    """Settled by tasks, by rounds, or by rounds until a component is small: as one by one."""
    rnd = random.Random(seed)
    members = [(f"i{i:02}", f"i{i - i % 2:02}") for i in range(24)]
    judged = [(*sorted(rnd.sample([m[0] for m in members], 2)), rnd.choice(["same-event", "same-event", "different-event", "related-event"]), rnd.choice(["ok", "ok", "failed"])) for _ in range(30)]
    check_merge(spark, members, judged, small)


def check_merge(spark, members, judged, small):
    groups, conflicts = plain_merge(members, judged)
    merged, found = judging.merge(spark.createDataFrame(members, "id string, root string"), spark.createDataFrame(judged, "item_a string, item_b string, relationship string, status string"), small)
    got = {}
    for r in merged.collect():
        got.setdefault(r["root"], set()).add(r["id"])
    assert {frozenset(g) for g in got.values()} == groups and all(r == min(g) for r, g in got.items())
    key = lambda c: tuple(x or "" for x in c)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(set(conflicts), key=key)


def test_merge_of_a_long_chain_takes_few_rounds(spark, monkeypatch):
    """A chain in the order of its pairs, in which each merge waits for the one before, with a forbidden pair in the middle and a star."""
    chain = [f"c{i:03}" for i in range(40)]
    star = [f"s{i:03}" for i in range(20)]
    members = [(i, i) for i in chain + star]
    judged = [(a, b, "same-event", "ok") for a, b in zip(chain, chain[1:])] + [("c010", "c030", "different-event", "ok")]
    judged += [("s000", s, "same-event", "ok") for s in star[1:]] + [("s010", "s015", "different-event", "ok")]
    rounds = []
    plain = judging.contracted
    monkeypatch.setattr(judging, "contracted", lambda *a: rounds.append(1) or plain(*a))
    check_merge(spark, members, judged, 0)
    assert len(rounds) <= 4


def test_components_of_a_star(spark):
    """The centre of a star has a third of all edges: its rows are not shuffled to one task."""
    leaves = [f"l{i:04}" for i in range(2000)]
    edges = [("a", x) for x in leaves[:700]] + [(leaves[i], leaves[i + 1]) for i in range(699, 1999)]
    both = spark.createDataFrame(edges, "a string, b string")
    found = graph.components(spark.createDataFrame([(x,) for x in ["a", *leaves, "alone"]], "id string"), both)
    assert {r["id"]: r["root"] for r in found.collect()} == {x: "a" for x in ["a", *leaves]} | {"alone": "alone"}
    assert [r["b"] for r in graph.frequent_keys(both.select("b").unionByName(both.select(graph.F.col("a").alias("b"))), "b", 4000).collect()] == ["a"]


def test_cache_and_limit(spark):
    pairs = spark.createDataFrame([(f"k{i}",) for i in range(6)], "cache_key string")
    cache = spark.createDataFrame([("k1", "same-event", 0.9, "ok"), ("k2", "same-event", 0.9, "failed")], "cache_key string, relationship string, confidence double, status string")
    got = judging.limited(judging.probe(pairs, cache), [F.asc("cache_key")], 2, ["cache_key"])
    assert [r["cache_key"] for r in got.where("requested").orderBy("cache_key").collect()] == ["k0", "k2"]
    judged = judging.judge(got.where("requested").select("cache_key"), lambda row: {"relationship": "same-event", "confidence": 0.5} if row["cache_key"] == "k0" else 1 / 0)
    rows = {r["cache_key"]: r for r in judged.collect()}
    assert rows["k0"]["status"] == "ok" and rows["k2"]["status"] == "failed" and "zero" in rows["k2"]["error"]
    assert judging.updated_cache(cache, judged).count() == 3


def plain_pack(rows, c=SelectConfig()):
    """One by one, as the rules say."""
    none_low = lambda x: x if x is not None else -1
    newest = lambda r: (r["published_ms"] is None, -(r["published_ms"] or 0), r["cluster_id"])
    main = [r for r in rows if r["eligible"] and r["editorial_role"] == "main-event"]
    queues = {
        "major": sorted((r for r in main if r["major"]), key=lambda r: (-none_low(r["major_rank"]), -r["informationValue"], *newest(r))),
        "personal": sorted((r for r in main if r["personal"]), key=lambda r: (-none_low(r["personal_rank"]), *newest(r))),
        "general": sorted((r for r in main if r["general"]), key=lambda r: (-none_low(r["base_score"]), -r["importance"], *newest(r))),
    }
    top = {r["cluster_id"] for r in queues["major"][: c.major_protect]}
    chosen, skip = [], {}
    for lane, queue in queues.items():
        for r in queue:
            if any(r is x for x, _ in chosen):
                continue
            n = sum(x["topic_group"] == r["topic_group"] for x, _ in chosen)
            if len(chosen) >= (c.target if lane == "general" else c.most):
                skip.setdefault(r["cluster_id"], "digest-size")
            elif lane != "general" and sum(l == lane for _, l in chosen) >= (c.major_cap if lane == "major" else c.personal_cap):
                skip.setdefault(r["cluster_id"], "lower-priority")
            elif n >= c.topic_free and not (n < c.topic_soft and lane != "general") and not (n >= c.topic_soft and lane == "major" and r["cluster_id"] in top):
                skip.setdefault(r["cluster_id"], "category-saturation")
            else:
                chosen.append((r, lane))
    out = {r["cluster_id"]: ("selected", lane, i + 1) for i, (r, lane) in enumerate(chosen)}
    for r in rows:
        reason = r["reason"] if not r["eligible"] else "redundant" if r["editorial_role"] == "related" else skip.get(r["cluster_id"], "below-lane-threshold")
        out.setdefault(r["cluster_id"], ("rejected", reason, None))
    return out


@pytest.mark.parametrize(("seed", "n", "topics"), [(0, 60, 2), (1, 400, 3), (2, 400, 8), (3, 30, 4)])
def test_packing_equals_one_by_one(spark, seed, n, topics):
    rnd = random.Random(seed)
    raw = [(f"c{i:04}", "evaluated" if rnd.random() < 0.9 else "failed", *[rnd.randint(1, 5) for _ in range(5)], rnd.choice([None, rnd.randint(1, 9)]), f"t{rnd.randrange(topics)}", rnd.choice(["main-event", "main-event", "related"])) for i in range(n)]
    df = spark.createDataFrame(raw, "cluster_id string, status string, importance int, informationValue int, impact int, novelty int, personalRelevance int, published_ms long, topic_group string, editorial_role string")
    recs = selection.with_lanes(df.withColumn("base_score", evaluation.base_score(selection.axes(), {"importance": 0.3, "informationValue": 0.25, "impact": 0.2, "novelty": 0.15, "personalRelevance": 0.1}))).cache()
    want = plain_pack([r.asDict() for r in recs.collect()])
    got = {r["cluster_id"]: (r["decision"], r["lane"] if r["decision"] == "selected" else r["reason"], r["rank"]) for r in selection.pack(recs).collect()}
    assert got == want


def test_pool_order_and_union(spark):
    a = spark.createDataFrame([("b", 5, 1), ("a", 5, 1), ("c", None, 9)], "id string, published_ms long, collected_ms long")
    b = spark.createDataFrame([("d", 90_000_000, None, 1)], "id string, published_ms long, collected_ms long, extra int")
    both = pool.union(a, b)
    assert [r["id"] for r in pool.ordered(both).orderBy("pos").collect()] == ["d", "a", "b", "c"]
    assert pool.duplicate_ids(both).count() == 0 and "extra" in both.columns


def test_cluster_edges_need_long_titles(spark):
    rows = spark.createDataFrame([("a", "short", None), ("b", "short", None), ("c", "a longer title", "//u"), ("d", "a longer title", None), ("e", None, "//u")], "id string, title_norm string, url_norm string")
    members = clusters.membership(rows, clusters.forming_edges(rows))
    assert {r["id"]: r["root"] for r in members.collect()} == {"a": "a", "b": "b", "c": "c", "d": "c", "e": "c"}
    types = sorted((r["item_a"], r["item_b"], r["type"]) for r in similarity.relationships(rows).collect())
    assert types == [("a", "b", "same-title"), ("c", "d", "same-title"), ("c", "e", "same-url")]
    assert clusters.violations(rows, members).count() == 0


def test_references(spark):
    url = "https://pbs.twimg.com/a"
    media = [("image", url, None, None, 1, 1)]
    rows = [("a", "x", 4, ["other", "photo"], media), ("b", "x", 3, ["evidence"], media), ("c", "x", 2, ["photo"], media), ("d", "web", 5, ["photo"], media), ("e", "x", 5, ["bogus"], media), ("f", "x", 5, ["photo"], []), ("g", "x", 5, ["other"], None)]
    df = spark.createDataFrame(rows, "id string, source_type string, value int, roles array<string>, media array<struct<type:string,url:string,previewUrl:string,altText:string,width:int,height:int>>")
    got = {r["id"]: (r["roles"], r["selection"]) for r in references.selection(references.candidates(df)).collect()}
    assert got == {"a": (["photo"], "selected"), "b": (["evidence"], "secondary")}


def test_digest_sources_and_markdown(spark):
    rows = [("c", "r", True, "p2", "web", "u1", "t"), ("c", "a", False, "p1", "web", "u1", "t"), ("c", "b", False, "p1", "web", None, "t"), ("c", "d", False, "p0", "web", "u2", "t")]
    df = spark.createDataFrame(rows, "cluster_id string, id string, is_representative boolean, provider string, source_type string, url string, title string")
    assert [r["id"] for r in digest.sources(df).orderBy("pos").collect()] == ["r", "d", "b"]
    items = spark.createDataFrame([("major", 1, "Head [x]", "Sum", None, "p[1]", "https://u", 3), ("general", 2, "no", None, None, "p", None, 1)], "lane string, rank int, headline string, summary string, why string, provider string, url string, n_sources int")
    body = digest.markdown(items, F.lit("2024-01-01")).first()["markdown"]
    assert "- **Head [x]**\n  Sum\n  出典: [p\\[1\\]](https://u)\n  他 2 ソース" in body and "no" not in body and body.endswith("(なし)\n")


def test_freshness_gates(spark):
    good = {"fetch_status": "succeeded", "fetch_run": "r", "run_id": "r", "fetched_at": "2024-01-02T00:00:00Z", "started_at": "2024-01-01T23:00:00Z", "collected_at": "2024-01-01T12:00:00Z", "exported_at": "2024-01-01T12:00:00Z", "now": "2024-01-02T00:00:00Z"}
    cases = [({}, None), ({"fetch_status": "failed"}, "x_same_run_fetch_required"), ({"collected_at": None}, "x_collection_unverified"), ({"collected_at": "x"}, "x_collection_invalid"), ({"exported_at": "x"}, "x_export_invalid"),
             ({"collected_at": "2023-12-31T11:59:00Z", "exported_at": "2024-01-01T00:00:00Z"}, "x_collection_stale"), ({"collected_at": "2023-12-31T12:00:00Z"}, None), ({"collected_at": "2024-01-02T00:06:00Z"}, "x_collection_future"), ({"exported_at": "2024-01-01T11:54:00Z"}, "x_export_before_collection")]
    df = spark.createDataFrame([tuple((good | c)[k] for k in good) for c, _ in cases], ", ".join(f"{k} string" for k in good))
    assert [r[0] for r in df.select(checks.freshness()).collect()] == [want for _, want in cases]


EMPTY = dict.fromkeys(("id", "title", "summary", "category", "sourceType", "sourceUrl", "postedAt", "collectedAt", "author", "scores"))
FEED = {"schemaVersion": 1, "source": feeds.FEED_SOURCE, "generatedAt": "2024-01-01T00:00:00Z", "scope": {"type": "x", "itemCount": 2}, "items": [EMPTY | {"id": "1", "title": "t", "scores": {"impact": 3}}, EMPTY | {"id": "2", "sourceType": "x"}]}


def test_json_feed(spark, tmp_path):
    path = tmp_path / "feed.json"
    path.write_text(json.dumps(FEED))
    rows = {r["id"]: r for r in feeds.ingest_feed(spark, str(path)).collect()}
    first = rows[f"x:{feeds.FEED_SOURCE}:1"]
    assert first["source"]["type"] == "x" and first["scores"]["impact"] == 3 and first["collectedAt"] == FEED["generatedAt"] and rows[f"x:{feeds.FEED_SOURCE}:2"]["scores"]["impact"] is None
    for change in ({"schemaVersion": 2}, {"source": "y"}, {"scope": {"itemCount": 3}}, {"items": [FEED["items"][0]] * 2}, {"items": [{"id": "1"}, FEED["items"][1]]}, {"items": [FEED["items"][0] | {"title": 5}, FEED["items"][1]]}, {"items": [FEED["items"][0] | {"scores": {"impact": "high"}}, FEED["items"][1]]}, {"generatedAt": " "}, {"scope": None}):
        path.write_text(json.dumps(FEED | change))
        with pytest.raises(checks.ValidationError):
            feeds.ingest_feed(spark, str(path))


RSS = """<?xml version="1.0"?><rss version="2.0"><channel><title>c</title><item><title>A &amp;amp; B</title><link>https://a.example/?x=1&amp;y=2</link><guid isPermaLink="false">g1</guid>
<description><![CDATA[<p>Hi &amp; bye</p>]]></description><pubDate>Wed, 02 Oct 2024 13:00:00 GMT</pubDate><category>News</category></item><item><title>No guid</title><link>https://a.example/2</link><pubDate>bad</pubDate></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>f</title><entry><title>E</title><id>urn:1</id><link rel="self" href="https://s.example"/><link rel="alternate" href="https://alt.example"/>
<updated>2024-01-02T00:00:00Z</updated><content>body</content><category term="tech"/><author><name>Ann</name></author></entry></feed>"""


def test_xml_feeds(spark, tmp_path):
    paths = {}
    for name, body in (("rss", RSS), ("atom", ATOM), ("twice", RSS.replace("<guid isPermaLink=\"false\">g1</guid>", "<guid>https://a.example/2</guid>")), ("broken", "<html/>")):
        (tmp_path / f"{name}.xml").write_text(body)
        paths[name] = str(tmp_path / f"{name}.xml")
    sources = spark.createDataFrame([(n, True, "World" if n == "rss" else None) for n in paths], "id string, enabled boolean, defaultCategory string")
    items, status = feeds.ingest_web(spark, paths, sources, "2024-10-03T00:00:00Z")
    rows = {r["id"]: r for r in items.collect()}
    assert {r["provider"]: r["error"] for r in status.collect()} == {"rss": None, "atom": None, "twice": "duplicate-id", "broken": "malformed-xml"}
    a, b, e = rows["web:rss:g1"], rows["web:rss:https://a.example/2"], rows["web:atom:urn:1"]
    assert (a["title"], a["summary"], a["category"], a["publishedAt"], a["source"]["url"]) == ("A & B", "Hi & bye", "News", "2024-10-02T13:00:00.000Z", "https://a.example/?x=1&amp;y=2")
    assert (b["category"], b["publishedAt"]) == ("World", None)
    assert (e["source"]["url"], e["summary"], e["category"], e["source"]["author"]["name"]) == ("https://alt.example", "body", "tech", "Ann")


@pytest.mark.parametrize("chunk", [1_000_000, 40])
def test_cluster_ids_without_lists(spark, chunk):
    """Ids are hashes of the sorted item ids, also of a cluster with a third of all items that spans ranges and pieces."""
    rnd = random.Random(8)
    members = [("a0000", f"i{i:05}é") for i in range(700)] + [(f"r{i % 400:03}", f"j{i:05}") for i in range(1400)] + [("z", "z")]
    rnd.shuffle(members)
    rows = spark.createDataFrame(members, "root string, id string").repartition(3)
    want = {}
    for root, i in sorted(members):
        want.setdefault(root, []).append(i)
    for separator in ("\n", "|"):
        found = {r["root"]: (r["n"], r["sha"]) for r in naming.list_digests(rows, separator, chunk).collect()}
        assert found == {root: (len(ids), hashlib.sha256(separator.join(ids).encode()).hexdigest()) for root, ids in want.items()}
    both = clusters.named_members(rows, clusters.clusters(rows)).collect()
    lists = {r["root"]: r["cluster_id"] for r in clusters.listed(rows).collect()}
    assert len(both) == len(members) and all((r["cluster_id"], r["item_count"]) == (lists[r["root"]], len(want[r["root"]])) for r in both)
    assert naming.list_digests(rows.limit(0), "|").count() == 0


def test_ranks_send_few_rows_of_a_cluster(spark):
    """The plan limits the rank before its shuffle."""
    items = spark.range(3000).select(F.col("id").cast("string").alias("id"), F.col("id").alias("published_ms"), F.col("id").alias("collected_ms"), F.when(F.col("id") >= 0, "t").alias("title"), F.lit("s").alias("summary"))
    ranked = evaluation.ranked_members(items, items.select("id", F.substring("title", 1, 1).alias("root")))
    assert [r["id"] for r in ranked.orderBy("rank").collect()] == ["2999", "2998", "2997", "2996", "2995"]
    assert "WindowGroupLimit" in ranked._jdf.queryExecution().executedPlan().toString()
