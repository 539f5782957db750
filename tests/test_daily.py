"""Fetching, models, documents, settings, and a whole run over small landed feeds."""

import json
import time

import pytest
from pyspark.sql import functions as F

from pressrun import config
from pressrun.config import AXES
from pressrun.errors import AnswerError, FetchError, PressError, ValidationError
from pressrun.operators import answers, checks
from pressrun.plans import daily, documents, publish
from pressrun.sources import feeds, fetching


def test_bounded_fetch():
    now = lambda: "2024-01-01T00:00:00Z"
    code = lambda get, s=5.0: fetching.bounded(get, "u", s, now)[0].diagnostic
    assert fetching.bounded(lambda u, s: (200, b"x"), "u", 5, now) == (fetching.Observation("u", "succeeded", "2024-01-01T00:00:00Z"), b"x")
    assert code(lambda u, s: (404, b"")) == "fetch_http" and code(lambda u, s: 1 / 0) == "fetch_source" and code(lambda u, s: "x") == "fetch_malformed"
    assert code(lambda u, s: (200, b"x" * (fetching.MOST_BYTES + 1))) == "fetch_malformed" and code(lambda u, s: time.sleep(2), 0.1) == "fetch_timeout"
    for get, want in ((lambda u, s: (500, b""), "HTTP_STATUS"), (lambda u, s: (200, b"{"), "INVALID_JSON"), (lambda u, s: (_ for _ in ()).throw(OSError("down")), "NETWORK")):
        with pytest.raises(FetchError) as e:
            fetching.fetch_json(get, "u")
        assert e.value.code == want


def test_landing_and_receipts(spark, tmp_path):
    get = lambda url, s: (200, b"<rss/>") if url.endswith("a") else (503, b"")
    paths, seen = fetching.land(get, [("a", "https://x/a"), ("b", "https://x/b")], tmp_path, now=lambda: "2024-01-10T00:00:00Z")
    assert list(paths) == ["a"] and (tmp_path / "a.raw").read_bytes() == b"<rss/>"
    rows = [("a", "https://x/a", "ok", "2024-01-01T00:00:00Z", 2), ("b", "https://x/b", "error", None, 0), ("c", "https://x/c", "error", None, 0)]
    found = fetching.with_observation(spark.createDataFrame(rows, "provider string, url string, status string, generated_at string, item_count int"), fetching.receipts(spark, seen), F.to_timestamp(F.lit("2024-01-10T00:00:00Z")))
    assert {r["provider"]: (r["status"], r["diagnostic"]) for r in found.collect()} == {"a": ("succeeded", "web_metadata_old"), "b": ("failed", "fetch_http"), "c": ("failed", "fetch_malformed")}


def test_retries_only_what_may_pass():
    waits = []

    def failing(*statuses):
        left = list(statuses)

        def model(request):
            if left:
                raise AnswerError("no", status=left.pop(0))
            return {"ok": True}

        return answers.retrying(model, retries=2, sleep=waits.append)

    assert failing(429, 503)({}) == {"ok": True} and waits == [0.25, 0.5]
    for statuses in ((400,), (None,), (500, 500, 500)):
        with pytest.raises(AnswerError):
            failing(*statuses)({})


def test_evaluator_answers(spark):
    good = {"scores": dict.fromkeys(AXES, 3), "reason": "  because  "}
    cases = {
        "good": good, "list": [1], "no scores": {"reason": "x"}, "scores list": good | {"scores": [1]}, "no reason": {"scores": good["scores"]}, "reason number": good | {"reason": 5},
        "axis lost": good | {"scores": {a: 3 for a in AXES[1:]}}, "half": good | {"scores": good["scores"] | {AXES[0]: 2.5}}, "text": good | {"scores": good["scores"] | {AXES[0]: "3"}}, "six": good | {"scores": good["scores"] | {AXES[0]: 6}},
    }

    def model(request):
        if request["k"] == "raise":
            raise AnswerError("key sk-abc123 refused\nmore", status=400)
        return cases[request["k"]]

    rows = spark.createDataFrame([(k, json.dumps({"k": k})) for k in [*cases, "raise"]], "k string, request string")
    found = {r["k"]: r for r in answers.evaluate(rows, model).collect()}
    assert found["good"]["status"] == "ok" and found["good"]["reason"] == "because" and [found["good"][a] for a in AXES] == [3] * 5
    want = {"list": "invalid-json", "no scores": "invalid-scores", "scores list": "invalid-scores", "no reason": "invalid-reason", "reason number": "invalid-reason", "axis lost": "missing-axis", "half": "invalid-score", "text": "invalid-score", "six": "invalid-score", "raise": "key [redacted] refused"}
    assert {k: r["error"] for k, r in found.items() if k != "good"} == want and all(r[AXES[0]] is None and r["status"] == "failed" for k, r in found.items() if k != "good")


def test_generator_answers(spark):
    good = {"headline": "A headline here", "summary": "What happened.", "whyItMatters": "It matters."}
    cases = {
        "good": (good, None), "list": ([], "invalid-json"), "lost": ({"headline": "x"}, "invalid-fields"), "blank": (good | {"summary": "  "}, "empty-fields"), "short": (good | {"headline": "short"}, "invalid-headline-length"),
        "long": (good | {"summary": "x" * 401}, "invalid-summary-length"), "why": (good | {"whyItMatters": "x" * 201}, "invalid-why-length"), "url": (good | {"summary": "see https://made.up/x"}, "ungrounded-url"),
        "given": (good | {"summary": "see https://given.example/x"}, None), "banned": (good | {"whyItMatters": "今後が注目される"}, "banned-why-phrase"), "meta": (good | {"summary": "この要約では"}, "banned-meta-phrase"),
    }
    rows = spark.createDataFrame([(k, "Own title", "Own summary", json.dumps({"k": k, "u": "https://given.example/x"})) for k in cases], "k string, title string, summary string, request string")
    found = {r["k"]: r for r in answers.generate(rows, lambda q: cases[q["k"]][0]).collect()}
    assert {k: r["error"] for k, r in found.items()} == {k: e for k, (_, e) in cases.items()}
    assert (found["good"]["headline"], found["good"]["why"], found["good"]["status"]) == ("A headline here", "It matters.", "ok")
    assert (found["list"]["headline"], found["list"]["body"], found["list"]["why"], found["list"]["status"]) == ("Own title", "Own summary", None, "fallback")


def test_requests_show_no_verdicts(spark):
    cases = {'{"a": 1}': False, "no json": True, '{"rank": 1}': True, '{"representative": {"personalRelevance": 1}}': True, '{"x": {"rank": 1}}': False, '{"x": [{"baseScore": 2}]}': True, json.dumps({"title": 'he said "reason": none'}): False}
    rows = spark.createDataFrame([(c,) for c in cases], "c string").select("c", answers.shows_hidden(F.col("c")).alias("x")).collect()
    assert {r["c"]: r["x"] for r in rows} == cases


def test_input_checks(spark):
    rows = spark.createDataFrame([("a", ["1", "2"]), ("a", ["3"]), (" ", ["4"]), ("b", []), ("c", ["5", "5"]), ("d", ["6", ""])], "cluster_id string, item_ids array<string>")
    found = sorted((r["key"], r["rule"]) for r in checks.stage_input(rows, checks.cluster_rules()).collect())
    assert found == sorted([("a", "duplicate"), (" ", "cluster-id"), ("b", "items"), ("c", "unique-items"), ("d", "item-ids")])
    assert [r["rule"] for r in checks.stage_input(rows.limit(0), checks.cluster_rules(), least=1).collect()] == ["empty"]
    after = spark.createDataFrame([("a", ["2", "1"]), ("b", [])], "cluster_id string, item_ids array<string>")
    before = spark.createDataFrame([("a", ["1", "2"]), ("b", []), ("e", ["9"])], "cluster_id string, item_ids array<string>")
    assert sorted(r["cluster_id"] for r in checks.membership_changes(before, after).collect()) == ["a", "e"]
    chosen = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4)], "cluster_id string, rank int")
    items = spark.createDataFrame([("a", 1, 1), ("b", 3, 3), ("c", 3, 4), ("x", 1, 1)], "cluster_id string, rank int, display_order int")
    assert sorted((r["cluster_id"], r["rule"]) for r in checks.digest_faults(chosen, items).collect()) == [("b", "rank-changed"), ("c", "order"), ("d", "missing"), ("x", "not-selected")]


def test_command_line(spark, tmp_path):
    assert documents.request_limit([]) is None and documents.request_limit(["--limit", "5"]) == 5 and documents.request_limit(["x", "--limit=12"]) == 12
    for bad in (["--limit"], ["--limit", "0"], ["--limit=-1"], ["--limit", "--apply"], ["--limit=1.5"], ["--limit="]):
        with pytest.raises(ValidationError):
            documents.request_limit(bad)
    assert [documents.exit_code(*x) for x in ((5, 0), (5, 5), (5, 2), (0, 0))] == [0, 1, 2, 0] and documents.exit_code(5, 5, dry_run=True) == 0
    (tmp_path / ".env").write_text("A=1\nexport B='two'\n# c\nD\n")
    env = {"A": "kept"}
    documents.load_env(tmp_path / ".env", env)
    documents.load_env(tmp_path / "none", env)
    assert env == {"A": "kept", "B": "two"}
    hours = spark.createDataFrame([(None,), (0.04,), (9.96,), (10.5,)], "h double").select(documents.hours_text(F.col("h")).alias("x")).collect()
    assert [r["x"] for r in hours] == ["n/a", "0.0h", "10.0h", "11h"]
    with pytest.raises(ValidationError):
        documents.semantic_output(False, None, hours)


def test_caches_keep_ok_answers_only(spark, tmp_path):
    cache = documents.Cache(spark, tmp_path / "c", "cache_key string, v int, status string")
    assert cache.read().count() == 0 and not cache.save(spark.createDataFrame([("a", 1, "failed")], "cache_key string, v int, status string"))
    assert not (tmp_path / "c").exists()
    assert cache.save(spark.createDataFrame([("a", 1, "ok"), ("b", 1, "failed")], "cache_key string, v int, status string"))
    assert cache.save(spark.createDataFrame([("a", 2, "ok"), ("c", 3, "ok")], "cache_key string, v int, status string"))
    assert sorted((r["cache_key"], r["v"]) for r in cache.read().collect()) == [("a", 2), ("c", 3)]
    other = documents.Cache(spark, tmp_path / "d", "cache_key string, v int, status string")
    other.seed(cache)
    assert other.read().count() == 2


def test_settings_from_files(tmp_path):
    path = tmp_path / "cluster.json"
    usual = {"schemaVersion": 1, "url": {"trackingParams": ["utm_source"]}, "title": {"nGramSize": 2, "similarityThreshold": 0.8, "minLength": 10, "sameTitleMinLength": 5}, "confidence": {"sameUrl": 1, "sameTitle": 0.9}}
    path.write_text(json.dumps(usual))
    assert config.read("cluster", path) == config.ClusterConfig(("utm_source",), 2, 0.8, 10, 5, 1, 0.9)
    for change in ({"schemaVersion": 2}, {"title": {}}, {"title": usual["title"] | {"nGramSize": "2"}}, {"title": usual["title"] | {"nGramSize": 1.5}}, {"title": usual["title"] | {"similarityThreshold": 2}}, {"url": {"trackingParams": "x"}}):
        path.write_text(json.dumps(usual | change))
        with pytest.raises(config.ConfigError):
            config.read("cluster", path)
    path.write_text("{")
    for bad in (path, tmp_path / "none.json"):
        with pytest.raises(config.ConfigError):
            config.read("cluster", bad)
    path.write_text(json.dumps({"schemaVersion": 1, "execution": {"stageDeadlineMs": 2000, "runDeadlineMs": 9000}, "fetch": {"timeoutMs": 500}, "retention": {"historyDays": 3}}))
    assert config.read("run", path) == config.RunConfig(2.0, 9.0, 0.5, 3)
    assert config.model_of("m", "SEMANTIC_MODEL", {"OPENAI_MODEL": "o"}) == "o" and config.model_of("m", "SEMANTIC_MODEL", {"OPENAI_MODEL": "o", "SEMANTIC_MODEL": "s"}) == "s" and config.model_of("m", "X", {"X": " "}) == "m"
    path.write_text(json.dumps({"schemaVersion": 1, "sources": [{"id": "a", "name": "A", "type": "rss", "url": "https://a"}]}))
    assert config.named_entries(path, "sources")[0]["id"] == "a"
    path.write_text(json.dumps({"schemaVersion": 1, "sources": [{"id": "a", "name": "A", "type": "rss", "url": "https://a"}] * 2}))
    with pytest.raises(config.ConfigError, match="unique"):
        config.named_entries(path, "sources")


def test_documents_that_are_missing_or_broken(spark, tmp_path):
    with pytest.raises(ValidationError) as e:
        feeds.read_document(spark, str(tmp_path / "none.json"), feeds.POOL, "pool")
    assert e.value.code == "MISSING"
    (tmp_path / "bad.json").write_text("{nope")
    with pytest.raises(ValidationError) as e:
        feeds.read_document(spark, str(tmp_path / "bad.json"), feeds.POOL, "pool")
    assert e.value.code == "INVALID_JSON"


ITEM = {"summary": None, "category": "World", "sourceType": "x", "sourceUrl": None, "postedAt": "2024-01-01T00:00:00Z", "collectedAt": None, "author": None, "scores": None}
TITLES = ["Quake strikes Northern Harbor town", "Quake strikes Northern Harbor towns", "Election results in Westland surprise Observers", "New telescope finds distant moon", "Market falls after Tariff news", "Local choir sings"]


def make_run(spark, tmp_path, run_id, evaluator, generator=None, x=None):
    feed = {"schemaVersion": 1, "source": feeds.FEED_SOURCE, "generatedAt": "2024-01-01T01:00:00Z", "collectionCompletedAt": "2024-01-01T01:00:00Z", "scope": {"type": "x", "itemCount": len(TITLES)}, "items": [ITEM | {"id": str(i), "title": t, "summary": f"Summary of {t}."} for i, t in enumerate(TITLES)]}
    media = {"media": [{"type": "image", "url": "https://pbs.twimg.com/media/a?format=jpg"}], "visual": {"value": 5, "roles": ["evidence"]}}
    feed["items"][3] |= media
    (tmp_path / "x.json").write_text(json.dumps(feed | (x or {})))
    (tmp_path / "w.xml").write_text("<rss><channel><title>c</title><item><title>Quake strikes Northern Harbor town</title><link>https://w.example/1</link><pubDate>Mon, 01 Jan 2024 00:30:00 GMT</pubDate></item></channel></rss>")
    sources = spark.createDataFrame([("w", "https://w.example/rss", True, "World"), ("gone", "https://g.example/rss", True, "World")], "id string, url string, enabled boolean, defaultCategory string")
    calls = []

    def judge(row):
        calls.append(row)
        return {"relationship": "related-event", "confidence": 0.9}

    write = generator or (lambda q: {"headline": "News: " + q["representative"]["title"], "summary": "What happened there.", "whyItMatters": "People live there."})
    return daily.Daily(spark, run_id, "2024-01-01T02:00:00Z", str(tmp_path / "x.json"), {"w": str(tmp_path / "w.xml")}, sources, judge, evaluator, write, tmp_path / "caches", started_at="2024-01-01T01:30:00Z")


def scorer():
    """A function of its own, which workers get by value."""

    def scores_of(request):
        high = "Quake" in request["representative"]["title"] or "Election" in request["representative"]["title"]
        return {"scores": dict.fromkeys(AXES, 5 if high else 3), "reason": "r"}

    return scores_of


def test_a_whole_run(spark, tmp_path):
    run = make_run(spark, tmp_path, "r1", scorer())
    state = run.run(tmp_path / "root")
    assert [s.id for s in state.stages] == list(daily.STAGE_ORDER)
    ends = {s.id: (s.status, s.diagnostic) for s in state.stages}
    assert ends.pop("ingest:web") == ("degraded", "web_source_failed")
    assert set(ends.values()) == {("succeeded", None)}, ends
    assert state.status == "succeeded_degraded" and all(set(s.outputs) == set(daily.OUTPUTS[s.id]) for s in state.stages)
    work = tmp_path / "root/runs/r1/work"
    found = {tuple(r["item_ids"]) for r in spark.read.parquet(f"{work}/processed/semantic").collect()}
    assert any(len(x) == 3 for x in found) and len(found) == 5
    text = (work / "processed/news-digest.md").read_text()
    assert "News: Quake strikes" in text and "2024-01-01" in text
    assert [r["id"] for r in spark.read.parquet(f"{work}/processed/references").collect()] == [f"x:{feeds.FEED_SOURCE}:3"]
    digest = spark.read.parquet(f"{work}/processed/digest").collect()
    assert {r["status"] for r in digest} == {"ok"} and sorted(r["rank"] for r in digest) == list(range(1, len(digest) + 1))
    manifest = run.promote(tmp_path / "root")
    assert publish.current(tmp_path / "root")[0] == manifest and set(manifest["files"]) == {"news-digest", "news-digest.md", "references"}
    # The caches answer a second run; a generator that breaks rules leaves fallback texts.
    again = make_run(spark, tmp_path, "r2", lambda q: 1 / 0, lambda q: {"headline": "x"}).run(tmp_path / "root")
    assert {s.id: s.status for s in again.stages}["evaluate"] == "succeeded" and again.status == "succeeded_degraded"


def test_runs_that_fail(spark, tmp_path):
    state = make_run(spark, tmp_path, "f1", lambda q: 1 / 0).run(tmp_path / "root")
    ends = {s.id: (s.status, s.diagnostic) for s in state.stages}
    assert ends["evaluate"] == ("failed", "evaluation_incomplete") and ends["select"] == ("skipped", "upstream_failed") and state.status == "failed"
    for change, code in (({"collectionCompletedAt": "2023-12-01T00:00:00Z"}, "x_collection_stale"), ({"collectionCompletedAt": None}, "x_collection_unverified"), ({"schemaVersion": 3}, "x_schema_invalid")):
        run = make_run(spark, tmp_path, f"f-{code}", scorer(), x=change)
        with pytest.raises(PressError) as e:
            run.do_ingest_x(tmp_path / code)
        assert e.value.code == code


def test_previews_and_envelope(spark, tmp_path):
    items = spark.createDataFrame([("a", "P", "Title"), ("b", None, None)], "id string, provider string, title string")
    pairs = spark.createDataFrame([("a", "b", 0.5, 0.7, None), ("b", "c", 0.9, None, 12.6)], "item_a string, item_b string, candidate_score double, title_similarity double, hours_apart double")
    lines = [r["line"] for r in documents.candidate_preview(pairs.where("item_a = 'a'"), items).collect()]
    assert lines == ["1. score=0.5 dice=0.7 time=n/a\n   P | Title\n   unknown | (untitled)"]
    targets = spark.createDataFrame([(2, 1, "P", "T"), (1, 3, None, None)], "pos long, item_count long, provider string, title string")
    assert [r["line"] for r in documents.target_preview(targets, 1).collect()] == ["1. items=3 unknown | (untitled)"]
    assert documents.summary("s", {"a": 1}, ["x"]) == "s\n  a: 1\nx"
    (tmp_path / "x.json").write_text(json.dumps({"schemaVersion": 1, "generatedAt": "g", "items": []}))
    row = feeds.envelope(feeds.read_feed(spark, str(tmp_path / "x.json")), items, "now", "https://f").first()
    assert row["generatedAt"] == "now" and row["sourceFeeds"][0]["itemCount"] == 2 and row["sourceFeeds"][0]["sourceGeneratedAt"] == "g"


def test_command_line_reports(tmp_path, capsys):
    from pressrun.__main__ import main

    assert main(["current", "--root", str(tmp_path)]) == 1 and main(["recover", "--root", str(tmp_path)]) == 1
    publish.write_text(tmp_path / "work/a.txt", "a")
    publish.create_candidate(tmp_path / "work", ["a.txt"], "e1")
    publish.promote(tmp_path / "work", tmp_path)
    assert main(["current", "--root", str(tmp_path)]) == 0 and capsys.readouterr().out.strip() == "e1"


def test_reference_rules(spark):
    rows = spark.createDataFrame([("a", 3, ["evidence"], [1]), ("b", 2, ["evidence"], [1]), ("c", 4, ["what"], [1]), ("d", 5, ["other"], []), ("", 5, ["other"], [1])], "id string, value int, roles array<string>, media array<int>")
    found = checks.stage_input(rows, checks.reference_rules(("evidence", "other"), 3), "id")
    assert sorted((r["key"], r["rule"]) for r in found.collect()) == [("", "id"), ("b", "value"), ("c", "roles"), ("d", "media")]
