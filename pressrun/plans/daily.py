"""A whole edition: eleven stages from landed feeds to a candidate that can be published.

Stages hand tables on as Parquet in the run's work folder; the edition itself, a bounded number of items, is written as
files. Models are injected. A stage that may fail without ending the run is named in DEGRADABLE.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressrun.config import AXES, CandidateConfig, ClusterConfig, DigestConfig, EvaluationConfig, FreshnessConfig, ReferenceConfig, SelectConfig
from pressrun.errors import StageError, ValidationError
from pressrun.functions.ids import key
from pressrun.functions.time import lenient
from pressrun.operators import answers, candidates, checks, clusters, digest, evaluation, judging, pool, references, selection, similarity
from pressrun.operators.graph import stored
from pressrun.plans import documents, publish
from pressrun.sources import feeds, fetching
from pressrun.sources.tables import featured

# The stages in order, those that may fail, and what each leaves in the work folder.
STAGE_ORDER = ("ingest:x", "ingest:web", "unify", "cluster", "semantic", "evaluate", "select", "digest", "references", "references:select", "validate-edition")
DEGRADABLE = frozenset({"ingest:web", "digest", "references"})
OUTPUTS = {
    "ingest:x": ("normalized/x", "provenance/x"), "ingest:web": ("normalized/web", "provenance/web"), "unify": ("normalized/pool",), "cluster": ("processed/clusters", "processed/clusters-review"),
    "semantic": ("processed/semantic", "processed/judgments"), "evaluate": ("processed/evaluated",), "select": ("processed/selected",),
    "digest": ("processed/digest", "processed/news-digest.md"), "references": ("processed/references-candidates",), "references:select": ("processed/references",),
    "validate-edition": ("edition/news-digest", "edition/news-digest.md", "edition/references", "edition/manifest.json"),
}
JUDGMENTS = "cache_key string, item_a string, item_b string, relationship string, confidence double, status string"
SCORES = "cache_key string, cluster_id string, reason string, status string, " + ", ".join(f"{a} int" for a in AXES)
TEXTS = "cache_key string, cluster_id string, headline string, body string, why string, status string"


def flat(items: DataFrame) -> DataFrame:
    """Items of the nested model as operators read them."""
    ms = lambda c: F.unix_millis(lenient(F.col(c)))
    return items.select(
        "id", F.col("source.type").alias("source_type"), F.col("source.provider").alias("provider"), F.col("source.url").alias("url"), "title", "summary", "category", F.col("publishedAt").alias("published_at"),
        ms("publishedAt").alias("published_ms"), ms("collectedAt").alias("collected_ms"),
    )


@dataclass
class Daily:
    """One run. x_feed and web_feeds are landed files; sources has id, url, enabled, defaultCategory; fetched holds their receipts."""

    spark: SparkSession
    run_id: str
    now: str
    x_feed: str
    web_feeds: dict[str, str]
    sources: DataFrame
    judge: Callable[[dict], dict]
    evaluator: Callable[[dict], dict]
    generator: Callable[[dict], dict]
    caches: Path
    fetched: list[fetching.Observation] = field(default_factory=list)
    started_at: str | None = None
    cluster: ClusterConfig = field(default_factory=ClusterConfig)
    pairs: CandidateConfig = field(default_factory=CandidateConfig)
    evaluation: EvaluationConfig = field(default_factory=EvaluationConfig)
    select: SelectConfig = field(default_factory=SelectConfig)
    digest: DigestConfig = field(default_factory=DigestConfig)
    reference: ReferenceConfig = field(default_factory=ReferenceConfig)
    freshness: FreshnessConfig = field(default_factory=FreshnessConfig)

    def stages(self, deadline_s: float = 300.0) -> list[publish.Stage]:
        run = {name: getattr(self, "do_" + name.replace(":", "_").replace("-", "_")) for name in STAGE_ORDER}

        def stage(name: str) -> Callable[[Path], tuple[list[str], list[str]]]:
            return lambda work: (list(OUTPUTS[name]), run[name](work) or [])

        return [publish.Stage(name, stage(name), name in DEGRADABLE, deadline_s) for name in STAGE_ORDER]

    def run(self, root: str | Path, deadline_s: float = 1800.0) -> publish.RunState:
        """All stages under the lock of root."""
        with publish.Lock(Path(root) / "lock", self.run_id):
            return publish.run_stages(self.spark, self.stages(), root, self.run_id, deadline_s)

    def promote(self, root: str | Path) -> dict:
        """Publishes the candidate of a run that succeeded."""
        with publish.Lock(Path(root) / "lock", self.run_id):
            return publish.promote(publish.confined(root, f"runs/{self.run_id}/work/edition"), root)

    # ------------------------------------------------------------ tables of the work folder

    def write(self, work: Path, name: str, df: DataFrame) -> None:
        df.write.parquet(f"file://{publish.confined(work, name)}")

    def read(self, work: Path, name: str) -> DataFrame:
        path = publish.confined(work, name)
        if not path.is_dir():
            raise ValidationError(f"{name} is missing", "MISSING")
        return self.spark.read.parquet(f"file://{path}")

    def cache(self, name: str, schema: str) -> documents.Cache:
        return documents.Cache(self.spark, self.caches / name, schema)

    # ------------------------------------------------------------ stages

    def do_ingest_x(self, work: Path) -> None:
        seen = next((x for x in self.fetched if x.url == self.x_feed), fetching.Observation(self.x_feed, "succeeded", self.now))
        if seen.status != "succeeded":
            raise StageError(code=seen.diagnostic)
        try:
            items = feeds.ingest_feed(self.spark, self.x_feed)
        except ValidationError as e:
            raise StageError(str(e), "x_schema_invalid") from e
        feed = feeds.read_feed(self.spark, self.x_feed)
        literal = {"fetch_status": seen.status, "fetch_run": self.run_id, "run_id": self.run_id, "fetched_at": seen.fetched_at, "started_at": self.started_at or self.now, "now": self.now}
        state = feed.select(F.col("collectionCompletedAt").alias("collected_at"), F.col("generatedAt").alias("exported_at"), *[F.lit(v).alias(k) for k, v in literal.items()])
        receipt = state.withColumn("diagnostic", checks.freshness(self.freshness))
        fault = receipt.first()["diagnostic"]
        if fault:
            raise StageError(code=fault)
        self.write(work, "normalized/x", items)
        self.write(work, "provenance/x", receipt.join(F.broadcast(items.agg(F.count("*").alias("item_count")))))

    def do_ingest_web(self, work: Path) -> list[str]:
        items, status = feeds.ingest_web(self.spark, self.web_feeds, self.sources, self.now)
        seen = self.fetched or [fetching.Observation(r["url"], "succeeded", self.now) for r in self.sources.where("enabled").select("url").collect()]  # configured sources
        dated = status.join(self.sources.select(F.col("id").alias("provider"), "url"), "provider").withColumn("generated_at", F.lit(None).cast("string"))
        receipts = stored(fetching.with_observation(dated, fetching.receipts(self.spark, seen), F.to_timestamp(F.lit(self.now)), self.freshness.old_days))
        self.write(work, "provenance/web", receipts)
        counts = {r["status"]: r["count"] for r in receipts.groupBy("status").count().collect()}
        if not counts.get("succeeded"):
            raise StageError(code="web_all_failed")
        good = receipts.where("status = 'succeeded'").select(F.col("provider").alias("p"))
        self.write(work, "normalized/web", items.join(F.broadcast(good), items["source.provider"] == good["p"], "left_semi"))
        old = not receipts.where("diagnostic = 'web_metadata_old'").isEmpty()
        return ["web_source_failed"] * bool(counts.get("failed")) + ["web_metadata_old"] * old

    def do_unify(self, work: Path) -> None:
        found = [self.read(work, "normalized/x")] + ([self.read(work, "normalized/web")] if (work / "normalized/web").is_dir() else [])
        rows = pool.union(*found)
        checks.require(checks.broken(rows, "id", checks.item_rules()).unionByName(checks.repeated(rows, "id")), "pool")
        self.write(work, "normalized/pool", rows)

    def rows(self, work: Path) -> DataFrame:
        return stored(featured(flat(self.read(work, "normalized/pool"))))

    def do_cluster(self, work: Path) -> None:
        rows = self.rows(work)
        members = clusters.membership(rows, clusters.forming_edges(rows, self.cluster))
        checks.require(clusters.violations(rows, members).withColumnRenamed("id", "key"), "clusters")
        for name, df in documents.cluster_outputs(clusters.listed(members), similarity.link_counts(rows, members, self.cluster)).items():
            self.write(work, "processed/clusters" if name == "clusters" else "processed/clusters-review", df)

    def do_semantic(self, work: Path) -> None:
        rows = self.rows(work)
        found = self.read(work, "processed/clusters").select(F.explode("item_ids").alias("id"), F.col("item_ids")[0].alias("root"))
        pairs = judging.with_cache_key(candidates.candidates(rows, self.pairs), rows, self.pairs.model, self.pairs.judge_version)
        probed = stored(judging.probe(pairs, self.cache("semantic", JUDGMENTS).read()))
        side = lambda s: rows.select(F.col("id").alias(f"item_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in ("title", "summary", "provider", "published_at")])
        open_ = probed.where("NOT cache_hit").select("cache_key", "item_a", "item_b").join(side("a"), "item_a").join(side("b"), "item_b")
        fresh = stored(judging.judge(open_, self.judge).select("cache_key", "item_a", "item_b", "relationship", "confidence", "status"))
        self.cache("semantic", JUDGMENTS).save(fresh)
        known = probed.where("cache_hit").select("cache_key", "item_a", "item_b", "relationship", "confidence", F.lit("ok").alias("status"))
        judgments = stored(known.unionByName(fresh))
        if not judgments.where("status <> 'ok'").isEmpty():
            raise StageError(code="semantic_incomplete")
        merged, _ = judging.merge(found, judgments)
        self.write(work, "processed/judgments", documents.semantic_output(True, pairs, judgments)["judgments"])
        self.write(work, "processed/semantic", clusters.listed(merged).select("cluster_id", "item_ids"))

    def do_evaluate(self, work: Path) -> None:
        rows, found = self.rows(work), self.read(work, "processed/semantic")
        checks.require(checks.stage_input(found, checks.cluster_rules()), "clusters")
        members = found.select("cluster_id", F.explode("item_ids").alias("id")).select("id", F.col("cluster_id").alias("root"))
        ranked = stored(evaluation.ranked_members(rows, members, self.evaluation))
        facts = evaluation.representatives(ranked).drop("rank").join(evaluation.signals(rows, members), "root")
        asked = answers.evaluation_requests(facts, evaluation.supporting(ranked, self.evaluation).withColumnRenamed("rank", "pos"), self.evaluation)
        asked = stored(asked.withColumn("cluster_id", F.col("root")).withColumn("cache_key", key(F.col("root"), F.sha2(F.col("request").cast("binary"), 256), F.lit(self.evaluation.model), F.lit(self.evaluation.version))))
        cache = self.cache("evaluation", SCORES)
        known = cache.read().where("status = 'ok'").select("cache_key", "status", *AXES)
        fresh = stored(answers.evaluate(asked.select("cache_key", "cluster_id", "request").join(known.select("cache_key"), "cache_key", "left_anti"), self.evaluator))
        cache.save(fresh)
        scores = known.unionByName(fresh.select("cache_key", "status", *AXES))
        scored = stored(asked.join(scores, "cache_key").withColumn("status", F.when(F.col("status") == "ok", "evaluated").otherwise("unevaluated")))
        scored = scored.withColumn("base_score", evaluation.base_score(selection.axes(), self.evaluation.weights))
        if scored.where("status = 'evaluated'").count() != found.count():
            raise StageError(code="evaluation_incomplete")
        self.write(work, "processed/evaluated", scored.join(found, "cluster_id"))
        stated = self.read(work, "processed/evaluated").select("root", *evaluation.SIGNALS)
        if not evaluation.mismatches(stated, rows, members).isEmpty():
            raise StageError("stated signals differ from those of the items", "evaluation_incomplete")

    def do_select(self, work: Path) -> None:
        scored = self.read(work, "processed/evaluated")
        checks.require(checks.stage_input(scored, checks.cluster_rules(), least=1), "evaluated")
        recs = stored(selection.with_lanes(scored, self.select))
        of = scored.select(F.explode("item_ids").alias("id"), "cluster_id")
        related = self.read(work, "processed/judgments").where("relationship = 'related-event'")
        judged = related.join(of.select(F.col("id").alias("item_a"), F.col("cluster_id").alias("cluster_a")), "item_a").join(of.select(F.col("id").alias("item_b"), F.col("cluster_id").alias("cluster_b")), "item_b")
        recs = stored(selection.with_topic(selection.related_groups(recs, judged.select("cluster_a", "cluster_b"), self.select), self.select))
        decided = stored(selection.pack(recs, self.select))
        if not selection.partition_errors(recs, decided).isEmpty() or not checks.membership_changes(scored, recs).isEmpty():
            raise StageError(code="pipeline_failed")
        self.write(work, "processed/selected", documents.decision_order(decided).join(recs.select("cluster_id", "related_group_id", "editorial_role", "topic_group", "item_ids"), "cluster_id"))

    def do_digest(self, work: Path) -> list[str]:
        chosen = self.read(work, "processed/selected").where("decision = 'selected'").select("cluster_id", "lane", "rank", "topic_group")
        checks.require(checks.stage_input(chosen, checks.selected_rules()), "selected")
        facts = self.read(work, "processed/evaluated").drop("status", "error", "reason", "request", "cache_key")
        top = stored(chosen.join(facts, "cluster_id"))
        items = digest.joined(chosen, facts.select("cluster_id", F.explode("item_ids").alias("id")), self.rows(work)).join(top.select("cluster_id", F.col("id").alias("rep_id")), "cluster_id").withColumn("is_representative", F.col("id") == F.col("rep_id"))
        items = stored(items)
        asked = answers.digest_requests(top, digest.supporting(items, self.digest), self.digest)
        asked = stored(asked.withColumn("cache_key", key(F.col("cluster_id"), F.sha2(F.col("request").cast("binary"), 256), F.lit("digest"))))
        if not asked.where(answers.shows_hidden(F.col("request"))).isEmpty():
            raise StageError("a request shows scores or verdicts", "digest_failed")
        cache = self.cache("digest", TEXTS)
        known = cache.read().where("status = 'ok'").select("cache_key", "status", "headline", "body", "why")
        fresh = stored(answers.generate(asked.select("cache_key", "cluster_id", "title", "summary", "request").join(known.select("cache_key"), "cache_key", "left_anti"), self.generator, self.digest))
        cache.save(fresh)
        texts = known.unionByName(fresh.select("cache_key", "status", "headline", "body", "why"))
        n = digest.sources(items).groupBy("cluster_id").agg(F.count("*").cast("int").alias("n_sources"))
        out = asked.join(texts, "cache_key").join(n, "cluster_id").select("cluster_id", "lane", "rank", F.col("rank").alias("display_order"), "status", "headline", F.col("body").alias("summary"), "why", "provider", "url", "n_sources")
        out = stored(out)
        if not checks.digest_faults(chosen, out).isEmpty():
            raise StageError(code="digest_failed")
        self.write(work, "processed/digest", out)
        day = self.spark.range(1).select(F.date_format(F.from_utc_timestamp(F.to_timestamp(F.lit(self.now)), self.digest.zone), "yyyy-MM-dd")).first()[0]
        publish.write_text(publish.confined(work, "processed/news-digest.md"), digest.markdown(out, F.lit(day)).first()["markdown"])
        return ["digest_fallback"] * (not out.where("status <> 'ok'").isEmpty())

    def do_references(self, work: Path) -> list[str]:
        items = self.read(work, "normalized/pool")
        rows = items.select("id", F.col("source.type").alias("source_type"), F.col("visual.value").alias("value"), F.col("visual.roles").alias("roles"), "media")
        found = stored(documents.reference_order(references.candidates(rows, self.reference)))
        self.write(work, "processed/references-candidates", found)
        return ["references_empty"] * found.isEmpty()

    def do_references_select(self, work: Path) -> None:
        path = work / "processed/references-candidates"
        if path.is_dir():
            found = self.read(work, "processed/references-candidates")
            checks.require(checks.stage_input(found, checks.reference_rules(references.ROLES, self.reference.threshold), "id"), "references")
        else:
            found = self.spark.createDataFrame([], "id string, value int, roles array<string>")
        self.write(work, "processed/references", references.selection(found, self.reference))

    def do_validate_edition(self, work: Path) -> None:
        try:
            for name in ("news-digest", "references"):
                self.read(work, "processed/" + name.removeprefix("news-")).coalesce(1).write.json(f"file://{publish.confined(work, 'edition/' + name)}")
            publish.write_text(publish.confined(work, "edition/news-digest.md"), (work / "processed/news-digest.md").read_text(encoding="utf-8"))
            publish.create_candidate(publish.confined(work, "edition"), ["news-digest", "news-digest.md", "references"], self.run_id)
            publish.validate_candidate(work / "edition")
        except (OSError, ValidationError, publish.PublishError) as e:
            raise StageError(str(e), "edition_invalid") from e
