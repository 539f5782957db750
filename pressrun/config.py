"""Validated settings of every stage."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path


class ConfigError(ValueError):
    """A setting outside its range."""


def _check(ok: bool, message: str) -> None:
    if not ok:
        raise ConfigError(message)


def _weights(values: dict[str, float]) -> None:
    _check(all(v >= 0 for v in values.values()) and abs(sum(values.values()) - 1) <= 1e-9, "weights must not be negative and must add up to 1")


# Query parameters that only track a reader.
TRACKING_PARAMS = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "utm_id", "fbclid", "gclid", "gclsrc", "dclid", "msclkid", "mc_cid", "mc_eid", "igshid")


@dataclass(frozen=True)
class ClusterConfig:
    tracking_params: tuple[str, ...] = TRACKING_PARAMS
    ngram: int = 3
    threshold: float = 0.9
    min_length: int = 12
    same_title_min_length: int = 8
    same_url_confidence: float = 1.0
    same_title_confidence: float = 0.98

    def __post_init__(self) -> None:
        _check(self.ngram >= 1 and self.min_length >= 1 and self.same_title_min_length >= 1, "lengths must be 1 or more")
        _check(0 < self.threshold <= 1, "threshold must be in (0, 1]")


@dataclass(frozen=True)
class CandidateConfig:
    min_title_similarity: float = 0.3
    min_token_overlap: float = 0.25
    min_shared_proper_nouns: int = 2
    max_per_item: int = 5
    max_total: int = 200
    max_hours_apart: float = 168.0
    ngram: int = 3
    min_title_length: int = 8
    judge_version: str = "judge-v1"
    model: str = "external"

    def __post_init__(self) -> None:
        _check(0 < self.min_title_similarity <= 1, "min_title_similarity must be in (0, 1]: at 0 every pair would qualify")
        _check(0 <= self.min_token_overlap <= 1, "min_token_overlap must be in [0, 1]")
        _check(self.max_per_item >= 1 and self.max_total >= 1 and self.min_shared_proper_nouns >= 1, "limits must be 1 or more")


# The five axes of evaluation and their weights.
AXES = ("importance", "informationValue", "impact", "novelty", "personalRelevance")


@dataclass(frozen=True)
class EvaluationConfig:
    weights: dict[str, float] = field(default_factory=lambda: {"importance": 0.3, "informationValue": 0.25, "impact": 0.2, "novelty": 0.15, "personalRelevance": 0.1})
    max_items: int = 5
    clip: int = 400
    version: str = "evaluator-v1"
    model: str = "external"

    def __post_init__(self) -> None:
        _check(set(self.weights) == set(AXES), "weights must name the five axes")
        _weights(self.weights)


# Topic groups in order of priority, their keywords, and the group of a category.
TOPIC_PRIORITY = ("aikido", "disaster", "space", "ai_tech", "creative", "international", "politics", "economy", "science", "social", "other")
TOPIC_KEYWORDS = {
    "aikido": ("合気道", "aikido", "審査課題", "乱取り", "稽古"),
    "disaster": ("土石流", "大雨", "洪水", "浸水", "土砂", "特別警報", "危険警報", "landslide", "flood", "floods", "barrier lake", "猛暑", "熱中症", "earthquake", "wildfire", "typhoon", "hurricane"),
    "space": ("artemis", "nasa", "宇宙望遠鏡", "宇宙", "telescope", "lunar", "moon", "blood moon", "apod", "paranal", "stargazer", "stargazers", "space academy", "space medal", "black hole", "meteor", "celestial"),
    "ai_tech": ("anthropic", "chatbot", "ai psychosis", "ai精神病", "robot", "robots", "ロボティクス", "machine learning", "software", "developer", "macos", "iphone", "galaxy z flip", "byok", "gadget", "ai mode", "generative ai", "llm", "ai", "macs"),
    "creative": ("アニメーター", "アニメ", "漫画", "イラスト", "タイムラプス", "手描き", "night vale", "grim fandango", "デジタル写真集", "ノンタン", "gackt"),
    "international": ("kyiv", "ukraine", "nato", "weapons depot", "genocide", "west bank", "settler", "piracy", "us-iran", "greenland", "migrant crisis", "occupied"),
    "politics": ("選挙", "知事選", "当選", "国民投票", "election", "referendum", "treason", "president", "imprisoned", "monarch", "king harald", "king haakon", "deported", "governor", "eu talks", "公金"),
    "economy": ("oil", "barrels", "tariff", "tariffs", "関税", "economy", "market", "inflation", "trade deal"),
    "science": ("cuttlefish", "dna", "sperm donor", "ecology", "genome", "climate study"),
    "social": ("shooting", "manhunt", "drowning", "溺れ", "閉じ込め", "hackers", "blackmail", "extremism", "money launder", "輸血", "食中毒", "crime"),
}
CATEGORY_FALLBACK = {
    "AI": "ai_tech", "Robot": "ai_tech", "Gadgets": "ai_tech", "Installer": "ai_tech", "Foldable Phones": "ai_tech", "Google": "ai_tech", "Artemis 2": "space", "APOD": "space",
    "Black Holes": "space", "アニメ・漫画": "creative", "イラスト・美術": "creative", "エンタメ・イベント": "creative", "Books": "creative", "政治・社会": "politics", "生活・健康": "social",
}


@dataclass(frozen=True)
class SelectConfig:
    target: int = 10
    most: int = 14
    major_cap: int = 7
    personal_cap: int = 4
    major_protect: int = 3
    topic_soft: int = 3
    topic_free: int = 2
    general_min_base: float = 2.7
    floor_information: int = 1
    floor_low: tuple[int, int, int] = (2, 1, 2)
    major_gate: tuple[int, int] = (4, 3)
    personal_gate: tuple[int, int] = (4, 3)
    major_weights: dict[str, float] = field(default_factory=lambda: {"importance": 0.5, "impact": 0.3, "informationValue": 0.2})
    personal_weights: dict[str, float] = field(default_factory=lambda: {"personalRelevance": 0.4, "informationValue": 0.4, "novelty": 0.2})
    overlap_dice: float = 0.72
    overlap_title_length: int = 16
    overlap_proper: int = 2
    overlap_cjk_run: int = 6
    overlap_long_term: int = 6
    overlap_terms: int = 3
    priority: tuple[str, ...] = TOPIC_PRIORITY
    keywords: dict[str, tuple[str, ...]] = field(default_factory=lambda: TOPIC_KEYWORDS)
    fallback: dict[str, str] = field(default_factory=lambda: CATEGORY_FALLBACK)

    def __post_init__(self) -> None:
        _check(1 <= self.target <= self.most, "target must be between 1 and most")
        _check(self.topic_free <= self.topic_soft, "topic_free must not exceed topic_soft")
        _weights(self.major_weights)
        _weights(self.personal_weights)
        _check(self.priority[-1] == "other" and set(self.keywords) <= set(self.priority), "keywords must name known topic groups")


@dataclass(frozen=True)
class DigestConfig:
    max_supporting: int = 4
    clip: int = 400
    headline: tuple[int, int] = (8, 80)
    summary_most: int = 400
    why_most: int = 200
    zone: str = "Asia/Tokyo"

    def __post_init__(self) -> None:
        _check(0 < self.headline[0] <= self.headline[1], "headline lengths must rise")


@dataclass(frozen=True)
class ReferenceConfig:
    threshold: int = 3
    primary: int = 4

    def __post_init__(self) -> None:
        _check(1 <= self.threshold <= 5 and 1 <= self.primary <= 5, "thresholds must be from 1 to 5")
        _check(self.threshold <= self.primary, "a threshold above the primary value has dropped rows that selection needs")


@dataclass(frozen=True)
class FreshnessConfig:
    max_age_hours: float = 36.0
    future_minutes: float = 5.0
    old_days: float = 7.0

    def __post_init__(self) -> None:
        _check(self.max_age_hours > 0 and self.future_minutes >= 0 and self.old_days > 0, "freshness limits must be positive")


@dataclass(frozen=True)
class ModelConfig:
    timeout_s: float = 30.0
    retries: int = 1

    def __post_init__(self) -> None:
        _check(self.timeout_s > 0 and self.retries >= 0, "timeouts must be positive and retries not negative")


@dataclass(frozen=True)
class RunConfig:
    stage_deadline_s: float = 300.0
    run_deadline_s: float = 1800.0
    fetch_timeout_s: float = 30.0
    history_days: int = 30

    def __post_init__(self) -> None:
        _check(0 < self.stage_deadline_s <= self.run_deadline_s and self.fetch_timeout_s > 0 and self.history_days >= 0, "deadlines must be positive, a stage's no longer than the run's")


# Where the settings stand in the JSON files of each kind.
_MS = 1000.0
FILES: dict[str, tuple[type, dict[str, str]]] = {
    "cluster": (ClusterConfig, {"tracking_params": "url.trackingParams", "ngram": "title.nGramSize", "threshold": "title.similarityThreshold", "min_length": "title.minLength", "same_title_min_length": "title.sameTitleMinLength", "same_url_confidence": "confidence.sameUrl", "same_title_confidence": "confidence.sameTitle"}),
    "semantic": (CandidateConfig, {"min_title_similarity": "candidate.minTitleSimilarity", "min_token_overlap": "candidate.minTokenOverlap", "min_shared_proper_nouns": "candidate.minSharedProperNouns", "max_per_item": "candidate.maxCandidatesPerItem", "max_total": "candidate.maxTotalCandidates", "max_hours_apart": "candidate.maxPublishedHoursApart", "ngram": "candidate.nGramSize", "min_title_length": "candidate.minTitleLength", "judge_version": "judgeVersion", "model": "model"}),
    "evaluation": (EvaluationConfig, {"weights": "weights", "max_items": "maxItemsPerCluster", "clip": "summaryClipChars", "version": "evaluatorVersion", "model": "model"}),
    "select": (SelectConfig, {"target": "digestTarget", "most": "digestMax", "major_cap": "majorCap", "personal_cap": "personalCap", "major_protect": "majorTopProtect", "topic_soft": "topicSoftMax", "topic_free": "topicFreeMax", "general_min_base": "generalMinBaseScore", "floor_information": "qualityFloor.maxInformationValueAlone", "floor_low": "qualityFloor.lowImportance qualityFloor.lowImpact qualityFloor.lowInformationValue", "major_gate": "majorGate.minImportance majorGate.minImpact", "personal_gate": "personalGate.minPersonalRelevance personalGate.minInformationValue", "major_weights": "majorRankWeights", "personal_weights": "personalRankWeights", "overlap_dice": "titleOverlap.minDice", "overlap_title_length": "titleOverlap.minTitleLength", "overlap_proper": "titleOverlap.minSharedProperNouns", "overlap_cjk_run": "titleOverlap.minSharedCjkRun", "overlap_long_term": "titleOverlap.minLongSharedTermLength", "overlap_terms": "titleOverlap.minSharedTermsWithLong", "priority": "topicPriority", "keywords": "topicKeywords", "fallback": "categoryFallback"}),
    "digest": (DigestConfig, {"max_supporting": "maxSupportingItems", "clip": "summaryClipChars", "headline": "headlineMinChars headlineMaxChars", "summary_most": "summaryMaxChars", "why_most": "whyItMattersMaxChars"}),
    "references-selection": (ReferenceConfig, {"primary": "primaryMinValue"}),
    "freshness": (FreshnessConfig, {"max_age_hours": "freshness.x.maxAgeHours", "future_minutes": "freshness.x.futureToleranceMinutes", "old_days": "freshness.web.oldMetadataDiagnosticDays"}),
    "run": (RunConfig, {"stage_deadline_s": "execution.stageDeadlineMs", "run_deadline_s": "execution.runDeadlineMs", "fetch_timeout_s": "fetch.timeoutMs", "history_days": "retention.historyDays"}),
    "model": (ModelConfig, {"timeout_s": "openai.timeoutMs", "retries": "openai.maxRetries"}),
}


def document(path: str | Path, label: str) -> dict:
    """A JSON object of schemaVersion 1; missing and invalid files are told apart."""
    try:
        found = json.loads(Path(path).read_text(encoding="utf-8"))
    except FileNotFoundError:
        raise ConfigError(f"{label} is missing: {path}") from None
    except ValueError as e:
        raise ConfigError(f"{label} is not valid JSON") from e
    _check(isinstance(found, dict), f"{label} must be an object")
    _check(found.get("schemaVersion") == 1, f"{label} has schemaVersion {found.get('schemaVersion')!r}, not 1")
    return found


def read(kind: str, path: str | Path) -> object:
    """Validated settings of one kind from its file; every setting must be there."""
    made, places = FILES[kind]
    found = document(path, f"{kind} settings")

    def at(place: str) -> object:
        value: object = found
        for part in place.split("."):
            _check(isinstance(value, Mapping) and part in value, f"{kind} settings lack {place}")
            value = value[part]  # type: ignore[index]
        if place.endswith("Ms"):
            _check(isinstance(value, (int, float)) and not isinstance(value, bool), f"{place} must be a number")
            return value / _MS  # type: ignore[operator]
        return tuple(value) if isinstance(value, list) else {k: tuple(v) if isinstance(v, list) else v for k, v in value.items()} if isinstance(value, dict) else value

    values = {name: tuple(map(at, place.split())) if " " in place else at(place) for name, place in places.items()}
    usual = made()
    for name, value in values.items():
        default = getattr(usual, name)
        number = isinstance(default, (int, float))
        _check(isinstance(value, (int, float)) and not isinstance(value, bool) if number else isinstance(value, type(default)), f"{kind} settings: {places[name]} is of the wrong type")
        _check(not isinstance(default, int) or value == int(value), f"{kind} settings: {places[name]} must be a whole number")
    return made(**values)


def model_of(configured: str, variable: str, environment: Mapping[str, str]) -> str:
    """The model named by the stage's own variable, by the common one, or by the settings."""
    return next((x for v in (variable, "OPENAI_MODEL") if (x := environment.get(v, "").strip())), configured)


def named_entries(path: str | Path, kind: str) -> list[dict]:
    """Web sources (kind `sources`) or pool inputs (kind `inputs`), with unique ids and their required fields."""
    entries = document(path, kind).get(kind)
    _check(isinstance(entries, list) and all(isinstance(x, dict) for x in entries), f"{kind} must be a list of objects")
    text = {"sources": ("id", "name", "type", "url"), "inputs": ("id", "path")}[kind]
    flag = {"sources": "enabled", "inputs": "required"}[kind]
    for x in entries:
        _check(all(isinstance(x.get(k), str) and x[k].strip() for k in text), f"{kind}: {', '.join(text)} must be text")
        _check(isinstance(x.get(flag, True), bool), f"{kind}: {flag} must be true or false")
        _check(kind == "inputs" or x["type"] in ("rss", "atom") and x["url"].startswith(("http://", "https://")), f"{kind}: type and url of {x['id']}")
    _check(len({x["id"] for x in entries}) == len(entries), f"{kind}: ids must be unique")
    return entries
