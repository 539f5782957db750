"""Fetching of a bounded list of configured sources, on the driver; what it lands is read by Spark.

A getter (url, timeout in seconds) -> (status, body) is injected. Headers and body share one deadline, nothing is tried
twice, and every attempt leaves an observation.
"""

from __future__ import annotations

import json
import threading
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressrun.errors import FetchError
from pressrun.functions.time import lenient
from pressrun.plans.publish import confined

#: A body above this is refused.
MOST_BYTES = 8 * 1024 * 1024
DAY_MS = 86_400_000

Getter = Callable[[str, float], tuple[int, bytes]]
OBSERVATION = "url string, status string, fetched_at string, diagnostic string"


@dataclass(frozen=True)
class Observation:
    url: str
    status: str
    fetched_at: str | None = None
    diagnostic: str | None = None


def http_get(url: str, timeout_s: float) -> tuple[int, bytes]:
    try:
        with urllib.request.urlopen(url, timeout=timeout_s) as r:
            return r.status, r.read(MOST_BYTES + 1)
    except urllib.error.HTTPError as e:
        return e.code, b""
    except OSError as e:
        raise FetchError(str(e), "NETWORK") from e


def utc_now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def bounded(get: Getter, url: str, timeout_s: float, now: Callable[[], str] = utc_now) -> tuple[Observation, bytes | None]:
    """One attempt. The observation of a failure names fetch_timeout, fetch_http, fetch_malformed or fetch_source."""
    if timeout_s <= 0:
        raise ValueError("a positive deadline is needed")
    got: list = []

    def run() -> None:
        try:
            got.append(get(url, timeout_s))
        except Exception as e:
            got.append(e)

    thread = threading.Thread(target=run, daemon=True)
    thread.start()
    thread.join(timeout_s)
    failed = lambda code: (Observation(url, "failed", None, code), None)
    if not got or isinstance(got[0], TimeoutError):
        return failed("fetch_timeout")
    if isinstance(got[0], Exception):
        return failed("fetch_source")
    try:
        status, body = got[0]
    except (TypeError, ValueError):
        return failed("fetch_malformed")
    if not 200 <= status < 300:
        return failed("fetch_http")
    if not isinstance(body, bytes) or len(body) > MOST_BYTES:
        return failed("fetch_malformed")
    return Observation(url, "succeeded", now()), body


def fetch_text(get: Getter, url: str, timeout_s: float = 30.0) -> str:
    try:
        status, body = get(url, timeout_s)
    except FetchError:
        raise
    except Exception as e:
        raise FetchError(str(e), "NETWORK") from e
    if not 200 <= status < 300:
        raise FetchError(f"{url} answered {status}", "HTTP_STATUS", status)
    if len(body) > MOST_BYTES:
        raise FetchError(f"{url} sent more than {MOST_BYTES} bytes", "FETCH")
    return body.decode("utf-8", "replace")


def fetch_json(get: Getter, url: str, timeout_s: float = 30.0) -> object:
    text = fetch_text(get, url, timeout_s)
    try:
        return json.loads(text)
    except ValueError as e:
        raise FetchError(f"{url} is no JSON", "INVALID_JSON") from e


def land(get: Getter, sources: Iterable[tuple[str, str]], folder: str | Path, timeout_s: float = 30.0, now: Callable[[], str] = utc_now) -> tuple[dict[str, str], list[Observation]]:
    """Bodies of the sources (id, url) as files under folder, as they came and before any parsing: paths by id, observations."""
    paths, seen = {}, []
    for name, url in sources:
        observation, body = bounded(get, url, timeout_s, now)
        seen.append(observation)
        if body is not None:
            path = confined(folder, f"{name}.raw")
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_bytes(body)
            paths[name] = f"file://{path}"
    return paths, seen


def receipts(spark: SparkSession, observations: list[Observation]) -> DataFrame:
    return spark.createDataFrame([tuple(asdict(x).values()) for x in observations], OBSERVATION)


def with_observation(sources: DataFrame, seen: DataFrame, now: Column, old_days: float = 7.0) -> DataFrame:
    """sources: provider, url, status (ok or error), generated_at, item_count. The receipt of each source, seen or not.

    A source succeeds if it was fetched and parsed; one whose own date is more than old_days past is only noted.
    """
    met = sources.withColumnRenamed("status", "parsed").join(F.broadcast(seen), "url", "left")  # a row a configured source
    good = F.coalesce((F.col("parsed") == "ok") & (F.col("status") == "succeeded"), F.lit(False))
    age = F.unix_millis(now.cast("timestamp")) - F.unix_millis(lenient(F.col("generated_at")))
    fault = F.when(good, F.when(age > int(old_days * DAY_MS), "web_metadata_old")).otherwise(F.coalesce("diagnostic", F.lit("fetch_malformed")))
    return met.select("provider", F.when(good, "succeeded").otherwise("failed").alias("status"), F.when(good, F.col("fetched_at")).alias("fetched_at"), F.col("generated_at"), "item_count", fault.alias("diagnostic"))
