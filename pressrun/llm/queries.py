"""The queries of this subpackage and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pressrun.llm import bpe, exact, html, minhash, packing, periodic, phrases, quality, sharding, suffix, token_output, toxicity, urls
from pressrun.llm._base import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.dedup(table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(table(spark, sf_dir, "pages"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"))


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents"))


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.read(*token_output.write(table(spark, sf_dir, "documents")))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.group(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.collapse(periodic.planted(table(spark, sf_dir, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": lambda s, d: op1_quality_rules(s, d).drop("host", "host_rate"),
    "op2_exact_dedup": op2_exact_dedup,
    "op3_html_extraction": op3_html_extraction,
    "op4_bpe": op4_bpe,
    "op5_suffix_array": op5_suffix_array,
    "op6_token_output": op6_token_output,
    "op7_minhash": op7_minhash,
    "op8_toxicity": op8_toxicity,
    "op9_packing": op9_packing,
    "op10_sharding": op10_sharding,
    "op11_phrases": op11_phrases,
    "op12_url_filter": op12_url_filter,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLES: dict[str, str] = {"op1_quality_rules": quality.ORACLE, "op2_exact_dedup": exact.ORACLE, "op5_suffix_array": suffix.ORACLE, "op7_minhash": minhash.ORACLE, "op11_phrases": phrases.ORACLE}
