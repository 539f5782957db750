"""From raw documents to packed sequences: five operators, one after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and read again as
the next stage's docs. All but the last return the columns of documents. Verdicts go back to rows by doc_id and a hash
of the text, so rows that share a doc_id but not their text are judged each on its own, and rows without a doc_id are
judged by the rules and as exact copies too. Near-duplicate grouping tells rows apart by doc_id alone: rows that share
one stay or go together, and rows without one stay. They lose no bytes either, and of several texts of one doc_id one
may lose bytes. Null texts count as empty and are rejected by the rules; texts of any length go whole through every stage; an empty table
gives an empty result. Columns besides doc_id, text and source are carried along, whatever their names. Near
duplicates are judged on five-word shingles, as the stages of a pipeline are, where the query of the operator takes two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressrun.llm import exact, minhash, packing, quality, suffix
from pressrun.llm._base import fresh, mapped, materialize, table, text_or_empty

NEAR = minhash.NearDup(shingle=5, percent=80)


def _marked(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a hash of the text in a column of a name that docs has not."""
    mark = fresh("text_mark_", docs)
    return docs.withColumn(mark, F.xxhash64(text_or_empty())), mark


def _without(docs: DataFrame, gone: DataFrame, mark: str) -> DataFrame:
    """docs but those whose doc_id and mark are in gone. Rows whose mark is surely not there are not shuffled."""
    gone_id, gone_mark = fresh("gone_id_", docs), fresh("gone_mark_", docs)
    gone = gone.select(F.col("doc_id").alias(gone_id), mark).distinct()
    some, rest = mapped(_marked(docs)[0], gone.select(mark), mark)
    gone = gone.withColumnRenamed(mark, gone_mark).hint("merge")
    same = F.col("doc_id").eqNullSafe(F.col(gone_id)) & (F.col(mark) == F.col(gone_mark))
    return rest.unionByName(some.join(gone, same, "left_anti")).select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marked, mark = _marked(docs)
    verdicts = quality.judge(marked, carry=[mark]).where("NOT kept")
    return _without(docs, materialize(verdicts.select("doc_id", mark), "pipeline-quality"), mark)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marked, mark = _marked(docs)
    found = exact.dedup(marked, carry=[mark]).where("NOT kept")
    return _without(docs, materialize(found.select("doc_id", mark), "pipeline-exact"), mark)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key = fresh("id_key_", docs)
    found = minhash.group(docs, NEAR).where("NOT kept").select(F.col("doc_id").alias(key)).distinct()
    found = materialize(found, "pipeline-near")
    some, rest = mapped(docs.withColumn(key, F.col("doc_id").cast("long")), found, key)
    return rest.unionByName(some.join(found.hint("merge"), key, "left_anti")).select(*docs.columns)


def suffix_array(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that the operator removes, nor what is left of characters that it cut."""
    return suffix.without_repeats(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("suffix-array dedup", suffix_array),
    ("best-fit packing", best_fit_packing),
]

#: Near-duplicates, suffix arrays and packing have no SQL form; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
