"""A training corpus from the table `documents`, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as
Parquet in the shared folder and hands the copy to the next stage. All but the last
return the columns of their input, whatever these are, and work on rows without an
id, without a text, or that repeat. An empty table goes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.llm import decontaminate, language, minhash, mixing, records
from gridcast.llm.common import fresh, row_key, scratch, table, written
from gridcast.llm.queries import tokenizer_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: no text, no letter. The model learns from two thirds of the labelled rows."""
    labelled = docs.where(language.in_training(F.col("doc_id")))
    predicted, scored = fresh(docs, "_lang_pred"), fresh(docs, "_lang_score")
    found = language.identify(docs, language.train(labelled), names=(predicted, scored))
    return found.where(F.col(predicted) != language.UNKNOWN).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, of the smallest id, of each group of near-duplicates."""
    return minhash.keep_one(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of a benchmark item."""
    key = fresh(docs, "_key")
    keyed = docs.withColumn(key, row_key(F.col("doc_id"), F.col("text")))
    found = decontaminate.find_overlaps(keyed.select(F.col(key).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    hit = written(found.select(F.col("doc_id").alias(key)).distinct(), "contaminated")
    return keyed.join(hit, key, "left_anti").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document none, one or two times, so that sources come near their targets."""
    return mixing.take(docs, table(spark, sf_dir, "labels"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token ids as binary records; one row per record, read back from the files."""
    path = scratch(spark, "corpus")
    records.write_records(docs, path, tokenizer_path())
    return records.read_index(spark, path).select(
        "doc_id", "start", "n_tokens", "ids_crc32", "path", "shard", "part", "offset", "length")


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmarks),
    ("mixing", mixed),
    ("records", encoded),
]

# Near-duplicate classes and BPE ids have no SQL; tests/llm/test_pipeline.py checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
