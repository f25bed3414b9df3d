"""Registered queries of the subpackage; each covers its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.llm import counts, decontaminate, embeddings, fim, language, licenses, lm, minhash, mixing, negatives, pii, records, substrings
from gridcast.llm.common import scratch, table

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def register(build):
        LLM_QUERIES[name] = build
        if oracle is not None:
            LLM_ORACLES[name] = oracle
        return build

    return register


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@_query("op1_licenses", licenses.oracle())
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, folder, "documents")).withColumn("score", F.round("score", 6))


@_query("op9_mixing", mixing.ORACLE)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), table(spark, folder, "labels"))


@_query("op6_records")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "records")
    records.write_records(table(spark, folder, "documents"), path, tokenizer_path())
    return records.read_index(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "offset", "length")


@_query("op10_token_counts")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return counts.roll_up(table(spark, folder, "documents"), tokenizer_path(), scratch(spark, "rollup"))


@_query("op4_language")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return language.language_of_documents(table(spark, folder, "documents"))


@_query("op8_decontamination")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@_query("op7_near_duplicates")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


@_query("op3_near_vectors")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, folder, "embeddings"))


@_query("op5_lm_scores")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score_documents(table(spark, folder, "documents"))


@_query("op2_substrings")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, folder, "documents"))


@_query("op11_fill_in_middle", fim.oracle())
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return fim.digests(table(spark, folder, "documents"))


@_query("op12_hard_negatives", negatives.ORACLE)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, folder, "embeddings"))


@_query("op13_personal_data")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digests(table(spark, folder, "documents"))


@_query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
