"""Queries of the training-data operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import attention_lm, bpe, chat, decontaminate, jaccard_join, language_id, merkle, pii, prefix_trie, quality_lm, quality_rules, sharding, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op9_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query
def op7_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspective_rows(table(spark, sf_dir, "conversations"))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_documents(table(spark, sf_dir, "documents"))


ORACLES |= {"op6_warc_revisits": warc.ORACLE, "op7_perspective_rotation": chat.ORACLE, "op8_quality_rules": quality_rules.ORACLE}


@query
def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_lm.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_documents(table(spark, sf_dir, "documents"))


@query
def op10_byte_gru_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


@query
def op4_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score_documents(table(spark, sf_dir, "documents"))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.prove_documents(table(spark, sf_dir, "documents"))


ORACLES["op13_merkle_manifest"] = merkle.ORACLE


@query
def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


ORACLES["op11_conversation_prefix_trie"] = prefix_trie.ORACLE


@query
def op12_pii_candidate_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_documents(table(spark, sf_dir, "documents"))
