"""The corpus pipeline: from raw documents to token ids of a filtered, deduplicated and decontaminated corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hypsogrid.llm import bpe, decontaminate, jaccard_join, quality_lm, quality_rules, shared


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_lm.keep_good(docs, _table(spark, sf_dir, "labels"))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_passing(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of op1 for what is left: ids and decoded bytes as digests."""
    return bpe.round_trip(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", rules),
    ("jaccard_join", one_of_each_group),
    ("decontamination", decontamination),
    ("byte_bpe", encoding),
]
#: Models, joins by sketches and byte-pair merges are beyond SQL; tests hold the operators against brute force, and
#: the stages' columns, ids and kept rows against small tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
