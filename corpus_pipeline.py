"""From raw documents to tokens: five stages, each written as Parquet and read again by the next one.

Quality rules drop documents, SimHash keeps one document of each group of near copies (five-word shingles, Jaccard similarity 0.8 and more), documents that hold a benchmark item
go, personal data is replaced, and what is left is encoded: the token ids, their number and the digests of ids and decoded text. Every stage but the last
returns the columns of its input, whatever other columns it has.
Empty tables pass through; a null text fails the quality rules. Of repeated rows and equal texts the smallest id stays; rows that share an id stay or go together.
Very long texts are read whole in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsemill.llm import bpe, decontamination, pii, quality_rules, simhash
from pulsemill.llm.queries import table, tokenizer_file
from pulsemill.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_similar(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [("quality_rules", quality), ("near_dedup", near_dedup), ("decontamination", decontaminate), ("pii", redact), ("bpe", encode)]

#: SQL can express neither SimHash groups nor the walk and the trees; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
