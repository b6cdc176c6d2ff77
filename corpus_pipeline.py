"""A corpus from documents to packed sequences: each stage applies one operator of ``tickloom.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import mixing, ngram_join, packing, paragraphs, rules
from tickloom.llm.common import materialise, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return rules.accepted(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    return ngram_join.without_similar(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the paragraphs that an earlier one has."""
    return paragraphs.without_paragraphs(docs, paragraphs.duplicate_paragraphs(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents as often as they are taken."""
    return mixing.mixture(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, in windows."""
    return packing.packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("packing", pack),
]

#: The last stage retrieves neighbours by a ranking that SQL cannot express; the tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; every stage but the last is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, name)
    return docs
