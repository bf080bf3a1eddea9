"""The training-data pipeline over documents, and the registry of its operators.

Each stage takes what its predecessor kept, whole, and is written before the next begins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from signalmill.llm.common import stored, table, tokenizer_path
from signalmill.llm.language_id import documents_with_language
from signalmill.llm.ngram_join import one_of_each_group
from signalmill.llm.packing import packed
from signalmill.llm.queries import ORACLES, QUERIES
from signalmill.llm.source_mix import mixed_documents


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones tell; no letters, no language."""
    return documents_with_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest doc_id."""
    return one_of_each_group(docs, width=5, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target weights: documents left out, whole, in part or twice."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens: a row for each piece of a document with its place."""
    return packed(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("packing", packing),
]
# The mixture inference and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {**QUERIES, "pipeline": run}
__all__ = ["ORACLES", "ORACLE_SQL", "QUERIES", "STAGES", "run"]
