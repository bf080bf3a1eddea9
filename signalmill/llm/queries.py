"""Registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmill.llm.common import table, tokenizer_path
from signalmill.llm.context_mixing import context_mixing_scores, training
from signalmill.llm.filter_audit import filter_audit
from signalmill.llm.html_extract import html_texts
from signalmill.llm.language_id import language_id
from signalmill.llm.merkle import merkle_manifest
from signalmill.llm.ngram_join import ngram_join
from signalmill.llm.oracles import ORACLES
from signalmill.llm.packing import packed
from signalmill.llm.simhash_dedup import simhash_dedup
from signalmill.llm.source_mix import source_mix
from signalmill.llm.token_counts import token_counts
from signalmill.llm.token_files import read_token_files, token_digest, write_token_files
from signalmill.llm.top_k import threshold_top_k
from signalmill.llm.vector_forest import forest_search
from signalmill.session import shared_folder


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts(docs, tokenizer_path("piece_bpe_32k.model"), limit=4096)


def op2_vector_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest_search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "token-files")
    write_token_files(
        table(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"), end_id=0
    )
    return token_digest(read_token_files(spark, path))


def op4_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = source_mix(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join(table(spark, sf_dir, "documents"), width=5, percent=80)
    return found.select("doc_id", "n_shingles", "component_id")


def op7_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = context_mixing_scores(table(spark, sf_dir, "documents"), training())
    return scores.withColumn("held_out", ~training()).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score",
        "bits_per_byte",
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "langs")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_texts(table(spark, sf_dir, "pages"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    forged = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found = merkle_manifest(table(spark, sf_dir, "documents"), forged)
    return found.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


def op12_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return filter_audit(spark, f"{sf_dir}/documents.parquet", labels)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_vector_forest": op2_vector_forest,
    "op3_token_files": op3_token_files,
    "op4_threshold_top_k": op4_threshold_top_k,
    "op5_source_mix": op5_source_mix,
    "op6_ngram_join": op6_ngram_join,
    "op7_context_mixing": op7_context_mixing,
    "op8_language_id": op8_language_id,
    "op9_packing": op9_packing,
    "op10_html_extract": op10_html_extract,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_simhash_dedup": op12_simhash_dedup,
    "op13_filter_audit": op13_filter_audit,
}

__all__ = ["ORACLES", "QUERIES"]
