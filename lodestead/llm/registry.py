"""Queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from .chat_format import repair_roles
from .common import table
from .decontaminate import ORACLE_SQL as DECONTAMINATION_SQL
from .decontaminate import benchmark_hits
from .html_extract import extract_text
from .language import identify_languages
from .mixing import ORACLE_SQL as MIXING_SQL
from .mixing import mix_to_weights
from .near_dedup import ORACLE_SQL as NEAR_SQL
from .near_dedup import near_duplicates
from .neighbours import nearest
from .periodic import ORACLE_SQL as RUNS_SQL
from .periodic import periodic_runs, planted, run_digests
from .prefix_trie import ORACLE_SQL as TRIE_SQL
from .prefix_trie import conversation_trie, numbered_turns, rebuilt
from .spotsigs import fingerprint_documents
from .suffix_dedup import ORACLE_SQL as REPEATS_SQL
from .suffix_dedup import remove_repeats
from .toxicity import score_toxicity
from .url_filter import ORACLE_SQL as URL_SQL
from .url_filter import filter_urls


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_roles(table(spark, sf_dir, "conversations"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op8_spotsigs_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


def op10_mix_to_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_to_weights(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return run_digests(periodic_runs(docs.select("doc_id", planted(docs["doc_id"], docs["text"]).alias("text"))))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(rebuilt(numbered_turns(table(spark, sf_dir, "conversations"))))


_QUERIES = (op1_url_filter, op2_chat_formatting, op3_toxicity, op4_html_extraction, op5_minhash_near_dedup, op6_benchmark_decontamination, op7_suffix_array_dedup, op8_spotsigs_fingerprints, op9_language_id, op10_mix_to_weights, op11_periodic_runs, op12_nearest_neighbours, op13_prefix_trie)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in _QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_url_filter": URL_SQL,
        "op5_minhash_near_dedup": NEAR_SQL,
        "op6_benchmark_decontamination": DECONTAMINATION_SQL,
        "op7_suffix_array_dedup": REPEATS_SQL,
        "op10_mix_to_weights": MIXING_SQL,
        "op11_periodic_runs": RUNS_SQL,
        "op13_prefix_trie": TRIE_SQL,
    }
