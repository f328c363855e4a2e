"""The operators as queries over the whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from parcelrisk.llm import blocked_search
from parcelrisk.llm.bpe import bpe_round_trip
from parcelrisk.llm.common import read_table
from parcelrisk.llm.fingerprints import fingerprint_documents
from parcelrisk.llm.jaccard_join import jaccard_components
from parcelrisk.llm.langid import language_of_documents
from parcelrisk.llm.licenses import scan_licenses
from parcelrisk.llm.lm_automaton import score_corpus
from parcelrisk.llm.packing import pack_documents
from parcelrisk.llm.periodic import runs_of_documents
from parcelrisk.llm.quality_llr import quality_of_documents
from parcelrisk.llm.substring_dedup import remove_repeats
from parcelrisk.llm.template_extract import extract_main_text
from parcelrisk.llm.toxicity import toxicity_of_documents


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_of_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_of_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_of_documents(read_table(spark, sf_dir, "documents"))


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read_table(spark, sf_dir, "pages"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_corpus(read_table(spark, sf_dir, "documents"))


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(read_table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocked_search.ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs_of_documents(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_best_fit_packing, op3_toxicity, op4_language_id, op5_bpe_round_trip,
    op6_suffix_array_dedup, op7_ngram_jaccard_join, op8_html_extraction, op9_lm_scoring, op10_document_fingerprints,
    op11_ranked_search, op12_license_scans, op13_periodic_runs)}
ORACLE = {"op11_ranked_search": blocked_search.ORACLE_SQL}
