"""The registered query of each operator, and its DuckDB SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from finlake.llm import (
    op1_suffix_dedup,
    op2_exact_dedup,
    op3_token_counts,
    op4_packing,
    op5_ngram_join,
    op6_chunk_dedup,
    op7_mixing,
    op8_quality_classifier,
    op9_quality_rules,
    op10_url_filter,
    op11_periodic_runs,
    op12_fill_in_middle,
    op13_language_id,
)
from finlake.llm.common import table


def op1_suffix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


def op2_exact_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op3_token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_token_counts.token_counts(table(spark, sf_dir, "documents"))


def op4_packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_packing.pack_documents(table(spark, sf_dir, "documents"))


def op5_ngram_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_ngram_join.near_groups(table(spark, sf_dir, "documents"), n=3, percent=90)


def op6_chunk_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_chunk_dedup.chunk_dedup(table(spark, sf_dir, "documents"))


def op7_mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_mixing.mix_rows(table(spark, sf_dir, "documents"))


def op8_quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    return op8_quality_classifier.quality_scores(docs, labels)


def op9_rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op9_quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *op9_quality_rules.COUNTS, "base_failed", "kept")


def op10_url_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_url_filter.filter_pages(table(spark, sf_dir, "pages"))


def op11_runs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = op11_periodic_runs.with_planted_periods(table(spark, sf_dir, "documents"))
    return op11_periodic_runs.run_digests(op11_periodic_runs.periodic_runs(docs))


def op12_fim_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_fill_in_middle.fim_digests(table(spark, sf_dir, "documents"))


def op13_language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_language_id.predicted_languages(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_dedup": op1_suffix_query,
        "op2_exact_dedup": op2_exact_query,
        "op3_token_counts": op3_token_counts_query,
        "op4_best_fit_packing": op4_packing_query,
        "op5_ngram_jaccard": op5_ngram_query,
        "op6_chunk_dedup": op6_chunk_query,
        "op7_mixing": op7_mixing_query,
        "op8_quality_classifier": op8_quality_query,
        "op9_quality_rules": op9_rules_query,
        "op10_url_filter": op10_url_query,
        "op11_periodic_runs": op11_runs_query,
        "op12_fill_in_middle": op12_fim_query,
        "op13_language_id": op13_language_query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_suffix_dedup": op1_suffix_dedup.SQL,
        "op2_exact_dedup": op2_exact_dedup.SQL,
        "op5_ngram_jaccard": op5_ngram_join.SQL,
        "op9_quality_rules": op9_quality_rules.SQL,
        "op10_url_filter": op10_url_filter.SQL,
        "op12_fill_in_middle": op12_fill_in_middle.SQL,
    }
