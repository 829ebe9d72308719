"""The operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stageline.llm.conversation_trie import prefix_trie
from stageline.llm.decontaminate import contamination
from stageline.llm.exact_dedup import exact_dedup
from stageline.llm.licenses import license_spans
from stageline.llm.ngram_join import jaccard_classes
from stageline.llm.oracle import quality_rules_sql, search_sql, trie_sql
from stageline.llm.packing import pack_documents
from stageline.llm.pages import main_text
from stageline.llm.pii import personal_data
from stageline.llm.quality import quality_scores
from stageline.llm.quality_rules import judge
from stageline.llm.search import search
from stageline.llm.suffix_dedup import suffix_dedup
from stageline.llm.token_counts import token_counts


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_read(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(_read(spark, sf_dir, "documents")).drop("set_id")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_spans(_read(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_read(spark, sf_dir, "documents"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_read(spark, sf_dir, "pages"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(_read(spark, sf_dir, "documents")).drop("found")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_read(spark, sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(_read(spark, sf_dir, "conversations"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(_read(spark, sf_dir, "documents"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *counts, "base_failed", F.array_join("failed", "; ").alias("failed"), "kept")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_exact_dedup, op3_quality, op4_ngram_join, op5_license_scan,
        op6_token_counts, op7_main_text, op8_decontamination, op9_personal_data, op10_packing,
        op11_conversation_trie, op12_quality_rules, op13_lexical_search,
    )
}

ORACLE: dict[str, str] = {
    "op2_exact_dedup": r"""
        with t as (
            select doc_id, length(coalesce(text, '')) as points,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as body
            from documents
        )
        select doc_id,
               first_value(doc_id) over (partition by body order by points desc, doc_id) as keep_id,
               count(*) over (partition by body) as group_size,
               doc_id = first_value(doc_id) over (partition by body order by points desc, doc_id) as kept,
               sha256(body) as text_sha256
        from t
    """,
    "op11_conversation_trie": trie_sql(),
    "op12_quality_rules": quality_rules_sql(),
    "op13_lexical_search": search_sql(),
}
