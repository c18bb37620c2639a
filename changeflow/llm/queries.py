"""The operators on their tables, with production parameters; results as their contracts ask."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm import ann, chat, embed_dedup, filter_audit, html_main, language, licenses, mixing, packing, perplexity, simhash, toxicity, variants
from changeflow.llm.common import held_out, table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    named = language.identify(docs.select("doc_id", "text"), language.fit(docs))
    return named.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        toxicity.is_toxic(F.col("score")).alias("predicted"),
    )


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(table(spark, sf_dir, "pages"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("copies")).cast("long").alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("filter")


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = perplexity.quality_rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *perplexity.STATS, "base_failed", "kept")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_nearest_neighbours": op2_nearest_neighbours,
    "op3_language_id": op3_language_id,
    "op4_license_scan": op4_license_scan,
    "op5_toxicity": op5_toxicity,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_html_extraction": op7_html_extraction,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_mixing": op9_mixing,
    "op10_embedding_near_dedup": op10_embedding_near_dedup,
    "op11_filter_interactions": op11_filter_interactions,
    "op12_quality_rules": op12_quality_rules,
    "op13_spelling_variants": op13_spelling_variants,
    "pipeline": corpus_pipeline.run,
}
ORACLE_SQL: dict[str, str] = {
    "op4_license_scan": licenses.scan_sql(),
    "op11_filter_interactions": filter_audit.audit_sql(),
}
