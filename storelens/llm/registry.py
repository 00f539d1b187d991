"""Queries of the corpus operators, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm import (
    centroids,
    chat,
    contamination,
    fingerprint,
    language_id,
    license_scan,
    mixing,
    simhash,
    site_tree,
    spelling,
    substring,
    toxicity,
    url_filter,
)
from storelens.llm.frames import table
from storelens.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substring.dedup_substrings(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return site_tree.extract(pages).select("page_id", "url", "text", "n_chars")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train_on_fold(docs)
    out = language_id.identify(docs, model)
    return out.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fingerprint.with_edited(docs).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        "near_edited", "near_next")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination.find_items(docs, table(spark, sf_dir, "benchmark")).drop("text")
    return found.select("doc_id", F.explode("items").alias("hit")).select("doc_id", "hit.*")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scan_licenses(docs).drop("text", "license_spans")


def op9_chat_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    talks = chat.conversations(table(spark, sf_dir, "conversations"))
    return chat.format_preferences(chat.reply_pairs(talks))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, keep_text=False).select("doc_id", "fingerprint", "component_id")


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return centroids.cluster_vectors(vectors)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.group_variants(spelling.vocabulary(docs))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = language_id.held_out(F.col("doc_id"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~fold)
    model = toxicity.train(docs.where(~fold), labels)
    out = toxicity.score_toxicity(docs, model)
    return out.select("doc_id", fold.alias("held_out"), "score",
                      (F.col("score") >= toxicity.TOXIC).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_html_extraction": op2_html_extraction,
    "op3_url_filter": op3_url_filter,
    "op4_language_id": op4_language_id,
    "op5_fingerprint": op5_fingerprint,
    "op6_mixing": op6_mixing,
    "op7_decontamination": op7_decontamination,
    "op8_license_scan": op8_license_scan,
    "op9_chat_preferences": op9_chat_preferences,
    "op10_simhash": op10_simhash,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_toxicity": op13_toxicity,
}
