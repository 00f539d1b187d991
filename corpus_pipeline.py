"""Corpus pipeline: five stages of storelens.llm, one after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet and rereads it as the next stage's docs, so a lost executor never costs more
than the stage at work.  All stages but the last keep the columns of documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm import contamination, language_id, mixing, simhash, substring
from storelens.llm.frames import shared_folder, table

MIN_CONFIDENCE = 0.5


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a probability of MIN_CONFIDENCE or more;
    those without a letter go.  The model learns from the labelled documents."""
    told = language_id.identify(docs, language_id.train(docs))
    known = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_CONFIDENCE)
    return told.where(known).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the smallest doc_id."""
    return simhash.one_of_each(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the windows that repeat; a text of which nothing is left goes."""
    cut = substring.dedup_substrings(docs, keep_space=True)
    left = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    changed = left.withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text")))
    return changed.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("bigint"))
                              .otherwise(F.col("n_chars"))).select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return contamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: the documents it takes, with the words it takes of each (repeats counted)."""
    mixed = mixing.mix(docs)
    return mixed.where("taken > 0").select("doc_id", "source", "size", "source_size", "target", "taken",
                                           (F.col("taken") / F.col("size")).cast("bigint").alias("copies"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", keep_known_language),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
]

# Model, fingerprints and hashed keys: no SQL; tests/llm holds the rows against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents."""
    folder = f"{shared_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
