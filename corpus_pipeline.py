"""A corpus from raw documents: five stages, each written as Parquet and read by the next.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``.
All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm import bpe, contamination, language_id, lines, minhash
from tillwork.llm.queries import RANKS
from tillwork.llm.registry import query, table, tuned
from tillwork.session import scratch_path

#: Trigram models, registers, set joins and merges by rank are no SQL; the tests hold the rows against a plain version.
ORACLE_SQL = None


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; the model is fitted on a bounded sample of their labels."""
    tuned(spark)
    return language_id.in_known_language(docs, language_id.fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat earlier ones; documents that lose every word go."""
    tuned(spark)
    out = lines.without_repeated_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that is of texts that are 80 % alike."""
    tuned(spark)
    return minhash.without_copies(docs, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without words of a benchmark window."""
    return contamination.without_items(docs, table(tuned(spark), sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their texts, and whether decoding gives the text back."""
    tuned(spark)
    where = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    out = bpe.transcode(docs, *where, kept=100_000)  # the workers of the other stages need the memory
    same = F.coalesce(F.col("decoded").cast("string"), F.lit("")) == F.coalesce("text", F.lit(""))
    return out.withColumn("round_trip", same).drop("decoded")


STAGES = [
    ("language_id", known_languages),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("tokenize", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


query("pipeline", ORACLE_SQL)(run)
