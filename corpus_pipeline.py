"""A corpus from raw documents to packed training sequences, in five stages.

Each stage takes the session, the documents that the stage before it kept, and the folder of the given
tables; its result is written as Parquet and read again for the next one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthspan.llm import language, ngram_join, packing, pii, quality
from monthspan.llm.queries import quality_model, remainder
from monthspan.llm.shared import saved

# A language is certain enough from this score on; texts in none of the learned languages are below.
LEAST_SCORE = 0.5


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier takes for good ones."""
    return quality.good(docs, quality_model(spark, docs, sf_dir))


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages: those with letters and a certain prediction."""
    model = language.learn(docs, F.coalesce(remainder(5) != 0, F.lit(False)))
    return language.certain(docs, model, LEAST_SCORE)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least doc_id."""
    return ngram_join.one_of_each(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without personal data in their texts."""
    return pii.redact(docs, pii.learn(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of at most 2048 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("language", keep_language),
    ("near_duplicates", keep_one_of_each),
    ("pii", redact),
    ("packing", pack),
]

# No stage can be told in SQL; the tests hold each one against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the given documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
