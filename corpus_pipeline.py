"""From raw documents to packed training sequences, in five stages.

Each stage gets the documents that its predecessor kept, read back from Parquet, and returns those it
keeps, with the same columns; the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from linkharbor.llm import content_dedup, decontaminate, language, near_dedup, packing
from linkharbor.llm.common import staged

# A language is believed from this score on; with the four of the corpus, 0.25 would be a guess.
LEAST_SCORE = 0.4
VOCABULARY, END_ID = "word_bpe_49k.json", 2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts whose language is not recognised."""
    model = language.learn(language.training_rows(docs))
    return language.keep_identified(docs, model, LEAST_SCORE)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return content_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the one with the smallest id stays."""
    return near_dedup.drop_near_copies(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that hold an item of the benchmark."""
    return decontaminate.drop_leaked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents left, with their sequence and offset."""
    return packing.pack(docs, public_tokenizers.path(VOCABULARY), END_ID)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

# A learned language model and verified near copies are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
