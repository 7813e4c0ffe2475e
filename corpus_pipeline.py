"""From raw documents to packed training sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and works on all its predecessor kept,
written as Parquet and read again. All but the last return the columns of the documents, whatever they are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from monthclose.llm import exact_dedup, language, mixing, packing, simhash
from monthclose.llm.common import remove_folder, shared_folder, ship_package, table

#: A text whose most likely language is less likely than this is rejected, besides those without any letter.
LEAST_LANGUAGE_SCORE = 0.3


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, or of no language the model knows, go. A null text goes too."""
    ship_package(spark)
    return language.of_known_language(docs, language.train(language.trainable(docs)), LEAST_LANGUAGE_SCORE)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts alike but for white space the longest stays, of those the smallest id."""
    ship_package(spark)
    return exact_dedup.dedup_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near fingerprints stays, the one of smallest id."""
    ship_package(spark)
    return simhash.one_of_each(docs, simhash.WORDS, simhash.RADIUS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once or twice."""
    ship_package(spark)
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its sequence and place there."""
    ship_package(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language", identify_languages),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("pack", pack),
]

#: Language scores, components of near copies and packing can't be said in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the documents of ``sf_dir``. What a stage keeps is written to the shared
    checkpoint folder, and removed once the next one's is there; the last one's stays, for the rows are read from it."""
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4()}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove_folder(spark, f"{folder}/{before}")
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
