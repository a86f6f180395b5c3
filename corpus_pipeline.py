"""The corpus pipeline: language ID, line dedup, near-duplicate removal, mixing, packing.

``STAGES`` are (name, function) in order. A function takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents. Each stage reads what the one before it wrote.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.llm import language, lines, mixing, near_duplicates, packing
from terroir.llm.common import table
from terroir.session import materialize


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: no ``und`` and no ambiguous ones. Learns from the labelled rows of ``docs``."""
    # Only what three languages or more could be goes; a text in two languages stays.
    return language.known_language(docs, language.fit(language.learnable(docs)), ambiguous_below=0.4)


def _measured(docs: DataFrame) -> DataFrame:
    """n_chars follows the text where a stage has changed it."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(lines.drop_repeated_lines(docs))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.drop_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(mixing.mix(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identified),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_duplicates),
    ("mixing", mixed),
    ("packing", packed),
]

# Language ID and packing cannot be said in SQL; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each is written to the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
