"""From raw documents to packed training sequences: five stages, each one operator of ``tidemark.llm``.

Every stage works on all rows its predecessor kept and, but for the last, returns the columns of
the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact, jaccard, language, mixing, packing
from tidemark.llm.shared import unused, written

#: Near-duplicate components and token packing have no SQL form; tests use brute force.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told. Null texts and texts without a letter go."""
    model = language.train(language.training_rows(docs), public_tokenizers.path("piece_bpe_32k.model"))
    lang, score = unused(docs.columns, "lang_pred"), unused(docs.columns, "score")
    found = language.identify(docs, model)
    # with no labelled row at all nothing can be told apart, so nothing is rejected
    return found.where(F.col(lang) != language.UNDETERMINED).drop(lang, score) if model.languages else docs


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of texts that are equal without white space."""
    return exact.drop_copies(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by similar shingles."""
    return jaccard.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; at most one a source is cut at its quota."""
    names = docs.columns
    draws, size = unused(names, "draws"), unused(names, "size")
    return mixing.drawn(mixing.mix(docs), names, draws=draws, size=size)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language ID", known_language),
    ("exact dedup", one_of_each),
    ("near-duplicate join", no_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        rows = written(stage(spark, rows, sf_dir), name.replace(" ", "-"))
    return rows
