"""From raw documents to packed training sequences, stage by stage.

Each stage reads what the one before has written. All but the last return the
columns of documents; further columns of the input stay, whatever their names.
An empty table goes through as one. Repeated rows are documents of their own
until near copies are removed.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import language, mixing, near_dups, packing, pii
from tallyspark.llm.common import hold_out, pinned, table
from tallyspark.session import prepare

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _prepared(stage: Stage) -> Stage:
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(prepare(spark), docs, sf_dir)

    return run


@_prepared
def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from those that name theirs.

    Null and empty texts and those without a letter go; a null language teaches
    nothing. Long texts are judged whole.
    """
    learned = language.profiles(docs, ~hold_out(F.col("doc_id"), 3, 1))
    return language.accepted(docs, learned)


@_prepared
def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id, null ids last.

    Texts that are null or without a word are nobody's copies and stay.
    """
    return near_dups.deduplicated(docs)


@_prepared
def under_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms of the same format, under the session's key.

    Null and empty texts stay as they are; ``n_chars`` is that of the new text.
    """
    new = pii.pseudonyms(docs, pii.session_key(spark), spans=None)
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return new


@_prepared
def mixed_by_source(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as much of them, as the mix of sources takes.

    A null source is one of its own. Texts without a word are taken by no mix and go.
    """
    return mixing.mixed_documents(docs)


@_prepared
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences; a null or empty text is its closing id alone."""
    cut = packing.pieces(docs, packing.tokenizer_path(), ["doc_id"])
    narrow = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.place(narrow)


STAGES: list[tuple[str, Stage]] = [
    ("language", in_known_language),
    ("near_duplicates", without_near_duplicates),
    ("pseudonyms", under_pseudonyms),
    ("mixing", mixed_by_source),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of the folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = pinned(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


# MinHash, hashed draws and a tokenizer are beyond SQL; test_tables.py holds each stage against plain Python.
ORACLE_SQL = None
