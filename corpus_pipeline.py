"""The corpus pipeline: quality rules, language, near-duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before has kept; all but
the last return the columns of `documents`.  `run` writes every stage's result to the shared
folder as Parquet and reads it back for the next one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidepost.llm import fertility, language, queries, secret_scan, simhash
from tidepost.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fertility bands."""
    return fertility.kept_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return language.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group."""
    return simhash.one_of_each(docs, width=3, distance=2, seed=42)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; what the scan finds is replaced, and n_chars follows the text."""
    return secret_scan.redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in a sequence of at most 2048 tokens."""
    return queries.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("language ID", languages),
    ("SimHash near-dedup", near_duplicates),
    ("secret scan", secrets),
    ("packing", packing),
]

# Vocabularies, trained models and decoding cannot be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
