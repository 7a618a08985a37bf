"""Readers for the vector and token cells of a stage export."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidepost.checks import require_columns
from tidepost.functions.vectors import parse_tokens, parse_vector


def parse_vectors(df: DataFrame, text_col: str, out: str = "vector") -> DataFrame:
    """Add the parsed float vector; null where the cell is absent or malformed."""
    return require_columns(df, text_col).withColumn(out, parse_vector(F.col(text_col)))


def parse_token_lists(df: DataFrame, text_col: str, out: str = "tokens") -> DataFrame:
    return require_columns(df, text_col).withColumn(out, parse_tokens(F.col(text_col)))


def valid_vectors(df: DataFrame, vector: str = "vector") -> DataFrame:
    """Rows whose vector could be parsed."""
    return require_columns(df, vector).filter(F.col(vector).isNotNull())
