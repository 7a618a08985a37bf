"""Plan-time and data-time guards shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Raise while the plan is built if a column of an earlier stage is missing."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; available: {df.columns}")
    return df


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Raise if `df` has no row; reads at most one row."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def collect_bounded(df: DataFrame, limit: int, what: str) -> list:
    """Collect a result that must be small, and refuse one that is not."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} {what}")
    return rows
