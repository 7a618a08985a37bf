"""Sums of vectors and of their outer products, as tree-shaped aggregations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

# Partial sums of this many groups of partitions are merged in the last step.
_FAN_IN = 128


def vector_sum(vector: Column, weight: Column | None = None) -> Column:
    """Aggregate: (weighted) sum of array vectors, combined map-side in the JVM."""
    if weight is None:
        return vector_to_array(Summarizer.sum(array_to_vector(vector)))
    return vector_to_array(Summarizer.sum(array_to_vector(vector), weight))


def total_vector(df: DataFrame, vector: str) -> DataFrame:
    """One row (total, rows): the sum of all vectors and their number.

    Two levels, so that the last task merges a fixed number of partial sums
    however many partitions there are.
    """
    partial = (
        df.filter(F.col(vector).isNotNull())
        .groupBy(F.pmod(F.spark_partition_id(), F.lit(_FAN_IN)).alias("_branch"))
        .agg(vector_sum(F.col(vector)).alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    )
    return partial.agg(vector_sum(F.col("_sum")).alias("total"), F.sum("_rows").alias("rows"))


def _partial_gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        column = batch.column(0)
        if len(column) == 0:
            continue
        block = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
        gram = block.T @ block
        total = gram if total is None else total + gram
    if total is not None:
        size = total.shape[0]
        offsets = pa.array(np.arange(0, size * size + 1, size, dtype=np.int32))
        yield pa.record_batch(
            {
                "i": pa.array(np.arange(size, dtype=np.int32)),
                "gram_row": pa.ListArray.from_arrays(offsets, pa.array(total.reshape(-1))),
            }
        )


def gram_matrix(df: DataFrame, vector: str) -> DataFrame:
    """Rows (i, gram_row) of the sum of outer products of double vectors.

    Each task adds up one d x d matrix; the rows of these are summed by index,
    so the work after the scan depends on d and the number of tasks only.
    """
    partial = (
        df.filter(F.col(vector).isNotNull()).select(vector)
        .mapInArrow(_partial_gram, "i int, gram_row array<double>")
    )
    return partial.groupBy("i").agg(vector_sum(F.col("gram_row")).alias("gram_row"))
