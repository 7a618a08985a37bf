"""Dense row numbers and first positions without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidepost import schemas
from tidepost.checks import require_columns
from tidepost.session import materialize

# monotonically_increasing_id keeps the partition above bit 33.
_PARTITION_SHIFT = 33
_POSITION_MASK = (1 << _PARTITION_SHIFT) - 1


def assign_row_ids(df: DataFrame, *order: str, name: str = "row_id") -> DataFrame:
    """Number the rows 1..n in the given order.

    The rows are range-partitioned and sorted, each keeps its place in its
    partition, and only the partition sizes are summed up globally: one row
    per partition.  The placed rows are written once so that a lost executor
    cannot change the numbering.
    """
    require_columns(df, *order)
    # A digest as the last column spreads the rows of one frequent order key over several ranges.
    digest = F.xxhash64(*[c for c, kind in df.dtypes if "map<" not in kind])
    ranged = df.withColumn("_tie", digest).repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    placed = materialize(ranged.withColumn("_slot", F.monotonically_increasing_id()), "row-ids")
    placed = placed.withColumn("_part", F.shiftright("_slot", _PARTITION_SHIFT))

    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))

    position = F.col("_slot").bitwiseAND(F.lit(_POSITION_MASK))
    # One row per partition of the placed table: small whatever the data size.
    return placed.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + position + 1).alias(name), *df.columns
    )


def migrate_add_row_id(legacy: DataFrame, *order: str) -> DataFrame:
    """A legacy post table with a surrogate key and the fixed columns."""
    require_columns(legacy, *schemas.POST_COLUMNS)
    if "row_id" in legacy.columns:
        return legacy.select("row_id", *schemas.POST_COLUMNS)
    keep = [*schemas.POST_COLUMNS, *[c for c in order if c not in schemas.POST_COLUMNS]]
    return assign_row_ids(legacy.select(*keep), *order).select("row_id", *schemas.POST_COLUMNS)


def short_ids(df: DataFrame, sentence: str, position: str, out: str = "sid") -> DataFrame:
    """`S` and the first position at which the row's sentence occurs; null for a null sentence.

    Digests stand for the sentences in both shuffles; minima are combined before theirs,
    and adaptive execution splits the rows of a frequent sentence in the join.
    """
    require_columns(df, sentence, position)
    digest = F.sha2(F.col(sentence).cast("string"), 256).alias("_digest")
    first = df.select(digest, position).groupBy("_digest").agg(F.min(position).alias("_first"))
    return df.select("*", digest).join(first, "_digest", "left").select(
        *df.columns, F.concat(F.lit("S"), F.col("_first").cast("string")).alias(out)
    )
