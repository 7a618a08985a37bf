"""Token lists dealt to blocks, each block met once with what it needs of a table of words.

A join of single tokens with a table of words sends a line for every token, with the word's
vector on it, through a shuffle.  Here rows are dealt to blocks of about a given number of
places; a block's distinct words (few beside its places) fetch their lines of the table by a
join, and one task works on the block and its lines in numpy.  The number of blocks grows with
the input, the size of a block does not.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidepost.session import materialize


def token_blocks(df: DataFrame, tokens: str, places: int, *keep: Column) -> DataFrame:
    """(_block, kept columns, _tokens), stored: the rows dealt to blocks of about `places` tokens.

    Dealt by the hash of a stored row number, so rows with equal keys or texts spread.
    """
    rows = df.select(F.monotonically_increasing_id().alias("_row"), *keep, F.col(tokens).alias("_tokens"))
    stored = materialize(rows, "token-rows")
    total = stored.agg(F.sum(F.greatest(F.size("_tokens"), F.lit(0)).cast("long") + 1)).first()[0] or 0
    blocks = max(1, -(-total // places))
    return stored.withColumn("_block", F.pmod(F.xxhash64("_row"), F.lit(blocks)).cast("int")).drop("_row")


def block_words(blocks: DataFrame) -> DataFrame:
    """(_block, word, n): the distinct words of each block and their places there."""
    words = blocks.select("_block", F.explode("_tokens").alias("word")).where(F.col("word").isNotNull())
    return words.groupBy("_block", "word").agg(F.count(F.lit(1)).alias("n"))


def per_block(blocks: DataFrame, lines: DataFrame, work, schema: str) -> DataFrame:
    """`work(rows, lines)` of each block's rows and the lines of its words, as Arrow tables."""
    # Under a name of its own: both sides stem from the same stored rows.
    lines = lines.select(F.col("_block").alias("_of"), *[c for c in lines.columns if c != "_block"])
    return blocks.groupBy("_block").cogroup(lines.groupBy("_of")).applyInArrow(work, schema)


def places_of(rows: pa.Table, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Of each place: the number of its row, and the place of its word in `words` (-1 where absent)."""
    lists = rows.column("_tokens").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    row = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    encoded = pc.list_flatten(lists).dictionary_encode()
    known = pd.Index(words, dtype=object).get_indexer(pd.Index(encoded.dictionary.to_pylist(), dtype=object))
    code = pc.fill_null(encoded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    return row, np.append(known, -1)[code].astype(np.int64)


def neighbours(row: np.ndarray, code: np.ndarray, window: int):
    """Codes of the two words of each pair of places at most `window` apart in one row, left and right."""
    for d in range(1, window + 1):
        paired = (row[d:] == row[:-d]) & (code[d:] >= 0) & (code[:-d] >= 0)
        yield code[:-d][paired], code[d:][paired]


def pack(*columns: np.ndarray) -> bytes:
    """Whole-number columns of one length as bytes: differences, low bytes together, compressed."""
    planes = []
    for column in columns:
        step = np.diff(column.astype(np.int64), prepend=0)
        planes.append(((step << 1) ^ (step >> 63)).view(np.uint8).reshape(-1, 8).T.tobytes())
    return zlib.compress(b"".join(planes), 1)


def unpack(packed: bytes, columns: int) -> list[np.ndarray]:
    """The columns that `pack` was given."""
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(columns, 8, -1)
    zigzag = [np.ascontiguousarray(p.T).view(np.int64).reshape(-1) for p in planes]
    return [np.cumsum((z >> 1) & 0x7FFFFFFFFFFFFFFF ^ -(z & 1)) for z in zigzag]


def row_sums(row: np.ndarray, code: np.ndarray, rows: int, table: np.ndarray, at_once: int = 1 << 22) -> np.ndarray:
    """Per row the sum of the table's lines of its places; `row` ascends."""
    out = np.zeros((rows, table.shape[1]))
    row, code = row[code >= 0], code[code >= 0]
    step = max(1, at_once // max(1, table.shape[1]))
    for at in range(0, len(row), step):
        mine = row[at:at + step]
        first = np.flatnonzero(np.diff(mine, prepend=-1))
        out[mine[first]] += np.add.reduceat(table[code[at:at + step]], first, axis=0)
    return out


def list_column(values: np.ndarray) -> pa.Array:
    """A matrix as one list of doubles per line."""
    lines, size = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(lines + 1, dtype=np.int32) * size), pa.array(values.reshape(-1).astype(np.float64)))
