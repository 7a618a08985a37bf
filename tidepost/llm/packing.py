"""Packing into windows by minimum bin slack.

Documents are cut into whole windows and one rest each.  What is left to decide is a
multiset of lengths below the window size, so a histogram of at most `window` counts
describes a corpus of any size.  Again and again the longest length that is left opens a
window, and a subset-sum over the others, one bit per reachable fill, finds the multiset
that comes closest to the capacity.  Going back through the reachable sets gives how often
each length takes part, and the window is used as many times as the counts allow.  Each
row then looks up its place by its number among the rows of its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidepost.llm.common import in_batches, text_or_empty
from tidepost.llm.word_ids import word_ids
from tidepost.session import scratch_path

WINDOW = 2048
_PIECES = "part int, slot long, doc_id long, start long, length int, doc_tokens long, ids binary"


# --- encoding and cutting ---------------------------------------------------

def cut_documents(docs: DataFrame, vocabulary: str, end_id: int, window: int = WINDOW) -> DataFrame:
    """Stored pieces of at most `window` tokens with their ids (little-endian unsigned 32-bit).

    Each text, null as empty, is encoded and ends with `end_id`; whole windows come first,
    then the rest.  `slot` numbers the pieces of one length within the task `part` that
    made them.  The pieces are written once to the shared folder, so these numbers hold
    whatever executor reads them.  An empty table gives no piece.
    """
    end = np.array([end_id], "<u4").tobytes()
    schema = pa.schema([
        ("part", pa.int32()), ("slot", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()),
        ("length", pa.int32()), ("doc_tokens", pa.int64()), ("ids", pa.binary()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(vocabulary, byte_level=True)
        part, slots = TaskContext.get().partitionId(), [0] * (window + 1)

        def rows():
            for batch in batches:
                for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1))):
                    ids = ids.tobytes() + end
                    for start in range(0, len(ids), 4 * window):
                        piece = ids[start : start + 4 * window]
                        length = len(piece) // 4
                        yield part, slots[length], doc_id, start // 4, length, len(ids) // 4, piece
                        slots[length] += 1

        yield from in_batches(rows(), schema, lambda row: len(row[6]))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    path = scratch_path(docs.sparkSession, "pieces")
    rows.mapInArrow(cut, _PIECES).write.parquet(path)
    return docs.sparkSession.read.schema(_PIECES).parquet(path)


# --- the plan ---------------------------------------------------------------

def closest_fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length to take for a sum as close to `capacity` as can be, never above.

    Bit s of `sums` says that s can be reached.  Long lengths enter first, so that the
    way back takes as few short ones as possible; they are worth more later on.
    """
    sums, steps = 1, []
    mask = (2 << capacity) - 1
    for length in sorted((l for l in counts if l <= capacity and counts[l]), reverse=True):
        left, batch = min(counts[length], capacity // length), 1
        while left:
            take = min(batch, left)
            steps.append((length, take, sums))
            sums |= sums << (take * length) & mask
            left, batch = left - take, batch * 2
        if sums >> capacity:
            break
    fill, used = sums.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> fill & 1:
            used[length] = used.get(length, 0) + take
            fill -= take * length
    return used


def plan_windows(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, dict[int, int]]]:
    """Windows as (how many, lengths of one with their counts); covers the histogram exactly.

    Each step leaves some length with fewer pieces than one window of its kind takes, so
    the number of kinds depends on `window` alone.
    """
    left = {length: n for length, n in histogram.items() if n > 0}
    plan = []
    while left:
        longest = max(left)
        left[longest] -= 1
        kind = closest_fill(left, window - longest)
        left[longest] += 1
        kind[longest] = kind.get(longest, 0) + 1
        times = min(left[length] // n for length, n in kind.items())
        plan.append((times, kind))
        for length, n in kind.items():
            left[length] -= times * n
            if not left[length]:
                del left[length]
    return plan


def places(plan: list[tuple[int, dict[int, int]]]) -> pd.DataFrame:
    """Runs of numbers within a length: first number, pieces per window, first window, offset there."""
    rows, taken, sequence = [], {}, 0
    for times, kind in plan:
        offset = 0
        for length, n in sorted(kind.items(), reverse=True):
            rows.append((length, taken.get(length, 0), n, sequence, offset))
            taken[length] = taken.get(length, 0) + times * n
            offset += n * length
        sequence += times
    return pd.DataFrame(rows, columns=["length", "first", "each", "sequence", "offset"])


def place_pieces(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """`pieces` (with any columns besides part, slot, length) plus sequence_id and offset.

    Only the histogram, at most `window` counts, comes to the driver.  A piece's number in
    its length is its slot plus the pieces of that length in earlier tasks: counts per task
    and length are summed in windows by length and joined back.
    """
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("_n"))
    histogram = {int(r["length"]): int(r["_n"]) for r in counts.groupBy("length").agg(F.sum("_n").alias("_n")).collect()}
    table = places(plan_windows(histogram, window))
    runs = {int(l): tuple(g[c].to_numpy() for c in ("first", "each", "sequence", "offset")) for l, g in table.groupby("length")}

    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for value, at in length.groupby(length, sort=False).groups.items():
            rows = length.index.get_indexer(at)
            first, each, start, shift = runs[value]
            mine = number.to_numpy()[rows]
            run = np.searchsorted(first, mine, "right") - 1
            copy, nth = np.divmod(mine - first[run], each[run])
            sequence[rows] = start[run] + copy
            offset[rows] = shift[run] + nth * value
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = F.pandas_udf(place, "sequence_id long, offset long")
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (
        pieces.join(before, ["part", "length"])
        .withColumn("_place", placed("length", F.col("_before") + F.col("slot")))
        .select(*[c for c in pieces.columns if c not in ("part", "slot")], "_place.sequence_id", "_place.offset")
    )


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, window: int = WINDOW) -> DataFrame:
    """Pieces with their ids, window number (`sequence_id`) and place in it (`offset`).

    Every id of every document lies in one piece.  Repeated rows and null doc_ids are
    packed like any others; null and empty texts consist of the end id.
    """
    return place_pieces(cut_documents(docs, vocabulary, end_id, window), window)
