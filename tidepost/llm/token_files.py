"""Token ids in bit-packed files: every id in the fewest bits that the vocabulary needs.

A file (a shard) holds whole documents in ascending `doc_id` order:

    header   magic "TPID", bits, documents, tokens, tokens per block, blocks
    tables   doc_id, "doc_id is null", first token of each document and the end, first byte of each block and the end
    payload  blocks of packed ids; each block begins at a byte, its first id in the lowest bits

A block is unpacked by numpy on its own, so any range of tokens costs the tables and the
blocks it touches.  The files of one data set are listed in a manifest, a Spark table, with
the number of tokens before each file.  Only files of committed task attempts are listed:
what a lost or repeated attempt leaves behind is never read.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidepost.llm.common import in_batches, open_store, spread_rows, text_or_empty
from tidepost.llm.word_ids import word_ids

MAGIC = b"TPID"
HEADER = "<4sIQQII"
BLOCK_TOKENS = 1 << 14
SHARD_TOKENS = 1 << 21
MANIFEST = "part int, seq int, file string, n_docs long, n_tokens long"


# --- packing ----------------------------------------------------------------

def bits_for(vocabulary_size: int) -> int:
    """The fewest bits that tell `vocabulary_size` ids apart; at least 1."""
    return max(1, int(vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids one after the other in `bits` bits each, lowest bit first, filled up to a byte."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(planes.astype(np.uint8), bitorder="little").tobytes()


def unpack(data, count: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype("<u4")
    planes = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little")
    return (planes.reshape(count, bits).astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(1, dtype=np.uint32).astype("<u4")


def shard_bytes(doc_ids: list, ends: list[int], ids: np.ndarray, bits: int, block: int = BLOCK_TOKENS) -> bytes:
    """A whole file; `ends` are the documents' last tokens plus 1."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    blocks = [pack(ids[at : at + block], bits) for at in range(0, len(ids), block)]
    return b"".join([
        struct.pack(HEADER, MAGIC, bits, len(doc_ids), len(ids), block, len(blocks)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(),
        np.array([0, *ends], "<u8").tobytes(),
        np.cumsum([0, *map(len, blocks)]).astype("<u8").tobytes(),
        *blocks,
    ])


class Shard:
    """Random access to one file: `tokens(a, b)` reads the blocks between two tokens only."""

    def __init__(self, source):
        self.source = source
        magic, self.bits, self.n_docs, self.n_tokens, self.block, n_blocks = struct.unpack(HEADER, self._read(0, struct.calcsize(HEADER)))
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = struct.calcsize(HEADER)
        sizes = (8 * self.n_docs, self.n_docs, 8 * (self.n_docs + 1), 8 * (n_blocks + 1))
        table = self._read(at, sum(sizes))
        ids, null, starts, offsets = (table[sum(sizes[:i]) : sum(sizes[: i + 1])] for i in range(4))
        self.doc_ids = [None if n else d for d, n in zip(np.frombuffer(ids, "<i8").tolist(), null)]
        self.starts, self.offsets = np.frombuffer(starts, "<u8").astype(np.int64), np.frombuffer(offsets, "<u8").astype(np.int64)
        self.payload = at + sum(sizes)

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def tokens(self, first: int, end: int) -> np.ndarray:
        if end <= first:
            return np.zeros(0, "<u4")
        a, b = first // self.block, (end - 1) // self.block + 1
        data = memoryview(self._read(self.payload + int(self.offsets[a]), int(self.offsets[b] - self.offsets[a])))
        out = [
            unpack(data[self.offsets[i] - self.offsets[a] : self.offsets[i + 1] - self.offsets[a]], min(self.block, self.n_tokens - i * self.block), self.bits)
            for i in range(a, b)
        ]
        return np.concatenate(out)[first - a * self.block : end - a * self.block]

    def document(self, index: int) -> np.ndarray:
        return self.tokens(int(self.starts[index]), int(self.starts[index + 1]))


# --- encoding ---------------------------------------------------------------

def write_token_files(docs: DataFrame, folder: str, vocabulary: str, vocabulary_size: int, end_id: int, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode `text` and write the files below `folder`; returns the stored manifest.

    Order: ascending doc_id (null first), equal ids by text, so repeated rows stay as
    many rows.  A null text counts as empty and leaves the end id alone; an empty table
    leaves an empty manifest.  Other columns are ignored.  One shuffle, of the texts by
    ranges of doc_id; each task streams its range into files of about `shard_tokens`
    tokens (one document is never cut).  `vocabulary` must be a tokenizer whose
    pre-tokens never span white space and that drops it.
    """
    bits = bits_for(vocabulary_size)
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(vocabulary, byte_level=False)
        store, base = open_store(folder)
        part = TaskContext.get().partitionId()
        schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])
        seq, doc_ids, ends, parts, held = 0, [], [], [], 0

        def flush():
            nonlocal seq, held
            name = f"{part:06d}-{seq:05d}-{uuid.uuid4().hex}.ids"
            with store.open_output_stream(f"{base}/{name}") as out:
                out.write(shard_bytes(doc_ids, ends, np.frombuffer(b"".join(parts), "<u4"), bits))
            row = pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "file": name, "n_docs": len(doc_ids), "n_tokens": held}], schema)
            seq, held = seq + 1, 0
            for kept in (doc_ids, ends, parts):
                kept.clear()
            return row

        store.create_dir(base, recursive=True)
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1))):
                held += len(ids) + 1
                doc_ids.append(doc_id)
                ends.append(held)
                parts += ids.tobytes(), end
                if held >= shard_tokens:
                    yield flush()
        if doc_ids:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    ranged = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    path = f"{folder}/manifest"
    ranged.mapInArrow(encode, MANIFEST).write.parquet(path)
    return docs.sparkSession.read.schema(MANIFEST).parquet(path)


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with `start`: tokens in all files before.

    Totals per writing task are summed up first (one row per task), then the files
    within each task: no window holds all files.
    """
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    totals = manifest.groupBy("part").agg(F.sum("n_tokens").alias("_tokens"))
    firsts = totals.select("part", F.coalesce(F.sum("_tokens").over(before.orderBy("part")), F.lit(0)).alias("_first"))
    within = F.coalesce(F.sum("n_tokens").over(before.partitionBy("part").orderBy("seq")), F.lit(0))
    return manifest.withColumn("_within", within).join(firsts, "part").select(
        *manifest.columns, (F.col("_first") + F.col("_within")).alias("start")
    )


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of a data set: doc_id, start, n_tokens, ids (binary, little-endian unsigned 32-bit).

    `start` counts the ids of all documents before.  A task reads its files one by one,
    and a run of documents at a time.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    listed = with_starts(manifest).select("file", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

        def rows():
            for batch in batches:
                for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    with store.open_input_file(f"{base}/{file}") as source:
                        shard = Shard(source)
                        for at in range(0, shard.n_docs, 128):
                            to = min(at + 128, shard.n_docs)
                            ids = shard.tokens(int(shard.starts[at]), int(shard.starts[to]))
                            for i in range(at, to):
                                a, b = (int(shard.starts[j] - shard.starts[at]) for j in (i, i + 1))
                                yield shard.doc_ids[i], start + int(shard.starts[i]), b - a, ids[a:b].tobytes()

        yield from in_batches(rows(), schema, lambda row: len(row[3]))

    return spread_rows(listed, manifest.count()).mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
