"""What several of the operators share: worker state, shared files, text batches."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, functions as F

# Rows of an output batch are handed to Spark once they hold so many bytes.
BATCH_BYTES = 8 << 20


def worker_memo(key: tuple, build: Callable[[], object]) -> object:
    """`build()`, done once per Python worker and kept for its later tasks.

    The functions of this package travel by value, so their globals end with the
    task; a module of its own keeps vocabularies and word caches for longer.
    """
    name = "tidepost_worker_state"
    state = sys.modules.setdefault(name, types.ModuleType(name)).__dict__
    memos = state.setdefault("memos", {})
    if key not in memos:
        # One at a time: what an earlier job of this worker needed makes room.
        memos.clear()
        memos[key] = build()
    return memos[key]


class WordCache(dict):
    """Results by word, held in two generations of at most `limit` entries together.

    When the younger generation is full it becomes the elder and the old elder goes,
    so memory stays bounded and frequent words stay; an evicted word is computed anew.
    """

    def __init__(self, compute: Callable[[list[str]], list], limit: int = 500_000):
        super().__init__()
        self.compute, self.half, self.elder = compute, limit // 2, {}

    def learn(self, words: Iterable[str]) -> None:
        """Make every word of `words` present."""
        self.learn_new(set(words).difference(self))

    def learn_new(self, words: Iterable[str]) -> None:
        """The same for words without repetition."""
        missing = []
        for word in words:
            if word not in self:
                known = self.elder.get(word)
                if known is None:
                    missing.append(word)
                else:
                    self[word] = known
        if missing:
            self.update(zip(missing, self.compute(missing)))

    def age(self) -> None:
        """To be called between texts: forget the elder generation when the younger is full."""
        if len(self) > self.half:
            self.elder = dict(self)
            self.clear()


# White space of either kind a pattern may mean: Unicode's property, and U+001C to U+001F that Python adds.
_SPACE = "\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_TWO_SPACES = re.compile(f"[{_SPACE}]{{2}}").search
_CHUNKS = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+").findall
_UNSURE = re.compile("[\x1c-\x1f]").search


def space_chunks(text: str) -> list[str] | None:
    """A text cut before each white space that follows another character.

    Tokenizers with byte-level pre-tokens never match across such a place, so the
    chunks can be encoded apart.  None if white space is a matter of definition there.
    """
    if _UNSURE(text):
        return None
    if _TWO_SPACES(text):
        return _CHUNKS(text)
    first, *rest = text.split(" ")
    return [first, *[" " + part for part in rest]] if first else [" " + part for part in rest]


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it prints, else the next one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)]


def by_size(texts: list[str], most: int = 4_000_000) -> Iterator[list[str]]:
    """Runs of texts of about `most` characters together, in order."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def with_text_result(docs: DataFrame, name: str, function) -> DataFrame:
    """`row`, each whole row as a struct, and `name`, what `function` makes of its text.

    Columns of the input can have any name: they meet those of an operator inside the struct only.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("row"), function(text_or_empty()).alias(name))


def per_text(schema: str, work: Callable[[list[str]], Iterable[tuple]], rows: int = 1024):
    """A column function: `work` maps a list of texts to as many tuples of `schema`.

    It counts as non-deterministic so that Spark evaluates it once, before any filter on
    its result; the row's other columns never leave the JVM.
    """
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for at in range(0, len(texts), rows):
                out.extend(work(texts.iloc[at : at + rows].tolist()))
            yield pd.DataFrame(out, columns=names)

    return F.pandas_udf(run, schema).asNondeterministic()


def in_batches(rows: Iterable[tuple], schema: pa.Schema, weigh: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of about BATCH_BYTES bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + weigh(row)
        if size >= BATCH_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema
    )


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI (`file:/a` as Hadoop writes it, too) or of a plain path."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def spread_rows(df: DataFrame, rows: int, most: int = 10_000) -> DataFrame:
    """One partition for each of a small table's costly rows, up to `most` partitions."""
    return df.repartition(max(1, min(rows, most)))
