"""Cross-tokenizer alignment: where the tokens of two vocabularies meet, and which ids go together.

Method: exact-text deduplication.  Documents are shuffled by their full text, so that each
distinct text is tokenised and aligned once and carries its multiplicity, the number of rows
that hold it.  A pair of ids (A, B) counts once for each document that links it: its pair
count is the sum of the multiplicities of the distinct texts that link it.  The measures of a
distinct text are joined back to the doc_ids of all its rows by the text's SHA-256.

Aligned texts are stored in blocks of about BLOCK_LINES pairs.  A block holds each of its distinct
pairs once, with the documents of the block that link it, and its texts as places in that list, so
what meets in the corpus-wide sums, and comes back, is a line per block and pair, not per text.

A encodes space+text with a byte-level BPE vocabulary, B the text with a sentencepiece model
(which puts a space in front by itself); both without special tokens, whose strings in a text are
plain text.  A token's bytes: A's entry through the byte-level table, B's piece in UTF-8 with
U+2581 read as space and <0xHH> as the byte HH.  Byte offsets where an A and a B token both end
cut the two sequences into groups; every A and B token whose byte ranges overlap form a link.

Defined results:
- texts that are null or empty, or whose joined A or B bytes are not space+text (a normaliser
  changed the text), have no tokens: zeros, groups '' unhashed, and they link nothing;
- very long texts are encoded whole; the arrays of a text are as long as its tokens;
- rows with equal texts, repeated rows among them, share one alignment and count once each;
- rows with a null key are measured like the others and keep their null key;
- only the key and the text are read from the input, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidepost.llm.common import WordCache, byte_characters, worker_memo
from tidepost.llm.word_ids import WordIds
from tidepost.operators.word_blocks import pack, unpack
from tidepost.session import materialize

# The measures of one text; its pairs and how often it holds each go into its block.
MEASURES = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
BLOCK = f"block long, texts array<struct<digest: binary, {MEASURES.replace(' ', ': ').replace(',:', ',')}, size: int>>, pairs array<long>, counts array<long>, places binary"
FOUND = f"digest binary, {MEASURES}, count_sum long, n_best long"
# Texts aligned at a time, words whose ids a worker keeps, and pairs and texts of a block.
ROWS, CACHED_WORDS, BLOCK_LINES, BLOCK_TEXTS = 256, 100_000, 1 << 21, 1 << 16
_BYTE = re.compile(r"<0x([0-9A-Fa-f]{2})>")


class Aligner:
    """Both tokenizers and the bytes of every id of each, built once per Python worker."""

    def __init__(self, vocabulary_a: str, model_b: str):
        import sentencepiece

        self.a = WordIds(vocabulary_a, byte_level=True)
        self.a.cache = WordCache(self.a._encode_words, CACHED_WORDS)
        to_byte = {c: b for b, c in enumerate(byte_characters())}
        tokenizer = self.a.tokenizer
        bytes_a = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
        for token, i in tokenizer.get_vocab(with_added_tokens=True).items():
            bytes_a[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=model_b)
        self.size_b = self.b.get_piece_size()
        bytes_b = []
        for i in range(self.size_b):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i) and (m := _BYTE.fullmatch(piece)):
                bytes_b.append(bytes([int(m[1], 16)]))
            elif self.b.is_control(i) or self.b.is_unknown(i):
                bytes_b.append(b"")
            else:
                bytes_b.append(piece.replace("▁", " ").encode())
        self.table_a, self.table_b = _table(bytes_a), _table(bytes_b)
        # Decimals of A's ids, then of B's, then the marks `,|;`.
        self.size_a = len(bytes_a)
        self.decimals = _table([str(i).encode() for i in range(self.size_a)] + [str(i).encode() for i in range(self.size_b)] + [b",|;"])
        self.marks = int(self.decimals[1][-1])

    def align(self, text: str, ids_a: np.ndarray, ids_b: list[int]) -> tuple:
        """The measures of one text (see MEASURES), pairs coded as a * size_b + b."""
        target = np.frombuffer((" " + text).encode(), np.uint8)
        a, b = np.asarray(ids_a, dtype=np.int64), np.asarray(ids_b, dtype=np.int64)
        if not text or not len(a) or not len(b):
            return ZERO
        found_a, found_b = _spell(self.table_a, a, len(target)), _spell(self.table_b, b, len(target))
        if found_a is None or found_b is None or not np.array_equal(found_a[0], target) or not np.array_equal(found_b[0], target):
            return ZERO
        (_, starts_a, ends_a), (_, starts_b, ends_b) = found_a, found_b
        at = np.minimum(np.searchsorted(ends_b, ends_a), len(ends_b) - 1)
        common = ends_a[ends_b[at] == ends_a]
        # Tokens before the end of each group, and the group of each token.
        cut_a, cut_b = np.searchsorted(ends_a, common, "right"), np.searchsorted(ends_b, common, "right")
        group_a, group_b = np.searchsorted(common, ends_a, "left"), np.searchsorted(common, ends_b, "left")
        # `a1,a2|b1;a3|b2,b3`: each id and the mark that follows it, at their places in the line.
        place_a = np.arange(len(a)) + np.concatenate([[0], cut_b[:-1]])[group_a]
        place_b = np.arange(len(b)) + cut_a[group_b]
        flat, first, lengths = self.decimals
        starts, sizes = np.empty(2 * (len(a) + len(b)), np.int64), np.empty(2 * (len(a) + len(b)), np.int64)
        starts[2 * place_a], sizes[2 * place_a] = first[a], lengths[a]
        starts[2 * place_b], sizes[2 * place_b] = first[b + self.size_a], lengths[b + self.size_a]
        starts[2 * place_a + 1] = self.marks + np.where(np.arange(1, len(a) + 1) < cut_a[group_a], 0, 1)
        starts[2 * place_b + 1] = self.marks + np.where(np.arange(1, len(b) + 1) < cut_b[group_b], 0, 2)
        sizes[1::2] = 1
        sizes[-1] = 0
        digest = hashlib.sha256(_gather(flat, starts, sizes).tobytes()).hexdigest()
        # The B tokens that overlap A token i: from the first that ends after i starts to the last that starts before i ends.
        low, high = np.searchsorted(ends_b, starts_a, "right"), np.searchsorted(starts_b, ends_a, "left")
        counts = high - low
        total = int(counts.sum())
        codes = np.repeat(a * self.size_b, counts) + b[np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(total)]
        codes.sort()
        first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        occurrences = np.diff(np.append(first, len(codes)))
        return len(a), len(b), len(common), total, digest, codes[first], occurrences.astype(np.int32)

    def run(self, texts: list[str]) -> list[tuple]:
        ids_a = self.a.encode(pa.array([" " + t for t in texts], pa.large_string()))
        ids_b = self.b.encode(texts, num_threads=1)
        return [self.align(t, x, y) for t, x, y in zip(texts, ids_a, ids_b)]


ZERO = (0, 0, 0, 0, "", [], [])


def _table(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of a vocabulary in one buffer, with each id's start and length."""
    lengths = np.array([len(p) for p in pieces], dtype=np.int64)
    return np.frombuffer(b"".join(pieces) or b"\0", np.uint8), np.cumsum(lengths) - lengths, lengths


def _spell(table, ids: np.ndarray, expected: int):
    """The bytes of `ids` laid end to end, and each token's start and end; None if they are not `expected` long."""
    flat, first, lengths = table
    own = lengths[ids]
    ends = np.cumsum(own)
    if ends[-1] != expected:
        return None
    starts = ends - own
    return _gather(flat, first[ids], own), starts, ends


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches flat[start:start + size] laid end to end."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)]


def _block(number: int, texts: list[tuple]) -> pd.DataFrame:
    """One line of BLOCK from (digest, mult, measures..., pairs, occurrences) of its texts."""
    sizes = np.array([len(t[-2]) for t in texts])
    codes = np.concatenate([np.asarray(t[-2], np.int64) for t in texts])
    pairs, place = np.unique(codes, return_inverse=True)
    counts = np.zeros(len(pairs), np.int64)
    np.add.at(counts, place, np.repeat(np.array([t[1] for t in texts], np.int64), sizes))
    occurrences = np.concatenate([np.asarray(t[-1], np.int64) for t in texts])
    return pd.DataFrame({
        "block": [number], "texts": [[(t[0], *t[2:-2], int(n)) for t, n in zip(texts, sizes)]], "pairs": [pairs], "counts": [counts],
        "places": [pack(place, occurrences) if len(place) else b""],
    })


def align_blocks(vocabulary_a: str, model_b: str):
    """mapInPandas over (digest, mult, text): the aligned texts in blocks (see BLOCK)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = worker_memo(("alignment", vocabulary_a, model_b), lambda: Aligner(vocabulary_a, model_b))
        number, waiting, lines = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.iloc[at : at + ROWS]
                for digest, mult, found in zip(part["digest"], part["mult"], aligner.run(part["text"].tolist())):
                    waiting.append((digest, mult, *found))
                    lines += len(found[-2])
                    if lines >= BLOCK_LINES or len(waiting) >= BLOCK_TEXTS:
                        yield _block(number, waiting)
                        number, waiting, lines = number + 1, [], 0
        if waiting:
            yield _block(number, waiting)

    return run


def _measure(blocks: pa.Table, stats: pa.Table) -> pa.Table:
    """cogroup: the texts of a block with their measures, from the block and the counts of its pairs corpus-wide."""
    names = [field.split()[0] for field in FOUND.split(", ")]
    by_pair = np.argsort(stats.column("pair").to_numpy())
    count, is_best = (stats.column(c).to_numpy()[by_pair].astype(np.int64) for c in ("count", "is_best"))
    found = {name: [] for name in names}
    for texts, places in zip(blocks.column("texts").to_pylist(), blocks.column("places").to_pylist()):
        place, occurrences = unpack(places, 2) if places else (np.empty(0, np.int64), np.empty(0, np.int64))
        ends = np.cumsum([t["size"] for t in texts])
        for t in texts:
            for name in names[:-2]:
                found[name].append(t[name])
        for name, each in (("count_sum", occurrences * count[place]), ("n_best", occurrences * is_best[place])):
            found[name].extend(np.diff(np.append(0, np.cumsum(each))[ends], prepend=0).tolist())
    kinds = {"digest": pa.binary(), "groups_sha256": pa.string()}
    return pa.table({name: pa.array(found[name], kinds.get(name, pa.int64())) for name in names})


def size_b(model_b: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_b).get_piece_size()


def align_tokens(docs: DataFrame, vocabulary_a: str, model_b: str, key: str = "doc_id") -> DataFrame:
    """Per row: `key`, n_a, n_b, n_groups, n_links, n_best, count_sum (long) and groups_sha256.

    n_best: links whose pair count is the highest of their A id corpus-wide, ties included;
    count_sum: the pair counts of all links summed.
    """
    width = size_b(model_b)
    text = F.col("text")
    filled = (text.isNotNull()) & (text != "")
    # Each distinct text once, with the number of rows that hold it.
    distinct = docs.where(filled).groupBy("text").agg(F.count(F.lit(1)).alias("mult"))
    keyed = distinct.select(F.unhex(F.sha2(text, 256)).alias("digest"), "mult", "text")
    aligned = materialize(keyed.mapInPandas(align_blocks(vocabulary_a, model_b), BLOCK), "alignment", keep_shuffles=False)
    lines = aligned.select("block", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("counts").alias("count"))))
    counted = lines.groupBy("pair").agg(F.sum("count").alias("count"))
    best = F.max("count").over(Window.partitionBy((F.col("pair") / width).cast("long")))
    stats = materialize(counted.select("pair", "count", (F.col("count") == best).alias("is_best")), "alignment-pairs")
    # Merged, not broadcast: the pairs grow with the corpus.
    back = lines.select(F.col("block").alias("of"), "pair").join(stats.hint("merge"), "pair")
    per_text = aligned.select("block", "texts", "places").groupBy("block").cogroup(back.groupBy("of")).applyInArrow(_measure, FOUND)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.when(filled, F.unhex(F.sha2(text, 256))).alias("digest"))
    zero = F.lit(0).cast("long")
    return rows.join(per_text, "digest", "left").select(
        F.col("key").alias(key),
        *[F.coalesce(F.col(c), zero).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
        F.coalesce(F.col("groups_sha256"), F.lit("")).alias("groups_sha256"),
    )
