"""Byte-level BPE by the sentencepiece library, from a file of ranks.

The ranks are serialised straight into a sentencepiece model: each token's bytes become a
piece of printable stand-in characters, one per byte; its score is minus its rank; the
normalizer is the identity.  BPE then merges the adjacent pair of the best score first,
which is the lowest rank.  Piece ids are ranks.  Decoding maps ids to bytes.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidepost.llm.common import WordCache, by_size, byte_characters, in_batches, space_chunks, text_or_empty, worker_memo


# --- the model file ---------------------------------------------------------

def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    return bytes([*out, value])


def _field(number: int, content: bytes | int | float) -> bytes:
    """One protocol-buffer field: message or text, enumeration or flag, or float."""
    if isinstance(content, bytes):
        return _varint(number << 3 | 2) + _varint(len(content)) + content
    if isinstance(content, float):
        return _varint(number << 3 | 5) + struct.pack("<f", content)
    return _varint(number << 3) + _varint(content)


def read_ranks(path: str) -> list[bytes]:
    """Tokens in rank order from lines of base64 and rank."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in lines if line.strip())}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    return [ranks[i] for i in range(len(ranks))]


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model of byte-mapped pieces; piece i is token i, the unknown piece comes last."""
    characters = byte_characters()
    # Fixed values of sentencepiece's published model format: field numbers, piece types 1 normal and 2 unknown, model type 2 BPE.
    pieces = [
        _field(1, _field(1, "".join(characters[b] for b in token).encode()) + _field(2, -float(rank)) + _field(3, 1))
        for rank, token in enumerate(tokens)
    ]
    pieces.append(_field(1, _field(1, "⁇unknown".encode()) + _field(2, 0.0) + _field(3, 2)))
    trainer = _field(3, 2) + _field(4, len(pieces)) + _field(40, len(tokens))
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


# --- encoding and decoding --------------------------------------------------

class ByteBpe:
    """Encodes texts by `pattern`, each match separately, and decodes ids to bytes."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import sentencepiece

        self.tokens = read_ranks(ranks_path)
        self.ranks = {token: rank for rank, token in enumerate(self.tokens)}
        self.characters = byte_characters()
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.tokens))
        # White space in the pattern means Unicode's white space, which the regex module widens.
        white = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
        exact = pattern.replace("[^\\s", f"[^{white}").replace("\\s", f"[{white}]").replace("\\S", f"[^{white}]")
        self.split = regex.compile(exact).findall
        self.pretokens = WordCache(self._encode_pretokens, 250_000)
        self.cache = WordCache(self._encode_chunks, 300_000)

    def _encode_pretokens(self, pretokens: list[str]) -> list[bytes]:
        """A pre-token that is a token as a whole is that token; any other is merged."""
        out, merged, at = [b""] * len(pretokens), [], []
        for i, pretoken in enumerate(pretokens):
            data = pretoken.encode()
            if (rank := self.ranks.get(data)) is not None:
                out[i] = rank.to_bytes(4, "little")
            else:
                merged.append("".join([self.characters[b] for b in data]))
                at.append(i)
        for i, ids in zip(at, self.model.encode(merged, num_threads=1) if merged else []):
            out[i] = np.array(ids, "<u4").tobytes()
        return out

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        split = list(map(self.split, chunks))
        self.pretokens.learn(pretoken for found in split for pretoken in found)
        known = self.pretokens.__getitem__
        out = [b"".join(map(known, found)) for found in split]
        self.pretokens.age()
        return out

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        for group in by_size(texts):
            chunked = [space_chunks(text) for text in group]
            self.cache.learn(chain.from_iterable(chunks for chunks in chunked if chunks))
            for text, chunks in zip(group, chunked):
                if chunks is None:
                    yield b"".join(self._encode_pretokens(self.split(text)))
                else:
                    yield b"".join(map(self.cache.__getitem__, chunks))
            self.cache.age()

    def decode(self, ids: bytes) -> bytes:
        """The inverse: the bytes of each id, one after the other."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def byte_bpe(ranks_path: str, pattern: str) -> ByteBpe:
    return worker_memo(("byte bpe", ranks_path, pattern), lambda: ByteBpe(ranks_path, pattern))


def _mapped(rows: DataFrame, ranks_path: str, pattern: str, schema: pa.Schema, work) -> DataFrame:
    """`work(coder, values)` over the second column of `rows`, a slice of the rows at a time, in one Python step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(ranks_path, pattern)
        made = (
            (doc_id, *made)
            for b in batches for at in range(0, b.num_rows, 1024)
            for doc_id, made in zip(b.column(0).slice(at, 1024).to_pylist(), work(coder, b.column(1).slice(at, 1024).to_pylist()))
        )
        yield from in_batches(made, schema, lambda row: sum(len(v or b"") for v in row[1:]))

    return rows.mapInArrow(run, ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'binary'}" for f in schema))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) of each row's whole text.

    Row by row, no shuffle: repeated rows and null doc_ids stay, a null or empty text has
    no ids, other columns are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
    return _mapped(_texts(docs), ranks_path, pattern, schema, lambda coder, texts: ((ids,) for ids in coder.encode_all(texts)))


def decode_ids(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, decoded: the bytes that `ids` stand for; null ids give null."""
    schema = pa.schema([("doc_id", pa.int64()), ("decoded", pa.binary())])
    decode = lambda coder, ids: ((None if i is None else coder.decode(i),) for i in ids)
    return _mapped(encoded.select("doc_id", "ids"), ranks_path, pattern, schema, decode)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, ids, decoded: encoded and decoded again in the same Python worker, which holds one model."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])
    return _mapped(_texts(docs), ranks_path, pattern, schema, lambda coder, texts: ((ids, coder.decode(ids)) for ids in coder.encode_all(texts)))
