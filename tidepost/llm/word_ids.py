"""Ids by the tokenizers library, with each distinct word encoded once per worker.

Two kinds of tokenizer qualify: those that drop white space and never span it, whose texts
fall apart at each space, and byte-level ones, whose texts fall apart before each space
(`space_chunks`).  Arrow splits the texts and numbers their distinct words, the library sees
the words that are new to the worker, and numpy lays the ids out by word number.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidepost.llm.common import WordCache, byte_characters, space_chunks, worker_memo

# Bytes of text that are split at a time.
GROUP_BYTES = 2_000_000
# White space next to white space, or of doubtful kind: such texts are cut by `space_chunks`.
_RAGGED = (
    r"[\t-\r\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]{2}|[\x1c-\x1f]"
)


class WordIds:
    """Encodes texts; `byte_level` tells the two kinds of tokenizer apart."""

    def __init__(self, vocabulary: str, byte_level: bool):
        # A task is one core's work; the library's own threads would add memory for each core of the machine.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True
        self.byte_level = byte_level
        self.model, self.closing, self.characters = self.tokenizer.model, {}, byte_characters()
        self.plain = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f]+)([!-&(-/:-@\\[-`{-~]*)").fullmatch
        self.cache = WordCache(self._encode_words)

    def _encode(self, texts: list[str]) -> Iterator[bytes]:
        for at in range(0, len(texts), 4096):
            for found in self.tokenizer.encode_batch_fast(texts[at : at + 4096], add_special_tokens=False):
                yield array("I", found.ids).tobytes()

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Words after a space; byte-level tokens hold that space.

        Letters below U+0130 are one pre-token whatever marks follow them, apostrophes
        apart, so the library's model gets such a word and its closing marks directly.
        """
        plain, merge, closing, others = self.plain, self.model.tokenize, self.closing, []
        out = [b""] * len(words)
        for i, word in enumerate(words):
            found = plain(word)
            if found is None:
                others.append(i)
                continue
            stem, tail = found.groups()
            if not stem.isascii():
                stem = "".join(map(self.characters.__getitem__, (stem if self.byte_level else stem.lower()).encode()))
            elif not self.byte_level:
                stem = stem.lower()
            ids = [t.id for t in merge("\u0120" + stem if self.byte_level else stem)]
            if tail:
                if tail not in closing:
                    closing[tail] = [t.id for t in merge(tail)]
                ids += closing[tail]
            out[i] = array("I", ids).tobytes()
        for i, ids in zip(others, self._encode([" " + words[i] if self.byte_level else words[i] for i in others])):
            out[i] = ids
        return out

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text (unsigned 32-bit), in order; nulls count as empty."""
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GROUP_BYTES)))
            yield from self._encode_group(pc.fill_null(texts.slice(at, to - at), ""))
            at = to

    def _encode_group(self, texts: pa.Array) -> Iterator[np.ndarray]:
        ragged = pc.match_substring_regex(texts, _RAGGED).to_numpy(zero_copy_only=False) if self.byte_level else np.zeros(len(texts), bool)
        pieces = pc.split_pattern(texts.filter(pa.array(~ragged)), " ")
        offsets = pieces.offsets.to_numpy().astype(np.int64) - pieces.offsets[0].as_py() if len(pieces) else np.zeros(1, np.int64)
        numbered = pieces.flatten().dictionary_encode()
        codes = numbered.indices.to_numpy().astype(np.int64)
        words = numbered.dictionary.to_pylist()
        self.cache.learn_new(words)
        parts = list(map(self.cache.__getitem__, words))
        if self.byte_level:
            # A text's first piece has no space before it.
            firsts = offsets[:-1]
            parts.extend(self._encode([words[i] for i in codes[firsts].tolist()]))
            codes[firsts] = len(words) + np.arange(len(firsts))
        lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        ids, starts = np.frombuffer(b"".join(parts), np.uint32), np.cumsum(lengths) - lengths
        own = lengths[codes]
        upto = np.concatenate([[0], np.cumsum(own)])
        laid = ids[np.arange(upto[-1]) + np.repeat(starts[codes] - upto[:-1], own)]
        cuts = iter(upto[offsets].tolist())
        begin = next(cuts)
        for i, odd in enumerate(ragged.tolist()):
            if odd:
                yield self._encode_ragged(texts[i].as_py())
            else:
                end = next(cuts)
                yield laid[begin:end]
                begin = end
        self.cache.age()

    def _encode_ragged(self, text: str) -> np.ndarray:
        chunks = space_chunks(text) or [text]
        distinct = list(dict.fromkeys(chunks))
        known = dict(zip(distinct, self._encode(distinct)))
        return np.frombuffer(b"".join(map(known.__getitem__, chunks)), np.uint32)


def word_ids(vocabulary: str, byte_level: bool) -> WordIds:
    return worker_memo(("word ids", vocabulary, byte_level), lambda: WordIds(vocabulary, byte_level))
