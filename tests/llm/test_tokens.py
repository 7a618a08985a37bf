import base64
import hashlib
import random
import zlib

import numpy as np
import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import rows_of
from tidepost.llm import byte_bpe, packing, queries, token_files
from tidepost.llm.word_ids import WordIds
from tidepost.session import scratch_path

WORD, BYTE, RANKS = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"))


def library(path, texts):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def little_endian(ids):
    return np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 16, 17, 31, 32])
def test_packing_round_trip_and_random_access(bits, tmp_path):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000, dtype=np.uint64).astype(np.uint32)
    ends = [0, 10, 10, 999, 1000]
    path = tmp_path / "shard"
    path.write_bytes(token_files.shard_bytes([5, None, 6, 7, 8], ends, ids, bits, block=64))
    with open(path, "rb") as source:
        shard = token_files.Shard(source)
        assert shard.doc_ids == [5, None, 6, 7, 8]
        for a, b in ((0, 0), (0, 1000), (63, 65), (128, 192), (999, 1000)):
            assert shard.tokens(a, b).tolist() == ids[a:b].tolist()
        assert shard.document(1).tolist() == ids[0:10].tolist() and shard.document(2).tolist() == []


def test_bits_are_the_fewest_and_too_large_ids_are_refused():
    assert [token_files.bits_for(n) for n in (1, 2, 3, 256, 257, 49408, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]
    with pytest.raises(ValueError):
        token_files.shard_bytes([1], [1], np.array([4], np.uint32), 2)


@pytest.mark.parametrize("vocabulary, byte_level", [(WORD, False), (BYTE, True)])
def test_word_by_word_encoding_equals_the_library(vocabulary, byte_level):
    import pyarrow as pa

    rng = random.Random(3)
    alphabet = ["a", "Z", "é", "É", "ß", "ñ", "İ", "ŉ", "Σ", "ς", "é", "́", "漢", "ｶ", "1", "٣", "'", "'s", "'LL", "!", "...", "&", "|",
                " ", "  ", "\n", "\t", "\r\n", " ", " ", "\x1c", "​", "<|endoftext|>", "the", "🙂", "\x00"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + ["", " ", "x" * 5000]
    encoder = WordIds(vocabulary, byte_level)
    got = [ids.tolist() for ids in encoder.encode(pa.array(texts))]
    assert got == library(vocabulary, texts)
    assert [i.tolist() for i in encoder.encode(pa.array([None, "the"], pa.string()))] == [[], library(vocabulary, ["the"])[0]]


def test_token_files_hold_documents_in_order(spark, awkward):
    folder = scratch_path(spark, "test-tokens")
    token_files.write_token_files(awkward, folder, WORD, 49408, 2, shard_tokens=3000)
    got = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r["start"])
    wanted = sorted(rows_of(awkward), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    start = 0
    for row, (doc_id, text), ids in zip(got, wanted, library(WORD, [t for _, t in wanted]), strict=True):
        assert (row["doc_id"], row["start"], bytes(row["ids"])) == (doc_id, start, little_endian([*ids, 2]))
        start += len(ids) + 1


def test_token_files_of_an_empty_table(spark, no_rows):
    folder = scratch_path(spark, "test-tokens")
    token_files.write_token_files(no_rows, folder, WORD, 49408, 2)
    assert token_files.read_token_files(spark, folder).count() == 0


def test_byte_bpe_equals_the_public_encoder_and_decodes(spark, awkward, no_rows):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    encoder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(5)
    texts = ["".join(rng.choice(["a", "th", "é", "漢", "1", "'s", "!", " ", "  ", "\n", " ", "\x1c", "🙂"]) for _ in range(rng.randint(0, 60))) for _ in range(500)]
    coder = byte_bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
    for text, ids in zip(texts, coder.encode_all(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()
    tokens = coder._encode_pretokens([t.decode() for t in ranks if t.decode(errors="replace").encode() == t])
    assert all(len(t) == 4 for t in tokens)
    model = RANKS, public_tokenizers.PATTERN
    got = byte_bpe.round_trip(awkward, *model).collect()
    for row, (doc_id, text) in zip(got, rows_of(awkward), strict=True):
        assert row["doc_id"] == doc_id and bytes(row["decoded"]) == text.encode()
        assert bytes(row["ids"]) == little_endian(encoder.encode_ordinary(text))
    assert byte_bpe.decode_ids(byte_bpe.encode_texts(awkward, *model), *model).count() == awkward.count()
    assert byte_bpe.round_trip(no_rows, *model).count() == 0


# --- minimum bin slack ------------------------------------------------------

def test_fill_is_the_closest_subset_sum():
    rng = random.Random(1)
    for _ in range(300):
        counts = {rng.randint(1, 40): rng.randint(1, 3) for _ in range(rng.randint(1, 6))}
        capacity = rng.randint(0, 90)
        reach = {0}
        for length, n in counts.items():
            reach = {s + k * length for s in reach for k in range(n + 1) if s + k * length <= capacity}
        used = packing.closest_fill(counts, capacity)
        assert sum(l * n for l, n in used.items()) == max(reach)
        assert all(0 < n <= counts[l] for l, n in used.items())


def test_plan_uses_each_piece_once_and_does_not_grow_with_the_counts():
    histogram = {100: 7, 60: 9, 33: 20, 5: 1, 128: 3}
    plan = packing.plan_windows(histogram, 128)
    used = {}
    for times, kind in plan:
        assert sum(l * n for l, n in kind.items()) <= 128
        for length, n in kind.items():
            used[length] = used.get(length, 0) + times * n
    assert used == histogram
    assert len(packing.plan_windows({l: n * 10**9 for l, n in histogram.items()}, 128)) < 30
    assert packing.plan_windows({}, 128) == []


def check_packed(rows, texts, window):
    """Every id once, no window too long or with gaps; returns the padding."""
    wanted = {}
    for (doc_id, _), ids in zip(texts, library(BYTE, [t for _, t in texts])):
        wanted.setdefault(doc_id, []).append(little_endian([*ids, packing_end()]))
    pieces, sequences = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault(r["doc_id"], []).append(r)
    for doc_id, own in pieces.items():
        if len(wanted[doc_id]) == 1:
            data, at = wanted[doc_id][0], 0
            for r in sorted(own, key=lambda r: r["start"]):
                assert r["start"] == at and r["doc_tokens"] == len(data) // 4
                assert r["ids_crc32"] == zlib.crc32(data[4 * at : 4 * (at + r["length"])])
                at += r["length"]
            assert 4 * at == len(data)
        else:
            assert sum(r["length"] for r in own) == sum(len(d) // 4 for d in wanted[doc_id])
    assert set(pieces) == set(wanted)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert 0 < at <= window
    return sum(window - sum(l for _, l in p) for p in sequences.values())


def packing_end():
    return queries.PACK_END_ID


def test_packed_pieces(spark, awkward, no_rows):
    check_packed(queries.packed(awkward).collect(), rows_of(awkward), 2048)
    assert queries.packed(no_rows).count() == 0
    whole = packing.pack_documents(awkward, BYTE, 1, window=16)
    assert {len(bytes(r["ids"])) // 4 == r["length"] for r in whole.select("ids", "length").collect()} == {True}


def test_registered_token_queries(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    texts = rows_of(docs)
    padding = check_packed(queries.op9_packing(spark, tables).collect(), texts, 2048)
    assert padding < 2 * 2048
    start, ids_of = 0, library(WORD, [t for _, t in sorted(texts)])
    rows = sorted(queries.op1_token_files(spark, tables).collect(), key=lambda r: r["doc_id"])
    for row, ids in zip(rows, ids_of, strict=True):
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids) + 1, zlib.crc32(little_endian([*ids, 2])))
        start += len(ids) + 1
    got = {r["doc_id"]: r for r in queries.op7_byte_bpe(spark, tables).collect()}
    for (doc_id, text), ids in zip(texts, library(BYTE, [t for _, t in texts])):
        assert got[doc_id]["n_tokens"] == len(ids) and got[doc_id]["ids_sha256"] == hashlib.sha256(little_endian(ids)).hexdigest()
        assert got[doc_id]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
