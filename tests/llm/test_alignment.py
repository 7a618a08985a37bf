import hashlib
from collections import Counter

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.conftest import rows_of
from tidepost.llm import alignment, queries
from tidepost.llm.common import byte_characters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def tokens(texts):
    """Per text: A and B tokens as (id, bytes), straight from the libraries; None where bytes differ."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    back = {c: i for i, c in enumerate(byte_characters())}
    out = []
    for text in texts:
        if not text:
            out.append(None)
            continue
        ta = [(i, bytes(back[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        tb = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            tb.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        target = (" " + text).encode()
        ok = b"".join(x for _, x in ta) == target and b"".join(x for _, x in tb) == target
        out.append((ta, tb) if ok else None)
    return out


def spans(toks):
    at, out = 0, []
    for i, x in toks:
        out.append((i, at, at + len(x)))
        at += len(x)
    return out


def brute(rows):
    """Rows (doc_id, text) to the expected measures by doc_id, with a double loop over tokens."""
    found = tokens([t for _, t in rows])
    links, groups = [], []
    for f in found:
        if f is None:
            links.append([])
            groups.append((0, ""))
            continue
        sa, sb = spans(f[0]), spans(f[1])
        pairs, j0 = [], 0
        for a, s, e in sa:
            while sb[j0][2] <= s:
                j0 += 1
            j = j0
            while j < len(sb) and sb[j][1] < e:
                pairs.append((a, sb[j][0]))
                j += 1
        links.append(pairs)
        ends = sorted({e for _, _, e in sa} & {u for _, _, u in sb})
        parts, ia, ib = [], 0, 0
        for end in ends:
            ga, gb = [], []
            while ia < len(sa) and sa[ia][2] <= end:
                ga.append(str(sa[ia][0]))
                ia += 1
            while ib < len(sb) and sb[ib][2] <= end:
                gb.append(str(sb[ib][0]))
                ib += 1
            parts.append(",".join(ga) + "|" + ",".join(gb))
        groups.append((len(ends), hashlib.sha256(";".join(parts).encode()).hexdigest()))
    count = Counter(p for ls in links for p in set(ls))
    best = {}
    for (a, _), c in count.items():
        best[a] = max(best.get(a, 0), c)
    out = []
    for (d, _), f, ls, g in zip(rows, found, links, groups):
        if f is None:
            out.append((d, (0, 0, 0, 0, 0, 0, "")))
        else:
            out.append((d, (len(f[0]), len(f[1]), g[0], len(ls), sum(count[p] == best[p[0]] for p in ls), sum(count[p] for p in ls), g[1])))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def got(df):
    return sorted(((r["doc_id"], tuple(r[n] for n in NAMES)) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_against_brute_force_with_awkward_rows(spark, awkward):
    extra = spark.createDataFrame([(20, "Hello  world <s> é 漢字 \x01 <|endoftext|>"), (21, "▁ x"), (22, "ﬁ"), (23, "Hello  world <s> é 漢字 \x01 <|endoftext|>")], "doc_id long, text string")
    docs = awkward.select("doc_id", "text").unionByName(extra)
    result = alignment.align_tokens(awkward.unionByName(extra, allowMissingColumns=True), A, B)
    assert got(result) == brute(rows_of(docs))


def test_empty_table(spark, no_rows):
    assert alignment.align_tokens(no_rows, A, B).count() == 0


def test_query_against_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    assert got(queries.op13_alignment(spark, tables)) == brute(rows_of(docs))


def test_a_block_holds_each_pair_once_with_its_documents(spark):
    texts = [f"the same few words again and {i}" for i in range(50)]
    keyed = spark.createDataFrame([(t.encode(), 2, t) for t in texts], "digest binary, mult long, text string").coalesce(1)
    (block,) = keyed.mapInPandas(alignment.align_blocks(A, B), alignment.BLOCK).collect()
    own = sum(t["size"] for t in block["texts"])
    assert len(block["texts"]) == 50 and len(block["pairs"]) == len(set(block["pairs"])) < own / 2
    assert sum(block["counts"]) == 2 * own and max(block["counts"]) == 100
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 2)], "doc_id long, text string").repartition(7)
    assert got(alignment.align_tokens(docs, A, B)) == brute(rows_of(docs))
