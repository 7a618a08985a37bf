"""Quality rules by tokeniser fertility.

A public vocabulary is a yardstick: text of a kind it was made for takes few tokens per
character, hardly ever falls back to bytes and spreads over many tokens.  Each text is
measured by three numbers: characters per token, share of byte-fallback tokens, and entropy
of its token distribution relative to the most its length allows.  Fixed outer limits per
script and a band per language (script where none is given), taken from all documents, say
what is kept; a short text's measures scatter, so its bounds are wider by the error of its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from tidepost.llm.common import WordCache, by_size, per_text, with_text_result, worker_memo
from tidepost.session import materialize

# The base rules' own figures.
MIN_WORDS, REPEAT_WINDOW, MAX_REPEAT_PERCENT = 10, 5, 20
# Bounds are wider for texts of fewer tokens, and bands come from longer ones where a group has enough; smaller groups have
# no bands of their own.
MIN_TOKENS, MIN_GROUP = 150, 30
# A group's own band of characters per token, around its median: so many interquartile ranges
# below and above, but never narrower than this share of the median.
BELOW, ABOVE, NARROWEST = 3.0, 6.0, 0.06
# Outer limits per script: least and most characters per token, most byte-fallback tokens in 100, least relative entropy.
BANDS = {
    "latin": (1.0, 8.0, 10.0, 0.35),
    "cyrillic": (0.8, 7.0, 20.0, 0.35),
    "greek": (0.5, 6.0, 40.0, 0.35),
    "arabic": (0.5, 6.0, 40.0, 0.35),
    "hebrew": (0.5, 6.0, 40.0, 0.35),
    "han": (0.2, 5.0, 80.0, 0.3),
    "kana": (0.2, 5.0, 80.0, 0.3),
    "hangul": (0.2, 5.0, 90.0, 0.3),
    "other": (0.1, 10.0, 100.0, 0.25),
}
# First and last code point of each script's main blocks.
SCRIPTS = [
    ("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("hebrew", 0x590, 0x5FF),
    ("arabic", 0x600, 0x77F), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
]
_MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "script string, n_tokens long, chars_per_token double, byte_share double, token_entropy double"
)


# --- base figures -----------------------------------------------------------

def repeated_words(codes: np.ndarray, width: int = REPEAT_WINDOW) -> int:
    """Words that lie in a window of `width` words found twice or more; equal codes are equal words."""
    if len(codes) <= width:
        return 0
    # Windows get exact numbers by doubling: numbers of pairs, of pairs of pairs, and so on.
    number, size = codes, 1
    while size < width:
        step = min(size, width - size)
        pairs = number[: len(number) - step] * np.int64(int(number.max()) + 1) + number[step:]
        number = np.unique(pairs, return_inverse=True)[1]
        size += step
    hit = np.bincount(number)[number] > 1
    covered = np.zeros(len(codes) + 1, np.int64)
    starts = np.flatnonzero(hit)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + width, -1)
    return int((np.cumsum(covered) > 0).sum())


def duplicate_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in data.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def script_of(text: str) -> str:
    """The script of most letters; `other` without letters."""
    if text.isascii():
        return "latin" if any(c.isalpha() for c in text) else "other"
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    best, most = "other", 0
    for name, first, last in SCRIPTS:
        inside = points[(points >= first) & (points <= last)]
        n = len(inside) - int(((inside >= 0x5B) & (inside <= 0x60) | (inside >= 0x7B) & (inside <= 0xBF)).sum()) if name == "latin" else len(inside)
        if n > most:
            best, most = name, n
    return best


# --- fertility --------------------------------------------------------------

class Yardstick:
    """A sentencepiece vocabulary with byte fallback; each distinct word is encoded once per worker."""

    def __init__(self, vocabulary: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        self.size = self.model.vocab_size()
        self.fallback = np.array([self.model.is_byte(i) for i in range(self.size)])
        self.cache = WordCache(self._encode, 300_000)

    def _encode(self, words: list[bytes]) -> list[bytes]:
        return [np.array(ids, "<u2" if self.size < 1 << 16 else "<u4").tobytes() for ids in self.model.encode([w.decode() for w in words], num_threads=1)]

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.cache.__getitem__, words)), "<u2" if self.size < 1 << 16 else "<u4")


def measures_of(vocabulary: str):
    """The base figures and the three measures of a text column, as a struct."""

    def work(texts: list[str]) -> Iterator[tuple]:
        yardstick = worker_memo(("yardstick", vocabulary), lambda: Yardstick(vocabulary))
        symbols, spaces = [b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"], [b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"]
        for group in by_size(texts):
            raw = [text.encode() for text in group]
            # bytes.split knows the six ASCII white spaces only.
            words = [data.split() for data in raw]
            yardstick.cache.learn(chain.from_iterable(words))
            for text, data, own in zip(group, raw, words):
                numbers: dict[bytes, int] = {}
                codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in own), np.int64, len(own))
                ids = yardstick.ids(own)
                word_chars, n = len(text) - sum(map(data.count, spaces)), len(ids)
                shares = np.unique(ids, return_counts=True)[1] / max(n, 1)
                yield (
                    len(own), word_chars, sum(map(data.count, symbols)), duplicate_lines(data), repeated_words(codes),
                    script_of(text), n, word_chars / max(n, 1), float(yardstick.fallback[ids].sum()) / max(n, 1),
                    max(0.0, float(-(shares * np.log2(shares)).sum())),
                )
            yardstick.cache.age()

    return per_text(_MEASURES, work)


def measured(docs: DataFrame, vocabulary: str) -> DataFrame:
    """row, quality (figures and measures) and group (lang, or the script where there is none)."""
    measures = with_text_result(docs, "quality", measures_of(vocabulary))
    script = F.col("quality.script")
    return measures.withColumn("group", F.coalesce(F.col("row.lang").cast("string"), script) if "lang" in docs.columns else script)


def group_bands(measures: DataFrame) -> DataFrame:
    """group, middle, least, most: each group's own band of characters per token.

    Texts shorter than MIN_TOKENS count only where a group has fewer than MIN_GROUP others.
    Quartiles come from counts by thousandths, so they do not depend on the order of rows,
    and a group of any size is a few thousand rows before its window.
    """
    is_long = F.col("quality.n_tokens") >= MIN_TOKENS
    counts = measures.filter(is_long | (F.col("quality.n_words") >= MIN_WORDS)).groupBy(
        "group", is_long.alias("is_long"), F.round("quality.chars_per_token", 3).alias("x")
    ).agg(F.count(F.lit(1)).alias("n"))
    long_rows = F.sum(F.when(F.col("is_long"), F.col("n")).otherwise(0)).over(Window.partitionBy("group"))
    counts = counts.withColumn("long_rows", long_rows).filter(F.col("is_long") | (F.col("long_rows") < MIN_GROUP))
    counts = counts.groupBy("group", "x").agg(F.sum("n").alias("n"))
    own = Window.partitionBy("group")
    counts = counts.withColumns({"upto": F.sum("n").over(own.orderBy("x")), "all": F.sum("n").over(own)})
    quartile = lambda share: F.min(F.when(F.col("upto") >= share * F.col("all"), F.col("x")))
    spread = F.col("q3") - F.col("q1")
    width = lambda times: F.greatest(times * spread, NARROWEST * F.col("q2"))
    return (
        counts.groupBy("group").agg(quartile(0.25).alias("q1"), quartile(0.5).alias("q2"), quartile(0.75).alias("q3"), F.max("all").alias("rows"))
        .filter(F.col("rows") >= MIN_GROUP)
        .select("group", F.col("q2").alias("middle"), (F.col("q2") - width(BELOW)).alias("least"), (F.col("q2") + width(ABOVE)).alias("most"))
    )


def judged(measures: DataFrame, bands: dict[str, tuple[float, float, float, float]]) -> DataFrame:
    """`measures`, which must be stored, with base_failed as `base` and `reason` (null if kept)."""
    q = F.col("quality")
    limit = lambda i: F.create_map(*[x for s, b in bands.items() for x in (F.lit(s), F.lit(float(b[i])))])[q["script"]]
    base = (q["n_words"] < MIN_WORDS) | (100 * q["n_repeat_words"] > MAX_REPEAT_PERCENT * q["n_words"])
    relative = q["token_entropy"] / F.log2(F.greatest(q["n_tokens"], F.lit(2)).cast("double"))
    # The sampling error that a text has beyond that of one of MIN_TOKENS, which the bands hold already.
    error = F.sqrt(F.greatest(F.lit(0.0), 1 / F.greatest(q["n_tokens"], F.lit(1)) - 1 / MIN_TOKENS))
    slack = F.col("middle") * error
    reason = (
        F.when(base, "base")
        .when(q["chars_per_token"] < F.greatest(limit(0), F.col("least") - slack), "many tokens per character")
        .when(q["chars_per_token"] > F.least(limit(1), F.col("most") + slack), "few tokens per character")
        .when(100 * q["byte_share"] > limit(2) + 100 * error, "byte fallback")
        .when(relative < limit(3), "low token entropy")
    )
    # Stored bands have a known size: few are sent and the documents stay where they are, very many are joined by shuffle.
    return measures.join(materialize(group_bands(measures), "group-bands"), "group", "left").withColumns({"base": base, "reason": reason})


def quality_rules(docs: DataFrame, vocabulary: str, bands: dict[str, tuple[float, float, float, float]] = BANDS) -> DataFrame:
    """doc_id, figures, measures, base_failed, reason and kept, one row per row of `docs`.

    Texts stay where they are; the measures are stored and read for the bands and the
    verdicts.  Null and empty texts have no word and fail the base rules; repeated rows
    and null doc_ids are judged like others; columns but doc_id, text and lang are ignored.
    """
    known = docs.select("doc_id", "text", *[c for c in ("lang",) if c in docs.columns])
    stored = materialize(measured(known, vocabulary).select("row.doc_id", "quality", "group"), "quality-measures")
    return judged(stored, bands).select("doc_id", "quality.*", F.col("base").alias("base_failed"), "reason", F.col("reason").isNull().alias("kept"))


def kept_documents(docs: DataFrame, vocabulary: str, bands: dict[str, tuple[float, float, float, float]] = BANDS) -> DataFrame:
    """The rows of `docs` that the rules keep, with their own columns; rows and measures are stored side by side."""
    return judged(materialize(measured(docs, vocabulary), "quality-documents"), bands).filter(F.col("reason").isNull()).select("row.*")
