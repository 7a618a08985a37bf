"""Personal data by bootstrapped contextual extraction.

Patterns for e-mail and IP addresses, card and phone numbers find seed entities.  The words
before seeds are lexical patterns; other identifier-like strings after the same words are
instances of the same patterns.  Spark scores the graph of patterns and instances in rounds:
a pattern is as good as the share of its instances that are known or believed, an instance
is believed as far as any of its patterns is good.  What follows a pattern of high confidence
and has the shape of its kind is reported as well.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from tidepost.llm.common import per_text, text_or_empty
from tidepost.session import materialize

KINDS = ("email", "ip", "card", "phone")
# Distinct seeds that a pattern needs, rounds of scoring, and confidence from which a pattern counts.
MIN_SEEDS, ROUNDS, CONFIDENT = 3, 3, 0.8
# Added to the number of a pattern's instances: few instances are weak evidence.
SMOOTHING = 0.5

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+").match
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*").finditer
_NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9])+").finditer
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]").finditer
_DIGIT = re.compile(r"[0-9]").search
_MARKED = re.compile(r"[0-9@]").search
_WORDS = re.compile(r"\S+").finditer
_EDGES = ".,;:!?\"'()[]{}<>|*#$%&"


# --- seeds ------------------------------------------------------------------

def emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of local part, `@` and dotted domain, searched from each `@` outwards: linear in the text."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers joined by dots, each at most 255; longer chains are taken four by four."""
    for m in _DOTTED(text):
        parts, start = m[0].split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, end
            start = end + 1


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def seeds(text: str) -> list[tuple[int, int, int]]:
    """start, end, kind number of the base matches."""
    found = [(a, b, 0) for a, b in emails(text)] if "@" in text else []
    if not _DIGIT(text):
        return found
    found += [(a, b, 1) for a, b in addresses(text)]
    for m in _NUMBER(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), 2))
    if "+" in text:
        found += [(m.start(), m.end(), 3) for m in _PHONE(text) if 9 <= sum(c.isdigit() and c.isascii() for c in m[0]) <= 15]
    return found


# --- contexts ---------------------------------------------------------------

def shapes(value: str) -> list[int]:
    """Kinds whose entities may look like this."""
    digits = sum(c in "0123456789" for c in value)
    letters = any(c.isalpha() for c in value)
    out = [0] if "@" in value else []
    if digits >= 4 and sum(value.count(c) for c in ".:-") >= 3:
        out.append(1)
    if not letters and 12 <= digits <= 19:
        out.append(2)
    if not letters and 7 <= digits <= 15:
        out.append(3)
    return out


def contexts(text: str, found: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, list[int], str, list[str]]]:
    """start, end, seed kind (-1: none), possible kinds, value and patterns of every seed and candidate.

    A candidate is a run of words with a digit or an `@` that touches no seed, without marks
    at its edges.  Patterns are the last word and the last two words before it.
    """
    if not _MARKED(text):
        return
    words = [(m.start(), m.end(), bool(_MARKED(m[0]))) for m in _WORDS(text)]

    def patterns(place: int) -> list[str]:
        before = [text[a:b].lower().rstrip("!?*#$%&|") for a, b, _ in words[max(0, place - 2) : place]]
        before = [w for w in before if w]
        return [" ".join(before[-n:]) for n in (1, 2) if len(before) >= n]

    taken = sorted(found)
    place, own = 0, 0
    for start, end, kind in taken:
        while place < len(words) and words[place][1] <= start:
            place += 1
        yield start, end, kind, [kind], text[start:end], patterns(place)
    i = 0
    while i < len(words):
        if not words[i][2]:
            i += 1
            continue
        j = i
        while j + 1 < len(words) and words[j + 1][2] and words[j + 1][0] == words[j][1] + 1:
            j += 1
        start, end = words[i][0], words[j][1]
        while own < len(taken) and taken[own][1] <= start:
            own += 1
        touches = any(a < end and b > start for a, b, _ in taken[own : own + 4])
        value = text[start:end]
        start += len(value) - len(value.lstrip(_EDGES))
        value = value.strip(_EDGES)
        if value and not touches and (possible := shapes(value)):
            yield start, start + len(value), -1, possible, value, patterns(i)
        i = j + 1


_ITEM = "struct<start:bigint,end:bigint,seed:int,kinds:array<int>,value:string,patterns:array<string>>"
_FOUND = f"n_email long, n_ip long, n_card long, n_phone long, base array<struct<kind:int,start:bigint,end:bigint>>, items array<{_ITEM}>"


def _extract(texts: list[str]) -> Iterator[tuple]:
    for text in texts:
        found = seeds(text)
        counts = [sum(kind == k for _, _, kind in found) for k in range(4)]
        base = [{"kind": kind, "start": a, "end": b} for a, b, kind in found]
        names = ("start", "end", "seed", "kinds", "value", "patterns")
        yield (*counts, base, [dict(zip(names, item)) for item in contexts(text, found)])


# --- the graph --------------------------------------------------------------

def pattern_confidence(edges: DataFrame, min_seeds: int, rounds: int) -> DataFrame:
    """pattern, kind, confidence after `rounds` rounds.

    `edges`: pattern, value, kind, seed; a value that is no seed has one edge for each kind
    it may be of.  Only patterns with enough distinct seeds of a kind take part.  Sums are
    combined before each shuffle, and believed instances are stored after each round.
    """
    instances = edges.groupBy("pattern").agg(F.count_distinct("value").alias("all"))
    supported = edges.filter("seed").groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("seeds")).filter(F.col("seeds") >= min_seeds)
    rated = materialize(supported.join(instances, "pattern"), "pattern-support")
    unknown = materialize(
        edges.filter("NOT seed").join(rated.select("pattern", "kind", "all", "seeds"), ["pattern", "kind"]), "pattern-instances"
    )
    share = lambda believed: F.least((F.col("seeds") + believed) / (F.col("all") + SMOOTHING), F.lit(0.999))
    confidence = rated.select("pattern", "kind", share(F.lit(0.0)).alias("confidence"))
    for _ in range(rounds):
        scored = unknown.select("pattern", "kind", "value").join(confidence, ["pattern", "kind"]).groupBy("value", "kind").agg(
            (1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("belief")
        )
        believed = unknown.select("pattern", "kind", "value").join(scored, ["value", "kind"]).groupBy("pattern", "kind").agg(F.sum("belief").alias("_b"))
        confidence = materialize(
            rated.join(believed, ["pattern", "kind"], "left").select("pattern", "kind", share(F.coalesce("_b", F.lit(0.0))).alias("confidence")),
            "pattern-confidence",
        )
    return confidence


def find_personal_data(docs: DataFrame, min_seeds: int = MIN_SEEDS, rounds: int = ROUNDS, confident: float = CONFIDENT) -> DataFrame:
    """doc_id, counts of base matches by kind, base and all spans, for every row.

    Spans are arrays of (kind, start, end) by kind and start, in code points, ends exclusive.
    Null texts count as empty; repeated rows and null ids stay, and copies of a text support
    a pattern once, because its instances are counted as distinct values.
    """
    extracted = docs.select("doc_id", per_text(_FOUND, _extract)(text_or_empty()).alias("_f")).select(
        F.monotonically_increasing_id().alias("_row"), "doc_id", "_f.*"
    )
    stored = materialize(extracted, "personal-data")
    items = stored.select("_row", F.explode("items").alias("i")).select("_row", "i.*")
    edges = (
        items.withColumn("pattern", F.explode("patterns"))
        .withColumn("kind", F.explode("kinds"))
        .groupBy("pattern", F.xxhash64("value").alias("value"), "kind")
        .agg(F.max(F.col("seed") >= 0).alias("seed"))
    )
    good = pattern_confidence(materialize(edges, "pattern-edges"), min_seeds, rounds).filter(F.col("confidence") >= confident)
    candidates = items.filter("seed < 0").withColumn("pattern", F.explode("patterns")).withColumn("kind", F.explode("kinds"))
    new = (
        candidates.join(good, ["pattern", "kind"])
        .groupBy("_row", "start", "end").agg(F.max_by("kind", F.struct("confidence", -F.col("kind"))).alias("kind"))
        .groupBy("_row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("_new"))
    )
    ordered = F.array_sort(F.concat("base", F.coalesce("_new", F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>"))))
    return stored.join(new, "_row", "left").select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.array_sort("base").alias("base"), ordered.alias("spans")
    )


def as_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
