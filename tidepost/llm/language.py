"""Language identification by a byte convolutional network.

Bytes are embedded, filters of several widths slide over a window, the largest response of
each filter is kept, and a softmax layer names the language.  The network is trained in numpy
on a bounded sample of labelled windows.  Texts are cut into fixed-length windows, all of
which are judged, and their probabilities averaged by length.  As input is discrete, a
filter's response is a sum over pairs of bytes, so prediction looks responses up in tables.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tidepost.llm.common import per_text, with_text_result

WINDOW = 256
# Windows that the network learns from, up to so many per labelled row; the driver holds TRAINING_WINDOWS * WINDOW characters.
TRAINING_WINDOWS, WINDOWS_PER_ROW = 6_000, 6
# Two bytes, three bytes and four bytes: prediction tables rest on these.
WIDTHS = (2, 3, 4)
FILTERS, EMBEDDING, STEPS, BATCH, RATE = 16, 8, 500, 64, 4e-3
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]").search


def in_training(doc_id: Column) -> Column:
    """True if crc32 of the id as text is not 2 modulo 4; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 != 2


def training_sample(docs: DataFrame, windows: int = TRAINING_WINDOWS) -> list[tuple[str, str]]:
    """(lang, window) of at most `windows` windows of labelled training rows, chosen by a hash of their ids.

    Stratified by language: each language is meant an equal turn of the windows; one with fewer
    rows gives all it has and the others fill the rest.  Every row of a language gives one
    window before any gives a second.  Spark cuts the windows, at places given by the hash,
    and sends only those.
    """
    candidates = docs.filter(F.col("lang").isNotNull() & in_training(F.col("doc_id")))
    # Rows per language; a first cut by the same hash leaves about twice each language's turn,
    # however large the table: tasks send no more than that to the driver.
    per_lang = candidates.groupBy(F.col("lang").cast("string").alias("lang")).agg(F.count(F.lit(1)).alias("_rows"))
    languages = max(1, per_lang.count())
    turn_each = -(-windows // languages)
    shares = per_lang.select(
        "lang", F.least(F.lit(1.0), 2.0 * turn_each / F.col("_rows")).alias("_share"),
        F.least(F.lit(WINDOWS_PER_ROW), F.ceil(2.0 * turn_each / F.col("_rows"))).cast("int").alias("_turns"),
        F.least(F.col("_rows"), F.lit(2 * turn_each)).alias("_per_turn"),
    )
    labelled = candidates.filter(F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), "doc_id"
    ).join(shares, "lang")
    spread = labelled.select("*", F.explode(F.sequence(F.lit(0), F.col("_turns") - 1)).alias("turn"))
    place = F.xxhash64("doc_id", "turn")
    early = F.shiftrightunsigned(place, 1) < F.col("_share") * F.lit(2.0**63)
    start = F.pmod(F.shiftright(place, 7), F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1) + 1
    cut = spread.filter(early).select(
        "lang", F.col("text").substr(start.cast("int"), F.lit(WINDOW)).alias("window"), "turn",
        # A window's place among its language's windows, in units of a language's turn: every
        # language gives its turn before any gives more, and each row one window before a second.
        ((F.col("turn") + F.shiftrightunsigned(place, 1) / F.lit(2.0**63) / F.col("_share")) * F.col("_per_turn") / F.lit(turn_each)).alias("key"),
    )
    chosen = cut.orderBy("key", "lang", "window").limit(windows)
    return [(r["lang"], r["window"]) for r in chosen.collect() if _LETTER(r["window"])]


def windows_of(text: str) -> np.ndarray:
    """The lower-cased UTF-8 bytes in rows of WINDOW, the last filled with zeros."""
    data = text.lower().encode()
    rows = np.zeros((max(1, -(-len(data) // WINDOW)), WINDOW), np.uint8)
    rows.reshape(-1)[: len(data)] = np.frombuffer(data, np.uint8)
    return rows


# --- training ---------------------------------------------------------------

def _forward(p: dict, x: np.ndarray):
    embedded, pooled, places = p["embed"][x], [], []
    for w in WIDTHS:
        n, length = len(x), WINDOW - w + 1
        spans = np.lib.stride_tricks.sliding_window_view(embedded, w, axis=1).transpose(0, 1, 3, 2).reshape(n * length, w * EMBEDDING)
        response = (spans @ p[f"filter{w}"]).reshape(n, length, FILTERS)
        places.append(response.argmax(1))
        pooled.append(response.max(1))
    raw = np.concatenate(pooled, 1) + p["bias"]
    hidden = np.maximum(raw, 0)
    scores = hidden @ p["out"] + p["out_bias"]
    scores = np.exp(scores - scores.max(1, keepdims=True))
    return places, raw, hidden, scores / scores.sum(1, keepdims=True)


def _gradients(p: dict, x: np.ndarray, y: np.ndarray) -> dict:
    """Of the mean cross-entropy; only the places that won the pooling pass anything back."""
    places, raw, hidden, chance = _forward(p, x)
    error = chance.copy()
    error[np.arange(len(y)), y] -= 1
    error /= len(y)
    back = (error @ p["out"].T) * (raw > 0)
    g = {"out": hidden.T @ error, "out_bias": error.sum(0), "bias": back.sum(0), "embed": np.zeros_like(p["embed"])}
    for i, w in enumerate(WIDTHS):
        own = back[:, i * FILTERS : (i + 1) * FILTERS]
        spans = x[np.arange(len(x))[:, None, None], places[i][:, :, None] + np.arange(w)]
        kernel = p[f"filter{w}"].reshape(w, EMBEDDING, FILTERS)
        g[f"filter{w}"] = np.einsum("nf,nfwd->wdf", own, p["embed"][spans]).reshape(w * EMBEDDING, FILTERS)
        np.add.at(g["embed"], spans, np.einsum("nf,wdf->nfwd", own, kernel))
    return g


def train(sample: list[tuple[str, str]], seed: int = 1) -> dict | None:
    """Parameters and language names; None without labelled text."""
    if not sample:
        return None
    rng = np.random.default_rng(seed)
    names = sorted({lang for lang, _ in sample})
    x = np.concatenate([windows_of(window)[:1] for _, window in sample])
    y = np.array([names.index(lang) for lang, _ in sample])
    shape = {"embed": (256, EMBEDDING), "bias": (len(WIDTHS) * FILTERS,), "out": (len(WIDTHS) * FILTERS, len(names)), "out_bias": (len(names),)}
    shape |= {f"filter{w}": (w * EMBEDDING, FILTERS) for w in WIDTHS}
    p = {k: (rng.normal(0, 1 / np.sqrt(s[0] if k != "embed" else 4), s) if len(s) > 1 else np.zeros(s)).astype(np.float32) for k, s in shape.items()}
    mean, square = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    order = np.concatenate([rng.permutation(len(x)) for _ in range(-(-STEPS * BATCH // len(x)))])
    for step in range(1, STEPS + 1):
        chosen = order[(step - 1) * BATCH : step * BATCH]
        own = x[chosen].copy()
        # A third of the windows are shortened, as the last window of a text is.
        short = rng.random(len(own)) < 0.33
        own[short[:, None] & (np.arange(WINDOW) >= rng.integers(12, WINDOW, len(own))[:, None])] = 0
        for k, g in _gradients(p, own, y[chosen]).items():
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.999 * square[k] + 0.001 * g * g
            p[k] = p[k] - RATE * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return {"names": names, **{k: v.astype(np.float32) for k, v in p.items()}}


# --- prediction -------------------------------------------------------------

class Predictor:
    """The trained network with its responses to each pair of bytes as a table."""

    def __init__(self, model: dict):
        self.model = model
        e, f = model["embed"], FILTERS
        kernel = {w: model[f"filter{w}"].reshape(w, EMBEDDING, f) for w in WIDTHS}
        pair = lambda k: (e @ k[0])[:, None, :] + (e @ k[1])[None, :, :]
        tables = [pair(kernel[2]), pair(kernel[3][:2]), pair(kernel[4][:2]), pair(kernel[4][2:])]
        self.pairs = np.ascontiguousarray(np.concatenate(tables, 2).reshape(65536, 4 * f))
        self.third = np.ascontiguousarray(e @ kernel[3][2])

    def chances(self, rows: np.ndarray) -> np.ndarray:
        """Probabilities of the languages for each window."""
        n, f = len(rows), FILTERS
        columns = np.ascontiguousarray(rows.T).astype(np.intp)
        best = np.full((3, n, f), -np.inf, np.float32)
        at = [np.empty((n, 4 * f), np.float32) for _ in range(3)]
        held, third = np.empty((n, f), np.float32), np.empty((n, f), np.float32)
        for t in range(WINDOW - 1):
            own = np.take(self.pairs, (columns[t] << 8) + columns[t + 1], axis=0, out=at[t % 3], mode="clip")
            np.maximum(best[0], own[:, :f], out=best[0])
            if t + 2 < WINDOW:
                np.take(self.third, columns[t + 2], axis=0, out=third, mode="clip")
                np.maximum(best[1], np.add(own[:, f : 2 * f], third, out=held), out=best[1])
            if t >= 2:
                np.maximum(best[2], np.add(at[(t - 2) % 3][:, 2 * f : 3 * f], own[:, 3 * f :], out=held), out=best[2])
        hidden = np.maximum(np.concatenate(list(best), 1) + self.model["bias"], 0)
        scores = hidden @ self.model["out"] + self.model["out_bias"]
        scores = np.exp(scores - scores.max(1, keepdims=True))
        return scores / scores.sum(1, keepdims=True)

    def predict(self, texts: list[str]) -> Iterator[tuple[str, float]]:
        """Language and score of each text; windows of many texts are judged together."""
        lettered = [text if text and _LETTER(text) else None for text in texts]
        rows = [None if text is None else windows_of(text) for text in lettered]
        stacked = [r for r in rows if r is not None]
        every = np.concatenate(stacked) if stacked else np.zeros((0, WINDOW), np.uint8)
        chances = np.concatenate([self.chances(every[i : i + 1024]) for i in range(0, len(every), 1024)]) if len(every) else every
        weights, at = (every != 0).sum(1), 0
        for own in rows:
            if own is None:
                yield UNKNOWN, 0.0
            else:
                to = at + len(own)
                mean = np.average(chances[at:to], axis=0, weights=weights[at:to])
                yield self.model["names"][int(mean.argmax())], min(1.0, float(mean.max()))
                at = to


def with_language(docs: DataFrame, model: dict | None) -> DataFrame:
    """row and language (lang_pred, score): `und` and 0 for texts that are null or have no letter, or without a model."""

    def work(texts: list[str]) -> Iterator[tuple[str, float]]:
        if model is None:
            return ((UNKNOWN, 0.0) for _ in texts)
        return Predictor(model).predict(texts)

    return with_text_result(docs, "language", per_text("lang_pred string, score double", work))


def identify_languages(docs: DataFrame, windows: int = TRAINING_WINDOWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row.

    The network learns from rows that are not held out and have a language; prediction sees
    the text alone.  Repeated rows and null doc_ids are judged like others.
    """
    model = train(training_sample(docs, windows))
    return with_language(docs.select("doc_id", "text"), model).select(
        "row.doc_id", (~in_training(F.col("row.doc_id"))).alias("held_out"), "language.lang_pred", "language.score"
    )


def kept_documents(docs: DataFrame, least_score: float = 0.4, windows: int = TRAINING_WINDOWS) -> DataFrame:
    """The rows of `docs` with a recognised language: `und` and scores below `least_score` go."""
    judged = with_language(docs, train(training_sample(docs, windows)))
    return judged.filter((F.col("language.lang_pred") != UNKNOWN) & (F.col("language.score") >= least_score)).select("row.*")
