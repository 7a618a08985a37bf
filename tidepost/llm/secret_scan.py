"""Secret scan with a recursive decoding worklist.

The text is the first layer.  Each layer is scanned; then its encoded fragments (percent
escapes, Unicode and hexadecimal escapes, base64, compressed data) are decoded into further layers, which
are put on the worklist unless the same bytes were seen before.  The list runs dry at the
fixpoint: a layer only comes from a fragment of another, and a layer seen before is a cycle
or a repeat.  Every byte of a layer knows the part of the outer layer that it comes from, at
each place where the layer stands, so what is found in a layer is reported as a span of the
text for every place.
"""

from __future__ import annotations

import binascii
import bz2
import lzma
import re
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tidepost.llm.common import per_text, with_text_result

KINDS = ("assign", "access", "hex")
# The base patterns, on bytes, where case folding knows A-Z only.
_ASSIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{24,}")
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

# Encoded fragments: runs without white space that hold a percent or a backslash escape, and base64 (either alphabet) of
# LEAST_BASE64 or more characters, over single line breaks.
LEAST_BASE64 = 16
_RUNS = re.compile(rb"\S+")
_CHARACTER = rb"[A-Za-z0-9+/_-]"
_BASE64 = re.compile(
    rb"(?<!%b)(?=[A-Za-z0-9+/_\r\n-]{%d})%b+(?:\r?\n%b+)*={0,2}" % (_CHARACTER, LEAST_BASE64, _CHARACTER, _CHARACTER)
)
_PLAIN_DIGITS = bytes.maketrans(b"-_", b"+/")
# Text in decoded bytes: printable ASCII, white space, and anything above ASCII in valid UTF-8; an assignment, the
# shortest match, has 12 characters.  Then the ways in which compressed data starts.
_STRETCHES = re.compile(
    rb"(?:[\t\n\r\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]"
    rb"|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}){12,}"
)
_COMPRESSED = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00")
_ONE_PERCENT = re.compile(rb"%([0-9A-Fa-f]{2})")
_ONE_ESCAPE = re.compile(rb"\\(?:u([0-9A-Fa-f]{4})|u\{([0-9A-Fa-f]{1,6})\}|U([0-9A-Fa-f]{8})|x([0-9A-Fa-f]{2}))")
# A decompressed layer beyond this is not held; it is reported as kind `bomb` instead.
MAX_LAYER_BYTES = 64 << 20


def base_matches(data: bytes) -> Iterator[tuple[int, int, str]]:
    """start, end (bytes) and kind; leftmost without overlap per kind, too short ones dropped."""
    folded = data.lower()
    if any(word in folded for word in _WORDS):
        for m in _ASSIGN.finditer(data):
            if m.end(1) - m.start(1) >= 6:
                yield m.start(), m.end(), "assign"
    for m in _ACCESS.finditer(data):
        if m.end() - m.start() >= 20:
            yield m.start(), m.end(), "access"
    for m in _HEX.finditer(data):
        yield m.start(), m.end(), "hex"


class Layer:
    """Decoded bytes; byte i comes from text bytes `first[i]` to `last[i]` (end exclusive). None stands for the text itself."""

    def __init__(self, data: bytes, first=None, last=None):
        self.data, self.first, self.last = data, first, last

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.first is None:
            return start, end
        return int(self.first[start:end].min()), int(self.last[start:end].max())

    def child(self, data: bytes, first: np.ndarray, last: np.ndarray) -> Layer:
        """A layer whose bytes come from the given positions of this one."""
        if self.first is None:
            return Layer(data, first, last)
        return Layer(data, self.first[first], self.last[last - 1])


def _substituted(layer: Layer, start: int, end: int, pattern, decode) -> Layer:
    """The fragment with every escape replaced by the bytes that `decode` makes of it."""
    out, first, last, at = [], [], [], start
    for m in pattern.finditer(layer.data, start, end):
        out.append(layer.data[at : m.start()])
        first.extend(range(at, m.start()))
        last.extend(range(at + 1, m.start() + 1))
        piece = decode(m)
        out.append(piece)
        first.extend([m.start()] * len(piece))
        last.extend([m.end()] * len(piece))
        at = m.end()
    out.append(layer.data[at:end])
    first.extend(range(at, end))
    last.extend(range(at + 1, end + 1))
    return layer.child(b"".join(out), np.array(first, np.int64), np.array(last, np.int64))


def _escape_bytes(m: re.Match) -> bytes:
    if m[4]:
        return bytes.fromhex(m[4].decode())
    point = int(m[1] or m[2] or m[3], 16)
    return b"?" if 0xD800 <= point < 0xE000 or point > 0x10FFFF else chr(point).encode()


def decompressed(data: bytes | memoryview) -> bytes | None:
    """What gzip, zlib, bzip2 or xz data holds; None if it is neither, more than MAX_LAYER_BYTES if it is too large."""
    makers = [
        (b"\x1f\x8b", lambda: zlib.decompressobj(31)), (b"\x78", lambda: zlib.decompressobj()),
        (b"BZh", bz2.BZ2Decompressor), (b"\xfd7zXZ\x00", lzma.LZMADecompressor),
    ]
    for magic, make in makers:
        if data[: len(magic)] == magic:
            try:
                return make().decompress(data, MAX_LAYER_BYTES + 1)
            except (zlib.error, OSError, lzma.LZMAError, EOFError):
                return None
    return None


def _runs_with(escape, data: bytes) -> Iterator[re.Match]:
    return (m for m in _RUNS.finditer(data) if escape.search(data, m.start(), m.end()))


def _decoded_base64(layer: Layer, start: int, run: bytes) -> Iterator[Layer]:
    """What a run holds at each of the four alignments: text between other bytes, and compressed data from its first byte on.

    So neither characters before the encoded part (of a path, say, or of a name) nor after it matter.
    """
    body = run.translate(_PLAIN_DIGITS, b"\r\n")
    if len(body) < LEAST_BASE64:
        return
    at = start + np.flatnonzero(~np.isin(np.frombuffer(run, np.uint8), (10, 13)))
    for shift in range(4):
        # One character over carries no byte; padding is restored.
        length = len(body) - shift - ((len(body) - shift) % 4 == 1)
        raw = binascii.a2b_base64(body[shift : shift + length] + b"=" * (-length % 4))
        pieces = [m.span() for m in _STRETCHES.finditer(raw)]
        pieces += [(m.start(), len(raw)) for m in _COMPRESSED.finditer(raw) if decompressed(memoryview(raw)[m.start() :]) is not None]
        for a, b in pieces:
            i = np.arange(a, b)
            yield layer.child(raw[a:b], at[shift + i * 8 // 6], at[shift + (i * 8 + 7) // 6] + 1)


def fragments(layer: Layer) -> Iterator[Layer]:
    """One layer for each encoded fragment of `layer` that decodes to text or compressed data."""
    data = layer.data
    if b"%" in data:
        for m in _runs_with(_ONE_PERCENT, data):
            yield _substituted(layer, m.start(), m.end(), _ONE_PERCENT, lambda e: bytes.fromhex(e[1].decode()))
    if b"\\" in data:
        for m in _runs_with(_ONE_ESCAPE, data):
            yield _substituted(layer, m.start(), m.end(), _ONE_ESCAPE, _escape_bytes)
    for m in _BASE64.finditer(data):
        yield from _decoded_base64(layer, m.start(), m[0].rstrip(b"="))
    if (plain := decompressed(data)) is not None:
        first, last = layer.origin(0, len(data))
        yield Layer(plain, np.full(len(plain), first), np.full(len(plain), last)) if len(plain) <= MAX_LAYER_BYTES else Layer(b"", np.array([first]), np.array([last]))


def scan(data: bytes) -> tuple[list[tuple[int, int, str]], set[tuple[int, int, str]]]:
    """Base matches of the text and all matches of decoded layers, as byte spans of the text."""
    base = list(base_matches(data))
    # Each distinct layer is scanned and decoded once; `places` has all fragments that decode to it, with their outer layer.
    places: dict[bytes, list[tuple[bytes, Layer]]] = {data: []}
    found: dict[bytes, set[tuple[int, int, str]]] = {data: set()}
    news, worklist = [(data, match) for match in base], [data]
    while worklist:
        outer = worklist.pop()
        for inner in fragments(Layer(outer)):
            if not inner.data:
                if len(inner.first):
                    news.append((outer, (int(inner.first[0]), int(inner.last[0]), "bomb")))
                continue
            if inner.data not in places:
                places[inner.data], found[inner.data] = [], set()
                worklist.append(inner.data)
                news.extend((inner.data, match) for match in base_matches(inner.data))
            places[inner.data].append((outer, inner))
    # A match goes to every place of its layer, once per span, so cycles of layers end.
    while news:
        layer, match = news.pop()
        if match not in found[layer]:
            found[layer].add(match)
            start, end, kind = match
            news.extend((outer, (*inner.origin(start, end), kind)) for outer, inner in places[layer])
    # A match that is the same text without any decoding adds nothing.
    return base, found[data] - set(base)


def _in_characters(data: bytes, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Byte positions as code points."""
    if data.isascii() or not spans:
        return spans
    places = sorted({p for span in spans for p in span[:2]})
    counted, at, characters = {}, 0, 0
    for place in places:
        piece = data[at:place]
        characters += len(piece) - int((np.frombuffer(piece, np.uint8) & 0xC0 == 0x80).sum())
        counted[place], at = characters, place
    return [(counted[a], counted[b], kind) for a, b, kind in spans]


_ORDER = {kind: i for i, kind in enumerate((*KINDS, "bomb"))}
_FOUND = "n_assign long, n_access long, n_hex long, base string, spans string, starts array<long>, ends array<long>"


def _joined(spans: list[tuple[int, int, str]]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], _ORDER[s[2]], s[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


def _scan_texts(texts: list[str]) -> Iterator[tuple]:
    for text in texts:
        data = text.encode()
        base, found = scan(data)
        every = _in_characters(data, [*base, *found])
        base, counts = every[: len(base)], [sum(k == kind for _, _, k in base) for kind in KINDS]
        merged = []
        for start, end, _ in sorted(every):
            if merged and start <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([start, end])
        yield (*counts, _joined(base), _joined(every), [s for s, _ in merged], [e for _, e in merged])


def find_secrets(docs: DataFrame) -> DataFrame:
    """row and secrets: counts of base matches by kind, base and all spans as text, and merged intervals.

    Spans count code points, ends exclusive, ordered by start and kind.  Row by row, no
    shuffle: null texts count as empty, repeated rows and null ids stay.
    """
    return with_text_result(docs, "secrets", per_text(_FOUND, _scan_texts))


def redacted(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """`docs` with each found interval of `text` replaced by `mark`; texts without one stay as they are, null included.

    A column n_chars, if there is one, follows the new text.
    """
    found = find_secrets(docs)
    parts = F.expr(
        "concat_ws('', transform(sequence(0, size(secrets.starts)), i -> concat("
        f"if(i = 0, '', '{mark}'), "
        "substring(row.text, if(i = 0, 1, element_at(secrets.ends, greatest(i, 1)) + 1), "
        "greatest(0, if(i = size(secrets.starts), length(row.text), element_at(secrets.starts, least(i + 1, size(secrets.starts)))) "
        "- if(i = 0, 0, element_at(secrets.ends, greatest(i, 1))))))))"
    )
    hit = F.size("secrets.starts") > 0
    changed = {"text": F.when(hit, parts).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(hit, F.length(parts).cast(kind)).otherwise(F.col("row.n_chars"))
    return found.select(*[changed[c].alias(c) if c in changed else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
