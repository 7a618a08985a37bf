"""Licence scans: phrases by Aho-Corasick over words, licence expressions by shunting-yard.

Words are the runs of digits, lower-case letters and non-ASCII characters left when A-Z are
lower-cased.  One Aho-Corasick automaton holds every phrase as its words joined and framed by
single spaces, so that a match starts and ends at word edges; it runs once over the text's
words joined the same way and reports every place, overlapping ones included.  Phrases are of
three kinds: the base phrases, notice phrases of known licences, and the identifier tag
`spdx license identifier`.  After a tag the rest of its line is a licence expression (ids, AND,
OR, WITH, parentheses); the shunting-yard algorithm turns it into postfix order and a stack
evaluates it: OR takes the better choice, AND the worse obligation, WITH an exception lifts its
licence to EXCEPTION_FLOOR.

score: how freely a document may be reused, 0 to 1.  The evaluated expressions decide where
there are any (all of them hold: the least); else the phrases found, leaving out those inside a
longer phrase found at the same place (all hold: the least); nothing found or all rights
reserved: 0.

Defined results:
- a null text is the empty text: no words, no places, null first and last word, score 0;
- very long texts are scanned whole, in time linear in their length and the places found;
- an expression that does not parse (unbalanced parentheses, an operator without operands) is
  left out; its tag's phrase still counts as a place of the tag;
- ids outside the table of families keep their own name as label and UNKNOWN as value;
- repeated rows give equal results; the input's columns stay inside the struct `row`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidepost.llm.common import text_or_empty, worker_memo

# Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Notice phrases of known licences and their labels.
NOTICES = {
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "isc license": "isc",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "apache license": "apache",
    "apache license version 2 0": "apache-2.0",
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    "public domain": "public-domain",
    "unlicense": "unlicense",
}
TAG = "spdx license identifier"
# How freely a licence family allows reuse; an id takes its longest family prefix.
FAMILIES = {
    "mit": 1.0, "isc": 1.0, "bsd": 1.0, "apache": 1.0, "unlicense": 1.0, "cc0": 1.0, "public-domain": 1.0, "zlib": 1.0,
    "cc-by": 0.9, "mpl": 0.6, "lgpl": 0.6, "epl": 0.6, "cc-by-sa": 0.5, "gpl": 0.3, "agpl": 0.2,
    "cc-by-nc": 0.1, "cc-by-nd": 0.1, "cc-by-nc-sa": 0.1, "cc-by-nc-nd": 0.1, "reserved": 0.0,
}
UNKNOWN, EXCEPTION_FLOOR = 0.5, 0.6
# Operators of licence expressions by precedence.
PRECEDENCE = {"with": 3, "and": 2, "or": 1}

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_TOKEN = re.compile(r"[\x20\t]*(\(|\)|[A-Za-z0-9.+-]+)")
_LEAD = re.compile(r"[\x20\t:]*")

RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "expressions array<string>"
)


def value(label: str) -> float:
    """Reuse value of a licence id or label: that of its longest family prefix."""
    best = None
    for family in FAMILIES:
        if (label == family or label.startswith(family + "-") or label.startswith(family + ".")) and (best is None or len(family) > len(best)):
            best = family
    return UNKNOWN if best is None else FAMILIES[best]


def postfix(tokens: list[str]) -> list[str] | None:
    """Shunting-yard: tokens of an expression in postfix order, or None if parentheses do not pair."""
    out, stack = [], []
    for token in tokens:
        word = token.lower()
        if word in PRECEDENCE:
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[word]:
                out.append(stack.pop())
            stack.append(word)
        elif token == "(":
            stack.append(token)
        elif token == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        else:
            out.append(token)
    while stack:
        if stack[-1] == "(":
            return None
        out.append(stack.pop())
    return out


def evaluate(order: list[str]) -> tuple[float, set[str]] | None:
    """Value and labels of a postfix expression; None if an operator lacks operands or operands are left."""
    stack: list[tuple[float, set[str], bool]] = []
    for token in order:
        if token in PRECEDENCE:
            if len(stack) < 2:
                return None
            (rv, rl, rid), (lv, ll, _) = stack.pop(), stack.pop()
            if token == "with":
                if not rid:
                    return None
                stack.append((max(lv, EXCEPTION_FLOOR), ll | rl, False))
            else:
                stack.append(((max if token == "or" else min)(lv, rv), ll | rl, False))
        else:
            name = token.lower().rstrip(".")
            stack.append((value(name), {name}, True))
    if len(stack) != 1:
        return None
    return stack[0][0], stack[0][1]


def expression_after(text: str, at: int) -> list[str]:
    """Tokens of the expression that begins at `at`: up to the line's end or the first other character."""
    end = text.find("\n", at)
    line = text[at : len(text) if end < 0 else end]
    tokens, place = [], _LEAD.match(line).end()
    while (m := _TOKEN.match(line, place)) is not None:
        tokens.append(m[1])
        place = m.end()
    return tokens


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    phrases: dict[str, list[tuple[str, str]]] = {}
    for kind, table in (("base", BASE), ("notice", NOTICES), ("tag", {TAG: "tag"})):
        for phrase, label in table.items():
            phrases.setdefault(phrase, []).append((kind, label))
    for phrase, meanings in phrases.items():
        found.add_word(f" {phrase} ", (len(phrase) + 2, len(phrase.split()), meanings))
    found.make_automaton()
    return found


def scan(text: str, machine: ahocorasick.Automaton) -> tuple:
    """The result of one text (see RESULT)."""
    lowered = text.translate(_UPPER)
    spans = [(m.start(), m.end()) for m in _WORDS.finditer(lowered)]
    words = [lowered[s:e] for s, e in spans]
    joined = " " + " ".join(words) + " "
    # Where each word begins in `joined`.
    starts = np.cumsum([1] + [len(w) + 1 for w in words[:-1]]) if words else np.zeros(0, dtype=np.int64)
    places = []
    for end, (chars, length, meanings) in machine.iter(joined) if words else ():
        # The match begins with the space before its first word.
        first = int(np.searchsorted(starts, end - chars + 2))
        places.extend((first, first + length - 1, kind, label) for kind, label in meanings)
    base = [p for p in places if p[2] == "base"]
    base_labels = sorted({p[3] for p in base})
    labels, values, expressions = set(base_labels), [], []
    for first, last, kind, label in places:
        if kind == "tag":
            tokens = expression_after(text, spans[last][1])
            order = postfix(tokens) if tokens else None
            result = evaluate(order) if order else None
            if result is not None:
                values.append(result[0])
                labels |= result[1]
                expressions.append(" ".join(tokens))
        elif kind == "notice":
            labels.add(label)
    if not expressions:
        named = [(f, l, lab) for f, l, kind, lab in places if kind != "tag"]
        inner = {(f, l) for f, l, _ in named for g, m, _ in named if g <= f and l <= m and (g, m) != (f, l)}
        values = [value(lab) for f, l, lab in named if (f, l) not in inner]
    return (
        len(words), len(base), min((p[0] for p in base), default=None), max((p[0] for p in base), default=None),
        ",".join(base_labels), ",".join(sorted(labels)), float(min(values)) if values else 0.0, expressions,
    )


def license_scan(docs: DataFrame) -> DataFrame:
    """`row`, the input row, and `license` (see RESULT)."""
    names = [field.split()[0] for field in RESULT.split(", ")]

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = worker_memo(("licenses",), automaton)
        for texts in batches:
            yield pd.DataFrame([scan(t, machine) for t in texts], columns=names)

    found = F.pandas_udf(run, RESULT)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("row"), found(text_or_empty()).alias("license"))


def as_columns(found: Column) -> list[Column]:
    return [found[name.split()[0]].alias(name.split()[0]) for name in RESULT.split(", ")]
