import re

import pytest

from tests.llm.conftest import rows_of
from tidepost.llm import licenses, queries

NAMES = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(UPPER))


def places(words, table):
    return [(i, i + len(p.split()) - 1, label) for p, label in table.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]


def descend(tokens):
    """Recursive descent, the other way to the same value: or < and < with."""
    at = [0]

    def peek():
        return tokens[at[0]].lower() if at[0] < len(tokens) else None

    def take():
        at[0] += 1
        return tokens[at[0] - 1]

    def atom():
        token = take()
        if token == "(":
            inner = disjunction()
            if take() != ")":
                raise ValueError
            return inner
        if token.lower() in ("and", "or", "with", ")"):
            raise ValueError
        name = token.lower().rstrip(".")
        result = (licenses.value(name), {name})
        if peek() == "with":
            take()
            exception = take()
            if exception in ("(", ")") or exception.lower() in ("and", "or", "with"):
                raise ValueError
            result = (max(result[0], licenses.EXCEPTION_FLOOR), result[1] | {exception.lower().rstrip(".")})
        return result

    def conjunction():
        value, labels = atom()
        while peek() == "and":
            take()
            v, l = atom()
            value, labels = min(value, v), labels | l
        return value, labels

    def disjunction():
        value, labels = conjunction()
        while peek() == "or":
            take()
            v, l = conjunction()
            value, labels = max(value, v), labels | l
        return value, labels

    try:
        result = disjunction()
    except (ValueError, IndexError):
        return None
    return result if at[0] == len(tokens) else None


def brute(text):
    words = words_of(text)
    base = places(words, licenses.BASE)
    notices = places(words, licenses.NOTICES)
    labels, values = {p[2] for p in base} | {p[2] for p in notices}, []
    for first, last, _ in places(words, {licenses.TAG: "tag"}):
        spans = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(UPPER))]
        tokens = licenses.expression_after(text, spans[last][1])
        result = descend(tokens) if tokens else None
        if result:
            values.append(result[0])
            labels |= result[1]
    if not values:
        named = base + notices
        values = [licenses.value(l) for f, e, l in named if not any(g <= f and e <= m and (g, m) != (f, e) for g, m, _ in named)]
    return (
        len(words), len(base), min((p[0] for p in base), default=None), max((p[0] for p in base), default=None),
        ",".join(sorted({p[2] for p in base})), ",".join(sorted(labels)), float(min(values)) if values else 0.0,
    )


CASES = [
    "Released under the MIT License.",
    "CC BY-NC 4.0 and cc by cc by",
    "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0 WITH Classpath-exception-2.0 */ trailing",
    "SPDX-License-Identifier: (MIT\nnext line",
    "SPDX-License-Identifier: MIT OR\n",
    "SPDX-License-Identifier: GPL-3.0-or-later\nSPDX-License-Identifier: MIT",
    "GNU Lesser General Public License, all rights reserved",
    "Licensed under the Apache License, Version 2.0.",
    "Permission is hereby granted, free of charge, to any person",
    "ＣＣ BY ünï cc by",
    "all rights reserved all rights reserved",
    "",
]


def test_scan_against_brute_force():
    machine = licenses.automaton()
    for text in CASES:
        assert licenses.scan(text, machine)[:7] == brute(text), text


def test_shunting_yard_order_and_refusals():
    assert licenses.postfix("a OR b AND c WITH e".split()) == ["a", "b", "c", "e", "with", "and", "or"]
    assert licenses.postfix(["(", "a", "OR", "b", ")", "AND", "c"]) == ["a", "b", "or", "c", "and"]
    assert licenses.postfix(["(", "a"]) is None and licenses.postfix(["a", ")"]) is None
    assert licenses.evaluate(["a", "or"]) is None and licenses.evaluate(["a", "b"]) is None
    assert licenses.evaluate(["mit", "gpl-2.0", "and"]) == (0.3, {"mit", "gpl-2.0"})
    assert licenses.evaluate(["mit", "gpl-2.0", "or"]) == (1.0, {"mit", "gpl-2.0"})


def test_query_rows_against_brute_force(spark, awkward, no_rows, tables):
    got = licenses.license_scan(awkward).select("row.doc_id", "row.text", *licenses.as_columns(licenses.F.col("license"))).collect()
    assert len(got) == awkward.count()
    for r in got:
        assert tuple(r[n] for n in NAMES) == brute(r["text"] or "")
    assert licenses.license_scan(no_rows).count() == 0
    rows = queries.op12_licenses(spark, tables).collect()
    texts = dict(rows_of(spark.read.parquet(f"{tables}/documents.parquet")))
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[n] for n in NAMES) == brute(texts[r["doc_id"]])
    assert any(r["labels"] for r in rows)


@pytest.mark.parametrize("text", ["cc by " * 20_000, "x" * 200_000])
def test_long_texts(text):
    found = licenses.scan(text, licenses.automaton())
    assert found[:7] == brute(text)
