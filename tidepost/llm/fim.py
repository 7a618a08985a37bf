"""Fill-in-the-middle: each text cut into prefix, middle and suffix and written with sentinels.

Method: repeated-capture matching.  One `fullmatch` of `(unit)*` with the `regex` library keeps
every repetition of its group, so `match.ends(1)` lists where each unit ends: its length is the
number of units n, and its items at the two cut points are the character offsets of the cuts,
with no loop over the text.  Spark does the rest in column expressions: the seeds of a row, the
form, the output and the text restored from the output.

Defined results:
- a null text is the empty text; an empty text has n = 0 and is written plain;
- a text that holds a sentinel is written plain (it could not be restored otherwise);
- a null key seeds the cut with the decimal of nothing, so `1:` alone is hashed;
- a text that the units do not cover from start to end (only possible with a unit of one's own)
  is written plain with n null; the default unit, one code point, covers every text;
- very long texts are matched whole; the list of unit ends is as long as the text and is freed
  with the row;
- repeated rows give equal results, rows with equal texts but other keys their own cuts;
- the input's columns stay apart from the operator's inside the struct `row`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F

from tidepost.llm.common import text_or_empty, worker_memo

# The sentinels of prefix, suffix and middle, in that order.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# One code point, any code point.
CODE_POINT = r"."
# Shares in percent: rows whose third seed falls at or above PLAIN_FROM stay plain; of the
# others, those whose fourth seed falls below SPM_BELOW are written suffix first.
PLAIN_FROM, SPM_BELOW = 90, 20
SALT = "1"
# Length that reaches past the end of any string.
REST = 2**31 - 1


def seeds(key: Column, salt: str = SALT) -> list[Column]:
    """h1 to h4: the first four groups of 8 hex digits of sha256(`salt:key`), as unsigned integers."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def unit_ends(text: str, matcher) -> list[int] | None:
    """Character offsets where the units of `text` end; None if they do not cover the text."""
    match = matcher(text)
    return None if match is None else match.ends(1)


def _cut(unit: str):
    matcher = worker_memo(("fim", unit), lambda: regex.compile(f"({unit})*", regex.DOTALL | regex.V0).fullmatch)

    def cut(texts: pd.Series, first: pd.Series, second: pd.Series) -> pd.DataFrame:
        out = []
        for text, h1, h2 in zip(texts, first, second):
            ends = unit_ends(text, matcher)
            if ends is None:
                out.append((None, 0, 0))
                continue
            n = len(ends)
            lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
            out.append((n, ends[lo - 1] if lo else 0, ends[hi - 1] if hi else 0))
            del ends
        return pd.DataFrame(out, columns=["n", "lo", "hi"])

    return cut


def cuts(text: Column, h1: Column, h2: Column, unit: str = CODE_POINT) -> Column:
    """struct<n, lo, hi>: number of units and the two cut offsets in characters."""
    work = _cut(unit)

    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, first, second in batches:
            yield work(texts, first, second)

    return F.pandas_udf(run, "n long, lo long, hi long")(text, h1, h2)


def fill_in_middle(docs: DataFrame, key: str = "doc_id", unit: str = CODE_POINT, salt: str = SALT,
                   plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """`row`, the input row, and `fim` struct<n, form, prefix_chars, middle_chars, output>.

    form is plain, psm (`<P>`prefix`<S>`suffix`<M>`middle) or spm (`<S>`suffix`<P>`prefix`<M>`middle);
    prefix_chars and middle_chars count code points and are null when plain.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    h1, h2, h3, h4 = seeds(F.col(f"`{key}`"), salt)
    text = text_or_empty()
    staged = docs.select(row.alias("row"), text.alias("text"), h3.alias("h3"), h4.alias("h4"), cuts(text, h1, h2, unit).alias("cut"))
    marked = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    form = (
        F.when((F.col("text") == "") | marked | F.col("cut.n").isNull() | (F.col("h3") % 100 >= plain_from), "plain")
        .when(F.col("h4") % 100 < spm_below, "spm")
        .otherwise("psm")
    )
    lo, hi = F.col("cut.lo"), F.col("cut.hi")
    prefix, middle, suffix = (F.substring(F.col("text"), F.lit(1), lo), F.substring(F.col("text"), lo + 1, hi - lo),
                              F.substring(F.col("text"), hi + 1, F.lit(REST)))
    placed = staged.withColumn("form", form)
    output = (
        F.when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .otherwise(F.col("text"))
    )
    plain = F.col("form") == "plain"
    fim = F.struct(
        F.col("cut.n").alias("n"), F.col("form"),
        F.when(~plain, lo).alias("prefix_chars"), F.when(~plain, hi - lo).alias("middle_chars"), output.alias("output"),
    )
    return placed.select("row", fim.alias("fim"))


def restore(output: Column, form: Column) -> Column:
    """The text that `output` of `form` was made from: prefix, middle and suffix in their order.

    The text holds no sentinel, so the first of each in the output is the operator's own.
    """
    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substring(output, len(first) + 1, REST)
        one, rest = F.substring_index(body, second, 1), F.substring_index(body, second, -1)
        return one, F.substring_index(rest, MIDDLE, 1), F.substring_index(rest, MIDDLE, -1)

    p1, s1, m1 = parts(PREFIX, SUFFIX)
    s2, p2, m2 = parts(SUFFIX, PREFIX)
    return F.when(form == "psm", F.concat(p1, m1, s1)).when(form == "spm", F.concat(p2, m2, s2)).otherwise(output)
