"""Column functions over text; all stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, functions as F

from tidepost.functions import patterns as P

# Keywords of the recovery-term flag.
RECOVERY_TERMS = ("recovery", "edrecovery", "recuper", "treatment", "tratamento")

_JOINER = "\x01"


def text_or_empty(c: Column) -> Column:
    """Null becomes the empty text, anything else its text form."""
    return F.coalesce(c.cast("string"), F.lit(""))


def truncate_date(c: Column) -> Column:
    """The first ten characters, unparsed."""
    return F.substring(text_or_empty(c), 1, 10)


def split_pipe(c: Column) -> Column:
    """Parts of a `|`-joined text without the empty ones."""
    return F.filter(F.split(text_or_empty(c), r"\|"), lambda part: part != "")


def collapse_spaces(c: Column) -> Column:
    """One blank for every run of space characters, none at the ends."""
    return F.btrim(F.regexp_replace(c, P.FAST_SPACES, " "))


def redact_text(c: Column) -> Column:
    """Replace links, mentions and hashtags by placeholders, in this order."""
    for pattern, placeholder in [
        (P.URL, "[url]"), (P.MENTION, "[mention]"), (P.HASHTAG, "[hashtag]"),
    ]:
        c = F.regexp_replace(c, pattern, placeholder)
    return collapse_spaces(c)


def contains_recovery_term(c: Column, terms: Iterable[str] = RECOVERY_TERMS) -> Column:
    """True if the lower-cased text contains any of the terms."""
    lowered = F.lower(c)
    found = F.lit(False)
    for term in terms:
        found = found | lowered.contains(term)
    return found


def casefold(c: Column) -> Column:
    """Lower case with the foldings that plain lower-casing leaves out."""
    c = F.lower(c)
    # Replacing looks for bytes; translating would build a string for each character.
    for old, new in [("ß", "ss"), ("ς", "σ"), ("ſ", "s"), ("µ", "μ")]:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def over_tokens(tokens: Column, function) -> Column:
    """`function` of every token, for functions of characters that never look past U+0001.

    The tokens are joined by that character, changed at once and split again; a call for each
    token costs several times as much.  Arrays with nulls or with that character go one by one.
    """
    one_by_one = F.array_join(tokens, "", _JOINER).contains(_JOINER) | (F.size(tokens) == 0)
    at_once = F.split(function(F.array_join(tokens, _JOINER)), _JOINER)
    return F.when(one_by_one, F.transform(tokens, function)).otherwise(at_once)


def remove_decorations(c: Column) -> Column:
    """One blank for every character outside letters, digits, basic punctuation and emoji."""
    return F.regexp_replace(c, P.DECORATION, " ")


def remove_urls(c: Column) -> Column:
    return F.regexp_replace(c, P.URL, " ")


def remove_numeric_chunks(c: Column) -> Column:
    """Drop the whitespace-separated chunks that are digits only."""
    return collapse_spaces(F.regexp_replace(c, P.DIGIT_CHUNK, ""))


def tokenize_post(c: Column) -> Column:
    """Social-text tokens in order, case kept; tokens without a word character are dropped."""
    shortened = F.regexp_replace(c, P.LONG_NON_ALNUM_RUN, "$1$1$1")
    tokens = F.regexp_extract_all(shortened, F.lit(P.SOCIAL_TOKEN), F.lit(0))
    return F.filter(tokens, lambda token: token.rlike(P.ANY_WORD))


def tokenize_w2v(c: Column) -> Column:
    """Lower-cased social-text tokens with runs cut to three; only tokens with a letter."""
    shortened = F.regexp_replace(F.lower(c), P.LONG_RUN, "$1$1$1")
    tokens = F.regexp_extract_all(shortened, F.lit(P.SOCIAL_TOKEN), F.lit(0))
    return F.filter(tokens, lambda token: token.rlike(r"\p{L}"))


def default_stop_words(language: str = "portuguese") -> list[str]:
    """The stop words Spark ships for a language."""
    return StopWordsRemover.loadDefaultStopWords(language)


def remove_stopwords(tokens: Column, stop_words: Iterable[str]) -> Column:
    """Drop the tokens whose folded form is a stop word; the rest keep their case."""
    words = sorted(set(stop_words))
    if not words:
        return tokens
    return F.filter(tokens, lambda token: ~casefold(token).isin(words))


def normalize_text(c: Column) -> Column:
    """Folded text without links and mentions, hashtags as words, no punctuation."""
    c = F.regexp_replace(casefold(c), P.URL, " ")
    c = F.regexp_replace(c, P.HASHTAG_BODY, " $1 ")
    c = F.regexp_replace(c, P.MENTION, " ")
    c = F.regexp_replace(c, P.NOT_WORD_OR_SPACE, " ")
    return collapse_spaces(c)


def encoder_input(text: Column, hashtags: Column) -> Column:
    """Text followed by its trimmed hashtags; unchanged if there are none."""
    text = text_or_empty(text)
    tags = F.filter(
        F.transform(split_pipe(hashtags), lambda tag: F.regexp_replace(tag, P.EDGE_SPACES, "")),
        lambda tag: tag != "",
    )
    joined = F.concat(text, F.lit(" "), F.array_join(tags, " "))
    return F.when(F.size(tags) > 0, F.regexp_replace(joined, P.EDGE_SPACES, "")).otherwise(text)


def snippet(c: Column, length: int, mark_cut: bool = False) -> Column:
    """The first characters on one line, optionally with `...` after a cut."""
    cut = F.substring(F.translate(c, "\n", " "), 1, length)
    if not mark_cut:
        return cut
    return F.concat(cut, F.when(F.length(c) > length, F.lit("...")).otherwise(F.lit("")))


def bucketize_metric(c: Column) -> Column:
    """Size class of a count; what cannot be read as a whole number counts as zero."""
    number = F.coalesce(c.try_cast("bigint"), F.lit(0))
    return (
        F.when(number == 0, "0")
        .when(number <= 10, "1-10")
        .when(number <= 100, "11-100")
        .when(number <= 1000, "101-1000")
        .when(number <= 10000, "1001-10000")
        .otherwise("10000+")
    )


def feature_tokens(c: Column) -> Column:
    """Runs of at least two word characters, case kept."""
    return F.regexp_extract_all(c, F.lit(P.FEATURE_TOKEN), F.lit(0))
