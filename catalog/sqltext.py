"""SQL forms of the text functions, for the oracles."""

from __future__ import annotations

from tidepost.functions import patterns as P, stem as S

# Stop words of the queries; the tables hold four languages.
STOP_WORDS = (
    "de a o que e do da em um para é com não uma os no se na por mais as "
    "the of and to in is it that for on with at by la le les un une et der die das und el los en"
).split()


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(to)}, 'g')"


def casefold(x: str) -> str:
    return f"translate(replace(lower({x}), 'ß', 'ss'), 'ςſµ', 'σsμ')"


def collapse(x: str) -> str:
    return f"trim({sub(x, P.SPACES, ' ')})"


def redact(x: str) -> str:
    x = sub(sub(sub(x, P.URL, "[url]"), P.MENTION, "[mention]"), P.HASHTAG, "[hashtag]")
    return collapse(x)


def normalize(x: str) -> str:
    x = sub(sub(sub(casefold(x), P.URL, " "), P.HASHTAG_BODY, r" \1 "), P.MENTION, " ")
    return collapse(sub(x, P.NOT_WORD_OR_SPACE, " "))


def decorations(x: str) -> str:
    return sub(x, P.DECORATION, " ")


def numeric_chunks(x: str) -> str:
    return (
        f"array_to_string(list_filter(string_split_regex({x}, {lit(P.SPACES)}), "
        f"lambda c: c <> '' AND NOT regexp_matches(c, {lit(P.ONLY_DIGITS)})), ' ')"
    )


# RE2 has no look-ahead; its word boundary differs only next to a letter
# outside ASCII, where a bare domain would end.
TOKEN = P.PLAIN_SOCIAL_TOKEN


def shorten_runs(x: str, longest: int, only: str | None = None) -> str:
    """Keep at most `longest` equal characters in a row, by comparing neighbours."""
    same = " AND ".join(f"list_extract(c.chars, i) = list_extract(c.chars, i - {n})" for n in range(1, longest + 1))
    drop = f"i > {longest} AND {same}"
    if only:
        drop += f" AND regexp_matches(list_extract(c.chars, i), {lit(only)})"
    return (
        "(SELECT array_to_string(list_transform(list_filter(range(1, len(c.chars) + 1), "
        f"lambda i: NOT ({drop})), lambda i: list_extract(c.chars, i)), '') "
        f"FROM (SELECT string_split({x}, '') AS chars) c)"
    )


def tokens_of(x: str, keep: str = P.ANY_WORD) -> str:
    return (
        f"list_filter(regexp_extract_all({x}, {lit(TOKEN)}), lambda t: regexp_matches(t, {lit(keep)}))"
    )


def tokenize(x: str) -> str:
    return tokens_of(shorten_runs(x, 3, "[^a-zA-Z0-9]"))


def clean(x: str) -> str:
    return numeric_chunks(decorations(x))


def stopwords(tokens: str) -> str:
    words = ", ".join(lit(w) for w in STOP_WORDS)
    return f"list_filter({tokens}, lambda t: {casefold('t')} NOT IN ({words}))"


def bucket(x: str) -> str:
    return (
        f"CASE WHEN {x} = 0 THEN '0' WHEN {x} <= 10 THEN '1-10' WHEN {x} <= 100 THEN '11-100' "
        f"WHEN {x} <= 1000 THEN '101-1000' WHEN {x} <= 10000 THEN '1001-10000' ELSE '10000+' END"
    )


def _kept(rule: str) -> str:
    return rule.replace("$1", r"\1")


def _has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {lit(pattern)})"


def stem_ctes(source: str, key: str, tokens: str) -> str:
    """CTEs that end in `stems(key, pos, stem)`: the rules on one row per token."""
    suffix = "CASE "
    for rule in S.SUFFIX_RULES:
        stripped = sub("w", rule.pattern, _kept(rule.kept))
        if rule.guard == "amente$":
            after = sub(stripped, S.AFTER_AMENTE, r"\1")
            stripped = f"CASE WHEN {_has('w', rule.pattern)} THEN {after} ELSE w END"
        suffix += f"WHEN {_has('w', rule.guard)} THEN {stripped} "
    suffix += "ELSE w END"
    folded = casefold("token")
    word = "replace(replace({}, 'ã', 'a~'), 'õ', 'o~')".format(folded)
    return f"""
stem_tokens AS (SELECT {key} AS k, unnest({tokens}) AS token, generate_subscripts({tokens}, 1) AS pos FROM {source}),
stem_words AS (SELECT DISTINCT token, {sub(word, '([qg])ü', chr(92) + '1u')} AS w FROM stem_tokens),
stem_1 AS (SELECT token, w, {suffix} AS s FROM stem_words),
stem_2 AS (SELECT token, w, CASE WHEN s = w THEN {sub('w', S.VERB, chr(92) + '1')} ELSE s END AS s FROM stem_1),
stem_3 AS (SELECT token, CASE WHEN s = w THEN {sub('s', S.RESIDUAL, chr(92) + '1')}
  WHEN s LIKE '%ci' THEN {sub('s', S.I_AFTER_C, chr(92) + '1')} ELSE s END AS s FROM stem_2),
stem_4 AS (SELECT token, CASE WHEN {_has('s', '(?:gu|ci)[eéê]$')} THEN {sub('s', S.FINAL_UE_IE, chr(92) + '1')}
  WHEN {_has('s', '[eéê]$')} THEN {sub('s', S.FINAL_E, chr(92) + '1')}
  WHEN s LIKE '%ç' THEN {sub('s', 'ç$', 'c')} ELSE s END AS s FROM stem_3),
stems AS (SELECT k, pos, replace(replace(s, 'a~', 'ã'), 'o~', 'õ') AS stem
  FROM stem_tokens JOIN stem_4 USING (token))"""
