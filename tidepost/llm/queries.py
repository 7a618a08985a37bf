"""The registered queries of this package; each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidepost.llm import alignment, byte_bpe, fertility, fim, language, licenses, packing, pii, secret_scan, simhash, token_files, topk, url_tree
from tidepost.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORD_VOCABULARY_SIZE = 49408
WORD_END_ID = 2
PACK_END_ID = 1


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query
def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    target = scratch_path(spark, "token-files")
    token_files.write_token_files(
        table(spark, folder, "documents"), target, public_tokenizers.path("word_bpe_49k.json"), WORD_VOCABULARY_SIZE, WORD_END_ID
    )
    return token_files.read_token_files(spark, target).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return byte_bpe.round_trip(table(spark, folder, "documents"), *model).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op4_fertility(spark: SparkSession, folder: str) -> DataFrame:
    return fertility.quality_rules(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "reason"
    )


def packed(docs: DataFrame) -> DataFrame:
    pieces = packing.cut_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), PACK_END_ID)
    placed = packing.place_pieces(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return placed.select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


@query
def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"))


@query
def op3_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), k=20, every=20, scale=64)


ORACLES["op3_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(list_transform(q.x, lambda x: CAST(x AS DOUBLE)), list_transform(c.x, lambda x: CAST(x AS DOUBLE))) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query
def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), width=3, distance=2, seed=42)


# The rules that the query is given (verdict, host, path).
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


@query
def op6_url_tree(spark: SparkSession, folder: str) -> DataFrame:
    return url_tree.filter_urls(table(spark, folder, "pages"), URL_RULES).drop("purity")


def _url_sql() -> str:
    """The same steps, level by level, as common table expressions."""
    rules = sorted(URL_RULES, key=lambda r: -len(r[1]) - len(r[2]))
    fits = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN" for _, h, p in rules]
    rule = "CASE " + " ".join(f"{f} '{h}{p}'" for f, (_, h, p) in zip(fits, rules)) + " END"
    ruled = "CASE " + " ".join(f"{f} '{v}'" for f, (v, _, _) in zip(fits, rules)) + " END"
    names = [f"s{i}" for i in range(url_tree.LEVELS + 1)]
    parts = ", ".join([f"p[{i + 1}] AS s{i}" for i in range(url_tree.LEVELS)] + [f"CASE WHEN len(p) > {url_tree.LEVELS} THEN '**' END AS s{url_tree.LEVELS}"])
    steps = [
        """parsed AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages)""",
        """split AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
          regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parsed)""",
        f"judged AS (SELECT page_id, host, path, {rule} AS rule, {ruled} AS ruled FROM split)",
        f"""n0 AS (SELECT host, path, n, labelled, blocked, {parts} FROM (
          SELECT host, path, count(*) AS n, count(ruled) AS labelled, count(*) FILTER (ruled = 'block') AS blocked,
                 list_filter(string_split(path, '/'), lambda s: s <> '') AS p FROM judged GROUP BY host, path))""",
    ]
    for level in range(url_tree.LEVELS):
        above, own = ["host", *names[:level]], names[level]
        listed = ", ".join(above)
        same = lambda keys: " AND ".join(f"l.{k} IS NOT DISTINCT FROM r.{k}" for k in keys)
        steps += [
            f"c{level} AS (SELECT {listed}, {own}, sum(n) AS n, sum(labelled) AS labelled, sum(blocked) AS blocked FROM n{level} WHERE {own} IS NOT NULL GROUP BY {listed}, {own})",
            f"t{level} AS (SELECT {listed}, count(*) AS k, sum(n) AS n, sum(labelled) AS labelled, sum(blocked) AS blocked, sum(blocked) / nullif(sum(labelled), 0) AS pooled FROM c{level} GROUP BY {listed})",
            f"""f{level} AS (SELECT l.*, CASE WHEN k > {url_tree.MANY_CHILDREN} AND r.n / k < {url_tree.FEW_PAGES} THEN '*'
              WHEN k > 1 AND coalesce(abs(l.blocked / nullif(l.labelled, 0) - pooled) <= {url_tree.MERGE_Z} * sqrt(pooled * (1 - pooled) / nullif(l.labelled, 0)), true) THEN '~'
              ELSE l.{own} END AS fresh FROM c{level} l JOIN t{level} r ON {same(above)})""",
            f"""n{level + 1} AS (SELECT l.host, l.path, l.n, l.labelled, l.blocked, {', '.join('r.fresh AS ' + own if n == own else 'l.' + n for n in names)}
              FROM n{level} l LEFT JOIN f{level} r ON {same([*above, own])})""",
        ]
    w = url_tree.PRIOR_WEIGHT
    steps += [
        f"placed AS (SELECT host, path, '/' || concat_ws('/', {', '.join(names)}) AS template, labelled, blocked FROM n{url_tree.LEVELS})",
        "counts AS (SELECT host, template, sum(labelled) AS labelled, sum(blocked) AS blocked FROM placed GROUP BY 1, 2)",
        "overall AS (SELECT coalesce(sum(blocked) / nullif(sum(labelled), 0), 0) AS share FROM counts)",
        f"prior AS (SELECT template, (sum(blocked) + {w} * (SELECT share FROM overall)) / (sum(labelled) + {w}) AS prior FROM counts GROUP BY 1)",
        f"verdicts AS (SELECT host, template, (blocked + {w} * prior) / (labelled + {w}) >= {url_tree.REJECT} AS rejected FROM counts JOIN prior USING (template))",
    ]
    return "WITH " + ",\n".join(steps) + """
SELECT page_id, host, path, rule, template, coalesce(ruled, CASE WHEN rejected THEN 'block' ELSE 'allow' END) AS verdict
FROM judged JOIN placed USING (host, path) JOIN verdicts USING (host, template)"""


ORACLES["op6_url_tree"] = _url_sql()


@query
def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "row.doc_id", "secrets.n_assign", "secrets.n_access", "secrets.n_hex",
        F.sha2(F.col("secrets.base"), 256).alias("base_sha256"), "secrets.spans",
    )


@query
def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify_languages(table(spark, folder, "documents"))


@query
def op2_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"), pii.as_text(F.col("spans")).alias("spans"),
    )


@query
def op11_fim(spark: SparkSession, folder: str) -> DataFrame:
    done = fim.fill_in_middle(table(spark, folder, "documents"))
    return done.select(
        "row.doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars",
        F.sha2("fim.output", 256).alias("output_sha256"), F.sha2(fim.restore(F.col("fim.output"), F.col("fim.form")), 256).alias("restored_sha256"),
    )


ORACLES["op11_fim"] = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
s AS (
  SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n,
         ('0x' || substr(h, 1, 8))::UBIGINT AS h1, ('0x' || substr(h, 9, 8))::UBIGINT AS h2,
         ('0x' || substr(h, 17, 8))::UBIGINT AS h3, ('0x' || substr(h, 25, 8))::UBIGINT AS h4 FROM d),
c AS (
  SELECT *, CAST(least(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS lo, CAST(greatest(h1 % (n + 1), h2 % (n + 1)) AS BIGINT) AS hi,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM s),
p AS (
  SELECT *, substring(t, 1, lo) AS pre, substring(t, lo + 1, hi - lo) AS mid, substring(t, hi + 1) AS suf FROM c)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN lo END AS prefix_chars, CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


@query
def op12_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.license_scan(table(spark, folder, "documents"))
    return found.select("row.doc_id", *licenses.as_columns(F.col("license")))


@query
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_tokens(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )
