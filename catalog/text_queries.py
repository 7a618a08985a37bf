"""Scalar text functions, anonymization and text preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sqltext as Q
from catalog.base import POSTS_SQL, cores, posts, query, table
from tidepost import schemas
from tidepost.functions import text as T, vectors as V
from tidepost.functions import stem as S
from tidepost.operators.anonymize import anonymize_posts
from tidepost.operators.clean import clean_corpus
from tidepost.operators.row_ids import short_ids

_WITH_POSTS = f"WITH {POSTS_SQL} "


@query("text_or_empty", """
SELECT doc_id, coalesce(nullif(lang, 'fr'), '') AS lang_text, CAST(n_chars AS VARCHAR) AS chars_text FROM documents""")
def text_or_empty(spark, folder):
    d = table(spark, folder, "documents")
    return d.select(
        "doc_id", T.text_or_empty(F.nullif("lang", F.lit("fr"))).alias("lang_text"),
        T.text_or_empty(F.col("n_chars")).alias("chars_text"),
    )


@query("truncate_date", """
SELECT event_id, CASE WHEN event_type = 'view' THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS day,
       strftime(ts, '%a %b %d') AS loose
FROM events""")
def truncate_date(spark, folder):
    e = table(spark, folder, "events")
    iso = F.when(F.col("event_type") != "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return e.select(
        "event_id", T.truncate_date(iso).alias("day"),
        T.truncate_date(F.date_format("ts", "EEE MMM dd HH:mm:ss")).alias("loose"),
    )


@query("split_pipe", _WITH_POSTS + """
SELECT row_id, array_to_string(parts, '/') AS parts, CAST(len(parts) AS INTEGER) AS n
FROM (SELECT row_id, list_filter(string_split(hashtags, '|'), lambda p: p <> '') AS parts FROM posts)""")
def split_pipe(spark, folder):
    parts = posts(spark, folder).select("row_id", T.split_pipe(F.col("hashtags")).alias("p"))
    return parts.select("row_id", F.array_join("p", "/").alias("parts"), F.size("p").alias("n"))


@query("redact_text", _WITH_POSTS + f"""
SELECT row_id, {Q.redact('text')} AS redacted FROM posts
UNION ALL SELECT -1 - page_id, {Q.redact("url || ' ' || html")} FROM pages""")
def redact_text(spark, folder):
    p = posts(spark, folder).select("row_id", T.redact_text(F.col("text")).alias("redacted"))
    html = table(spark, folder, "pages").select(
        (-1 - F.col("page_id")).alias("row_id"), T.redact_text(F.concat_ws(" ", "url", "html")).alias("redacted")
    )
    return p.unionByName(html)


@query("bucketize_metric", f"""
SELECT l_orderkey, l_linenumber, {Q.bucket('trunc(l_extendedprice)')} AS price_bucket,
       {Q.bucket('trunc(l_quantity - 25)')} AS signed_bucket,
       CASE WHEN l_returnflag = 'R' THEN '0' ELSE {Q.bucket('l_partkey')} END AS text_bucket
FROM lineitem""")
def bucketize_metric(spark, folder):
    li = table(spark, folder, "lineitem")
    text = F.when(F.col("l_returnflag") == "R", "1.5").otherwise(F.col("l_partkey").cast("string"))
    return li.select(
        "l_orderkey", "l_linenumber",
        T.bucketize_metric(F.col("l_extendedprice").cast("double")).alias("price_bucket"),
        T.bucketize_metric(F.col("l_quantity").cast("double") - 25).alias("signed_bucket"),
        T.bucketize_metric(text).alias("text_bucket"),
    )


@query("contains_recovery_term", """
SELECT doc_id, lower(text || CASE WHEN doc_id % 6 = 0 THEN ' Recuperação' ELSE '' END) LIKE '%recuper%' AS recovery,
       lower(text) LIKE '%tion%' OR lower(text) LIKE '%réai%' AS custom
FROM documents""")
def contains_recovery_term(spark, folder):
    d = table(spark, folder, "documents")
    more = F.when(F.col("doc_id") % 6 == 0, " Recuperação").otherwise("")
    return d.select(
        "doc_id", T.contains_recovery_term(F.concat("text", more)).alias("recovery"),
        T.contains_recovery_term(F.col("text"), ("tion", "réai")).alias("custom"),
    )


_ODD = " ☆．。．:*･ﾟ x_y 🙂 a:b/c «d» œ"


@query("remove_decorations", f"""
SELECT doc_id, {Q.decorations("text || " + Q.lit(_ODD))} AS cleaned FROM documents""")
def remove_decorations(spark, folder):
    d = table(spark, folder, "documents")
    return d.select("doc_id", T.remove_decorations(F.concat("text", F.lit(_ODD))).alias("cleaned"))


@query("remove_numeric_chunks", f"""
SELECT doc_id, {Q.numeric_chunks("text || ' 16 a 17, 3kg' || chr(160) || '42 x'")} AS cleaned FROM documents""")
def remove_numeric_chunks(spark, folder):
    d = table(spark, folder, "documents")
    return d.select(
        "doc_id", T.remove_numeric_chunks(F.concat("text", F.lit(" 16 a 17, 3kg 42 x"))).alias("cleaned")
    )


_MORE = " não-sei d'água fim.Agora ana.b@mail.ex.com 3,5kg #tag-x 8d 555-1234 éééééé"


@query("tokenize_post", _WITH_POSTS + f"""
SELECT row_id, array_to_string({Q.tokenize('c')}, ' ') AS tokens
FROM (SELECT row_id, {Q.decorations("text || " + Q.lit(_MORE))} AS c FROM posts)""")
def tokenize_post(spark, folder):
    p = posts(spark, folder)
    text = T.remove_decorations(F.concat("text", F.lit(_MORE)))
    return p.select("row_id", F.array_join(T.tokenize_post(text), " ").alias("tokens"))


@query("remove_stopwords", _WITH_POSTS + f"""
SELECT row_id, array_to_string({Q.stopwords('t')}, ' ') AS kept FROM (SELECT row_id, {Q.tokenize('text')} AS t FROM posts)""")
def remove_stopwords(spark, folder):
    p = posts(spark, folder).select("row_id", T.tokenize_post(F.col("text")).alias("t"))
    return p.select("row_id", F.array_join(T.remove_stopwords(F.col("t"), Q.STOP_WORDS), " ").alias("kept"))


_PORTUGUESE = (
    " emagrecimento rapidamente felicidades criativas psicologia revolução inteligência primeiras"
    " cantávamos pegue almoço linguiça corações possivelmente distúrbios"
)


@query("stem_tokens", f"""
WITH words AS (SELECT doc_id, regexp_extract_all(text || {Q.lit(_PORTUGUESE)}, {Q.lit(T.P.FEATURE_TOKEN)}) AS t FROM documents),
{Q.stem_ctes('words', 'doc_id', 't')}
SELECT k AS doc_id, string_agg(stem, ' ' ORDER BY pos) AS stemmed FROM stems GROUP BY k""")
def stem_tokens(spark, folder):
    d = table(spark, folder, "documents")
    words = T.feature_tokens(F.concat("text", F.lit(_PORTUGUESE)))
    return d.select("doc_id", words.alias("t")).select(
        "doc_id", F.array_join(S.stem_portuguese(F.col("t")), " ").alias("stemmed")
    )


@query("normalize_text", _WITH_POSTS + f"SELECT row_id, {Q.normalize('text')} AS normalized FROM posts")
def normalize_text(spark, folder):
    return posts(spark, folder).select("row_id", T.normalize_text(F.col("text")).alias("normalized"))


@query("tokenize_w2v", f"""
SELECT doc_id, array_to_string({Q.tokens_of('c', chr(92) + 'p{L}')}, ' ') AS tokens
FROM (SELECT doc_id, {Q.shorten_runs(f"lower({Q.normalize('text')} || ' nãooooo 16 a1')", 3)} AS c FROM documents)""")
def tokenize_w2v(spark, folder):
    d = table(spark, folder, "documents")
    text = F.concat(T.normalize_text(F.col("text")), F.lit(" nãooooo 16 a1"))
    return d.select("doc_id", F.array_join(T.tokenize_w2v(text), " ").alias("tokens"))


ENCODER_INPUT_SQL = """CASE WHEN len(tags) > 0 THEN trim(text || ' ' || array_to_string(tags, ' ')) ELSE text END"""
TAGS_SQL = "list_filter(list_transform(string_split(hashtags, '|'), lambda h: trim(h)), lambda h: h <> '')"


@query("encoder_input", _WITH_POSTS + f"""
SELECT row_id, {ENCODER_INPUT_SQL} AS encoder_input FROM (SELECT row_id, text, {TAGS_SQL} AS tags FROM posts)""")
def encoder_input(spark, folder):
    return posts(spark, folder).select(
        "row_id", T.encoder_input(F.col("text"), F.col("hashtags")).alias("encoder_input")
    )


@query("snippet", """
SELECT doc_id, substring(line, 1, 60) || CASE WHEN length(text) > 60 THEN '...' ELSE '' END AS short,
       substring(line, 1, 90) || CASE WHEN length(text) > 90 THEN '...' ELSE '' END AS medium,
       substring(line, 1, 100) AS plain, substring(line, 1, 1000) AS long
FROM (SELECT doc_id, text, replace(text, chr(10), ' ') AS line FROM documents)""")
def snippet(spark, folder):
    c = F.col("text")
    return table(spark, folder, "documents").select(
        "doc_id", T.snippet(c, 60, True).alias("short"), T.snippet(c, 90, True).alias("medium"),
        T.snippet(c, 100).alias("plain"), T.snippet(c, 1000).alias("long"),
    )


@query("to_json_column", """
SELECT doc_id, '{"chars":' || n_chars || ',"id":' || doc_id || ',"é":' || doc_id % 3 || '}' AS sorted_map,
       '["' || lang || '","' || source || '"]' AS list
FROM documents""")
def to_json_column(spark, folder):
    d = table(spark, folder, "documents")
    pairs = F.create_map(F.lit("é"), F.col("doc_id") % 3, F.lit("id"), F.col("doc_id"), F.lit("chars"), F.col("n_chars"))
    return d.select(
        "doc_id", V.to_sorted_json_text(pairs).alias("sorted_map"),
        V.to_json_text(F.array("lang", "source")).alias("list"),
    )


@query("round_vector", """
SELECT vec_id, CAST(pos AS INTEGER) AS pos, round_even(CAST(x AS DOUBLE), 6) AS value
FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)""")
def round_vector(spark, folder):
    e = table(spark, folder, "embeddings")
    return e.select("vec_id", F.posexplode(V.round_vector(V.as_double(F.col("embedding")))).alias("pos", "value"))


@query("short_id", """
SELECT doc_id, 'S' || (min(doc_id) OVER (PARTITION BY text) + 1) AS sid FROM documents""")
def short_id(spark, folder):
    d = table(spark, folder, "documents").select("doc_id", "text", (F.col("doc_id") + 1).alias("position"))
    return short_ids(d, "text", "position").select("doc_id", "sid")


ANONYMIZED_SQL = f"""SELECT row_id, search_date, substring(created_at, 1, 10) AS created_date, lang, source,
  {Q.redact('text')} AS text_redacted, CAST(length(text) AS INTEGER) AS text_length,
  {', '.join(f"{Q.bucket(c)} AS {c}_bucket" for c in schemas.COUNT_FIELDS)},
  is_reply, is_limited_reply,
  {', '.join(f"CAST(len(list_filter(string_split({c}, '|'), lambda p: p <> '')) AS INTEGER) AS {c}_count" for c in schemas.ENTITY_COLUMNS)},
  lower(text) LIKE '%recovery%' OR lower(text) LIKE '%recuper%' OR lower(text) LIKE '%treatment%'
    OR lower(text) LIKE '%tratamento%' AS contains_recovery_term
FROM posts"""


@query("anonymize_posts", _WITH_POSTS + f"SELECT * EXCLUDE (row_id) FROM ({ANONYMIZED_SQL})")
def anonymize(spark, folder):
    return anonymize_posts(posts(spark, folder))


CLEAN_CTES = f"""
clean_tokens AS (SELECT row_id, {Q.tokenize(Q.clean('text'))} AS tokens FROM posts),
clean_content AS (SELECT row_id, tokens, {Q.stopwords('tokens')} AS content FROM clean_tokens),
{Q.stem_ctes('clean_content', 'row_id', 'content')},
clean AS (SELECT row_id, tokens, content, coalesce(stemmed, '') AS stemmed FROM clean_content
  LEFT JOIN (SELECT k AS row_id, string_agg(stem, ' ' ORDER BY pos) AS stemmed FROM stems GROUP BY k) USING (row_id))"""


@query("clean_corpus", f"""WITH {POSTS_SQL}, {CLEAN_CTES}
SELECT row_id, array_to_string(tokens, ' ') AS tokens, array_to_string(content, ' ') AS content_tokens,
       stemmed AS stemmed_text FROM clean""")
def clean(spark, folder):
    cleaned = clean_corpus(posts(spark, folder).select("row_id", "text"), stop_words=Q.STOP_WORDS, partitions=cores(spark))
    return cleaned.select(
        "row_id", F.array_join("tokens", " ").alias("tokens"),
        F.array_join("content_tokens", " ").alias("content_tokens"), "stemmed_text",
    )
