"""TF-IDF, word vectors, embeddings, clusters and projections."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window, functions as F

from catalog import sqltext as Q
from catalog.base import POSTS_SQL, VECTORS_SQL, cores, posts, query, rounded, table, vectors
from catalog.text_queries import CLEAN_CTES, ENCODER_INPUT_SQL, TAGS_SQL
from tidepost.functions import text as T, vectors as V
from tidepost.operators.clean import clean_corpus
from tidepost.operators import (
    clusters as C, encoder as E, projection as P, similarity as S, tfidf as X, word_vectors as W,
)
from tidepost.operators import cbow as CB
from tidepost.operators.vector_sums import vector_sum
from tidepost.session import materialize, scratch_path
from tidepost.sinks.posts import write_stage_metadata

# --- TF-IDF ----------------------------------------------------------------

MAX_FEATURES = 1000
TERMS_SQL = f"""tokens AS (SELECT doc_id, unnest(regexp_extract_all(text, {Q.lit(T.P.FEATURE_TOKEN)})) AS term FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY 1, 2),
totals AS (SELECT term, CAST(sum(tf) AS BIGINT) AS corpus_tf, count(*) AS df FROM counts GROUP BY 1)"""
VOCABULARY_SQL = f"""{TERMS_SQL},
n AS (SELECT count(*) AS n FROM documents),
vocabulary AS (SELECT term, corpus_tf, df, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM totals, n
  WHERE df >= 2 AND df <= 0.85 * n ORDER BY corpus_tf DESC, term LIMIT {MAX_FEATURES})"""
TFIDF_SQL = f"""{VOCABULARY_SQL},
raw AS (SELECT doc_id, term, tf * idf AS w FROM counts JOIN vocabulary USING (term)),
tfidf AS (SELECT doc_id, term, round_even(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw)"""


def vocabulary(spark, folder):
    return X.fit_vocabulary(table(spark, folder, "documents"), "text")


@query("term_document_frequency", f"WITH {TERMS_SQL} SELECT * FROM totals")
def term_document_frequency(spark, folder):
    return X.term_document_frequency(table(spark, folder, "documents"), "text")


@query("select_vocabulary", f"WITH {VOCABULARY_SQL} SELECT term, corpus_tf, df, round(idf, 6) AS idf FROM vocabulary")
def select_vocabulary(spark, folder):
    return rounded(vocabulary(spark, folder), "idf")


@query("vocab_restrict", f"WITH {VOCABULARY_SQL} SELECT doc_id, term, tf FROM counts WHERE term IN (SELECT term FROM vocabulary)")
def vocab_restrict(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return X.vocab_restrict(documents, "text", vocabulary(spark, folder)).select("doc_id", "term", "tf")


@query("tfidf", f"WITH {TFIDF_SQL} SELECT doc_id, term, weight FROM documents LEFT JOIN tfidf USING (doc_id)")
def tfidf(spark, folder):
    weights = X.tfidf(table(spark, folder, "documents").select("doc_id", "text"), "text")
    return weights.select("doc_id", F.explode_outer("tfidf").alias("term", "weight"))


def _weights_sql(source: str) -> str:
    """CTEs from (row_id, text) to TF-IDF `weights`."""
    return f"""w_tokens AS (SELECT row_id, unnest(regexp_extract_all(text, {Q.lit(T.P.FEATURE_TOKEN)})) AS term FROM {source}),
w_counts AS (SELECT row_id, term, count(*) AS tf FROM w_tokens GROUP BY 1, 2),
w_totals AS (SELECT term, sum(tf) AS corpus_tf, count(*) AS df FROM w_counts GROUP BY 1),
w_terms AS (SELECT term, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM w_totals, (SELECT count(*) AS n FROM {source})
  WHERE df >= 2 AND df <= 0.85 * n ORDER BY corpus_tf DESC, term LIMIT {MAX_FEATURES}),
w_raw AS (SELECT row_id, term, tf * idf AS w FROM w_counts JOIN w_terms USING (term)),
weights AS (SELECT row_id, term, round_even(w / sqrt(sum(w * w) OVER (PARTITION BY row_id)), 6) AS weight FROM w_raw)"""


@query("normalize_corpus", f"""WITH {POSTS_SQL}, {CLEAN_CTES},
normalized AS (SELECT row_id, {Q.normalize('stemmed')} AS text FROM clean), {_weights_sql('normalized')}
SELECT row_id, text AS normalized_text, coalesce(terms, 0) AS terms, coalesce(total, 0.0) AS total FROM normalized
LEFT JOIN (SELECT row_id, count(*) AS terms, round(sum(weight), 6) AS total FROM weights GROUP BY 1) USING (row_id)""")
def normalize_corpus(spark, folder):
    cleaned = clean_corpus(posts(spark, folder).select("row_id", "text"), stop_words=Q.STOP_WORDS, partitions=cores(spark))
    done = X.normalize_corpus(cleaned.select("row_id", "stemmed_text"))
    weights = F.map_values("tfidf")
    return done.select(
        "row_id", "normalized_text", F.size(weights).cast("bigint").alias("terms"),
        F.round(F.aggregate(weights, F.lit(0.0), lambda s, x: s + x), 6).alias("total"),
    )


@query("top_terms_per_language", f"""WITH {TFIDF_SQL},
sums AS (SELECT lang, term, round(sum(weight), 6) AS weight FROM tfidf JOIN documents USING (doc_id) GROUP BY 1, 2)
SELECT lang, CAST(rank AS INTEGER) AS rank, term, weight FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY weight DESC, term) AS rank FROM sums) WHERE rank <= 10""")
def top_terms_per_language(spark, folder):
    d = table(spark, folder, "documents").select("lang", "text")
    # explode_outer: an inner explode makes the optimizer infer a filter on the map's size below the
    # projections, which evaluates the whole TF-IDF expression a second time; rows without terms leave here.
    weights = X.tfidf(d, "text").select("lang", F.explode_outer("tfidf").alias("term", "weight")).where(F.col("term").isNotNull())
    sums = weights.groupBy("lang", "term").agg(
        F.round(F.sum("weight"), 6).alias("weight")
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("weight"), "term"))
    return sums.withColumn("rank", rank).filter("rank <= 10").select("lang", "rank", "term", "weight")


@query("write_stage_metadata", f"""WITH {VOCABULARY_SQL}
SELECT string_agg(term, ' ' ORDER BY term) AS feature_names, 0.85 :: DOUBLE AS max_df, CAST(2 AS BIGINT) AS min_df,
       CAST({MAX_FEATURES} AS BIGINT) AS max_features FROM vocabulary""")
def write_settings(spark, folder):
    path = scratch_path(spark, "settings")
    settings = vocabulary(spark, folder).agg(F.array_sort(F.collect_list("term")).alias("feature_names"))
    write_stage_metadata(settings.withColumn("vectorizer", F.struct(
        F.lit(X.MAX_DF).alias("max_df"), F.lit(X.MIN_DF).alias("min_df"), F.lit(X.MAX_FEATURES).alias("max_features"),
    )), path)
    back = spark.read.schema(
        "feature_names array<string>, vectorizer struct<max_df:double, min_df:bigint, max_features:bigint>"
    ).json(path)
    return back.select(F.array_join("feature_names", " ").alias("feature_names"), "vectorizer.*")


# --- word vectors ----------------------------------------------------------

WORD_DIMS = 4
_TOKENS = f"regexp_extract_all(lower(text), {Q.lit(T.P.FEATURE_TOKEN)})"
# Each word of the benchmark texts gets a small vector computed from the word.
WORDS_SQL = f"""bench AS (SELECT unnest({_TOKENS}) AS word FROM benchmark),
words AS (SELECT word, freq, [sqrt(length(word)), ln(ascii(word)), ln(1.0 + freq), cos(freq)] AS vector,
  length(word) <= 3 AS is_stop, ascii(word) % 7 = 0 AS is_punct FROM (SELECT word, count(*) AS freq FROM bench GROUP BY 1)),
doc_words AS (SELECT doc_id AS row_id, word, count(*) AS tf FROM (SELECT doc_id, unnest({_TOKENS}) AS word FROM documents) GROUP BY 1, 2)"""


def _mean_sql(source: str, condition: str = "TRUE") -> str:
    parts = ", ".join(f"sum(tf * vector[{i}]) / sum(tf) AS m{i}" for i in range(1, WORD_DIMS + 1))
    return f"(SELECT row_id, {parts} FROM {source} JOIN words USING (word) WHERE {condition} GROUP BY 1)"


def word_table(spark, folder):
    words = table(spark, folder, "benchmark").select(F.explode(T.feature_tokens(F.lower("text"))).alias("word"))
    freq = words.groupBy("word").agg(F.count(F.lit(1)).alias("freq"))
    vector = F.array(
        F.sqrt(F.length("word")), F.ln(F.ascii("word")), F.ln(1.0 + F.col("freq")), F.cos("freq")
    )
    return freq.select(
        "word", "freq", vector.alias("vector"), (F.length("word") <= 3).alias("is_stop"),
        (F.ascii("word") % 7 == 0).alias("is_punct"),
    )


def doc_tokens(spark, folder):
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("row_id"), T.feature_tokens(F.lower("text")).alias("tokens")
    )


def dims(df, vector="vector", digits=6):
    """The components of a short vector as columns."""
    others = [c for c in df.columns if c != vector]
    return df.select(*others, *[
        F.round(F.get(vector, F.lit(i)), digits).alias(f"m{i + 1}") for i in range(WORD_DIMS)
    ])


_DIMS = range(1, WORD_DIMS + 1)


@query("lookup_word_vectors", f"""WITH {WORDS_SQL}
SELECT row_id, word, tf, {', '.join(f'round(vector[{i}], 6) AS m{i}' for i in _DIMS)} FROM doc_words JOIN words USING (word)""")
def lookup_word_vectors(spark, folder):
    known = W.lookup_word_vectors(doc_tokens(spark, folder), word_table(spark, folder), "tokens", "row_id")
    return dims(known.select("row_id", "word", "tf", "vector"))


@query("mean_word_vector", f"""WITH {WORDS_SQL}
SELECT doc_id AS row_id, {', '.join(f'coalesce(round_even(m{i}, 6), 0.0) AS m{i}' for i in _DIMS)}
FROM documents LEFT JOIN {_mean_sql('doc_words')} m ON row_id = doc_id""")
def mean_word_vector(spark, folder):
    return dims(W.mean_word_vector(
        doc_tokens(spark, folder), word_table(spark, folder), "tokens", "row_id", WORD_DIMS
    ))


@query("mean_word_vector_fallback", f"""WITH {WORDS_SQL}
SELECT doc_id AS row_id, {', '.join(f'coalesce(round(coalesce(c.m{i}, a.m{i}), 6), 0.0) AS m{i}' for i in _DIMS)}
FROM documents LEFT JOIN {_mean_sql('doc_words')} a ON a.row_id = doc_id
LEFT JOIN {_mean_sql('doc_words', 'NOT is_stop AND NOT is_punct')} c ON c.row_id = doc_id""")
def mean_word_vector_fallback(spark, folder):
    return dims(W.mean_word_vector_fallback(
        doc_tokens(spark, folder), word_table(spark, folder), "tokens", "row_id", WORD_DIMS
    ))


@query("vocabulary_summary", f"""WITH freq AS (
  SELECT word, count(*) AS freq FROM (SELECT unnest({_TOKENS}) AS word FROM documents) GROUP BY 1)
SELECT (SELECT count(*) FROM freq) AS vocabulary_size, CAST(row_number() OVER (ORDER BY freq DESC, word) AS INTEGER) AS rank, word, freq
FROM freq ORDER BY freq DESC, word LIMIT 50""")
def vocabulary_summary(spark, folder):
    return W.vocabulary_summary(doc_tokens(spark, folder), "tokens")


@query("word2vec_fit", f"""WITH lists AS (SELECT doc_id, {_TOKENS} AS t FROM documents),
places AS (SELECT doc_id, unnest(t) AS w, generate_subscripts(t, 1) AS p FROM lists),
pairs AS (SELECT a.w AS word, b.w AS context, count(*) AS n FROM places a JOIN places b
  ON a.doc_id = b.doc_id AND b.p BETWEEN a.p - {W.WINDOW} AND a.p + {W.WINDOW} AND a.p <> b.p GROUP BY 1, 2),
margins AS (SELECT word, sum(n) AS total FROM pairs GROUP BY 1),
weights AS (SELECT word, CAST('0x' || substr(md5(context), 1, 6) AS BIGINT) % {W.VECTOR_SIZE} AS place,
  (1 - 2 * (CAST('0x' || substr(md5(context), 7, 1) AS BIGINT) % 2))
    * ln(n * (SELECT sum(n) :: DOUBLE FROM pairs) / (CAST(m.total AS DOUBLE) * c.total)) AS x,
  ln(n * (SELECT sum(n) :: DOUBLE FROM pairs) / (CAST(m.total AS DOUBLE) * c.total)) AS weight
  FROM pairs JOIN margins m USING (word) JOIN margins c ON c.word = context),
vectors AS (SELECT word, place, sum(x) AS x FROM weights WHERE weight > 0 GROUP BY 1, 2),
norms AS (SELECT word, sqrt(sum(x * x)) AS norm FROM vectors GROUP BY 1),
summed AS (SELECT word, sum((place + 1) * x / norm) AS weighted, sum(abs(x) / norm) AS absolute FROM vectors JOIN norms USING (word) WHERE norm > 0 GROUP BY 1)
SELECT word, round(coalesce(weighted, 0.0), 5) AS weighted, round(coalesce(absolute, 0.0), 5) AS absolute
FROM (SELECT DISTINCT w AS word FROM places) LEFT JOIN summed USING (word)""")
def word2vec_fit(spark, folder):
    fitted = W.fit_word_vectors(doc_tokens(spark, folder), "tokens")
    total = lambda f: F.round(F.aggregate(F.transform("vector", f), F.lit(0.0), lambda a, b: a + b), 5)
    # All components in two numbers per word.
    return fitted.select("word", total(lambda x, i: (i + 1) * x).alias("weighted"), total(F.abs).alias("absolute"))


@query("word2vec_cbow", f"""SELECT DISTINCT word, {CB.VECTOR_SIZE} AS dims, true AS finite
FROM (SELECT unnest({_TOKENS}) AS word FROM documents) WHERE word IS NOT NULL""")
def word2vec_cbow(spark, folder):
    """Trained CBOW vectors of every word of the documents; the facts: one vector per word, its size, all finite."""
    fitted, _ = CB.train_cbow(doc_tokens(spark, folder), "row_id", "tokens")
    finite = F.forall("vector", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    return fitted.select("word", F.size("vector").alias("dims"), finite.alias("finite"))


@query("keyword_vector_search", f"""WITH {WORDS_SQL},
corpus AS (SELECT doc_id AS row_id, {', '.join(f'coalesce(round_even(m{i}, 6), 0.0) AS m{i}' for i in _DIMS)}
  FROM documents LEFT JOIN {_mean_sql('doc_words')} m ON row_id = doc_id),
mean AS (SELECT {', '.join(f'avg(m{i}) AS c{i}' for i in _DIMS)} FROM corpus),
asked AS (SELECT 0 AS row_id, word, count(*) AS tf FROM (
  SELECT unnest({_TOKENS}) AS word FROM benchmark WHERE item_id = (SELECT min(item_id) FROM benchmark)) GROUP BY 2),
q AS (SELECT [{', '.join(f'm{i} - c{i}' for i in _DIMS)}] AS q FROM {_mean_sql('asked')}, mean),
scored AS (SELECT row_id, [{', '.join(f'm{i} - c{i}' for i in _DIMS)}] AS v FROM corpus, mean)
SELECT row_id, round(list_cosine_similarity(v, q), 6) AS similarity FROM scored, q
ORDER BY list_cosine_similarity(v, q) DESC, row_id LIMIT 10""")
def keyword_vector_search(spark, folder):
    words = word_table(spark, folder)
    corpus = W.mean_word_vector(doc_tokens(spark, folder), words, "tokens", "row_id", WORD_DIMS)
    # Read for the corpus mean and for the scores.
    corpus = materialize(corpus, "post-vectors")
    asked = table(spark, folder, "benchmark").orderBy("item_id").limit(1)
    asked = asked.select(T.feature_tokens(F.lower("text")).alias("tokens"))
    return rounded(
        W.keyword_vector_search(asked, words, corpus, "tokens", "row_id", 10, WORD_DIMS), "similarity"
    )


# --- encoder ---------------------------------------------------------------

def _long(df, *keys, vector="vector", digits=6):
    """One line per component, rounded."""
    return df.select(*keys, F.posexplode(vector).alias("dim", "value")).withColumn("value", F.round("value", digits))


def _long_sql(source: str, keys: str, vector: str = "vector") -> str:
    return (
        f"SELECT {keys}, CAST(dim AS INTEGER) AS dim, round(value, 6) AS value FROM (SELECT {keys}, "
        f"unnest({vector}) AS value, generate_subscripts({vector}, 1) - 1 AS dim FROM {source})"
    )


def encoded_sql(source: str, keys: str, name: str, pooling: str = "mean", salt: str = "") -> str:
    """CTEs: `name`_words with the words read of each text, `name` with the components that are not 0."""
    words = f"list_slice(regexp_extract_all(lower(text), {Q.lit(T.P.PLAIN_WORD)}), 1, {E.MAX_LENGTH})"
    if pooling == "cls":
        words = f"list_distinct({words})"
    total = "sqrt(n)" if pooling == "cls" else "n"
    return f"""{name}_words AS (SELECT {keys}, {words} AS w FROM {source}),
{name}_slots AS (SELECT {keys}, n, CAST('0x' || substr(h, 1, 6) AS BIGINT) % {E.VECTOR_SIZE} AS dim,
  1 - 2 * (CAST('0x' || substr(h, 7, 1) AS BIGINT) % 2) AS sign
  FROM (SELECT {keys}, len(w) AS n, md5('{salt}|' || unnest(w)) AS h FROM {name}_words)),
{name} AS (SELECT {keys}, CAST(dim AS INTEGER) AS dim, sum(sign) / {total} AS value FROM {name}_slots GROUP BY {keys}, dim, n HAVING sum(sign) <> 0)"""


def sparse(df, *keys, vector):
    """One line per component that is not 0."""
    numbered = F.transform(V.as_double(F.col(vector)), lambda x, i: F.struct(i.alias("dim"), F.round(x, 6).alias("value")))
    return df.select(*keys, F.inline(F.filter(numbered, lambda e: e["value"] != 0)))


@query("encode_documents", f"""WITH {POSTS_SQL}, inputs AS (SELECT row_id, {ENCODER_INPUT_SQL} AS text
  FROM (SELECT row_id, {Q.normalize('text')} AS text, {TAGS_SQL} AS tags FROM posts)), {encoded_sql('inputs', 'row_id', 'encoded')}
SELECT row_id, dim, round_even(value, 6) AS value FROM encoded""")
def encode_documents(spark, folder):
    p = posts(spark, folder)
    inputs = p.select("row_id", T.encoder_input(T.normalize_text(F.col("text")), F.col("hashtags")).alias("encoder_input"))
    return sparse(E.encode_documents(inputs, E.hashed_encoder(), partitions=cores(spark)), "row_id", vector="encoder_vector")


@query("text_search", f"""WITH {encoded_sql('documents', 'doc_id', 'd')},
asked AS (SELECT 0 AS item, text FROM benchmark ORDER BY item_id LIMIT 1), {encoded_sql('asked', 'item', 'q')},
n AS (SELECT count(*) AS n FROM documents),
m AS (SELECT dim, sum(value) / (SELECT n FROM n) AS m FROM d GROUP BY 1),
mm AS (SELECT sum(m * m) AS mm FROM m),
qq AS (SELECT sum(value * value) AS qq, sum(value * coalesce(m, 0)) AS qm FROM q LEFT JOIN m USING (dim)),
scored AS (SELECT doc_id, sum(d.value * coalesce(q.value, 0)) AS vq, sum(d.value * d.value) AS vv, sum(d.value * m) AS vm
  FROM d JOIN m USING (dim) LEFT JOIN q USING (dim) GROUP BY 1),
hits AS (SELECT doc_id, (coalesce(vq, 0) - coalesce(vm, 0) - qm + mm) / (sqrt(coalesce(vv, 0) - 2 * coalesce(vm, 0) + mm) * sqrt(qq - 2 * qm + mm)) AS s
  FROM documents LEFT JOIN scored USING (doc_id), mm, qq ORDER BY s DESC, doc_id LIMIT 10)
SELECT doc_id AS row_id, round(s, 6) AS similarity, substr(replace(text, chr(10), ' '), 1, 1000) AS snippet FROM hits JOIN documents USING (doc_id)""")
def text_search(spark, folder):
    texts = table(spark, folder, "documents").select(F.col("doc_id").alias("row_id"), "text")
    corpus = E.encode_documents(texts, E.hashed_encoder(), "text", "vector", digits=None).select("row_id", "vector")
    asked = table(spark, folder, "benchmark").orderBy("item_id").limit(1).select("text")
    query_vector = E.encode_documents(asked, E.hashed_encoder(), "text", "vector", digits=None).select("vector")
    # Read for the corpus mean and for the scores.
    hits = S.semantic_search(materialize(corpus, "encoded"), materialize(query_vector, "asked"), "row_id", "vector", 10)
    return rounded(S.with_snippets(hits, texts), "similarity")


_MODELS = {
    (model, pooling): E.hashed_encoder(pooling=pooling, salt=model)
    for model in ("model-a", "model-b") for pooling in E.POOLINGS
}
_FAMILY_SQL = [
    (model, pooling, f"f{i}", encoded_sql("texts", "row_id", f"f{i}", pooling, model)) for i, (model, pooling) in enumerate(_MODELS)
]


def families(spark, folder):
    texts = table(spark, folder, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("row_id"), "text"
    )
    return E.embed_all_models(texts, _MODELS)


@query("embed_all_models", f"""WITH texts AS (SELECT conv_id * 1000 + turn AS row_id, text FROM conversations), {', '.join(s for *_, s in _FAMILY_SQL)}
{' UNION ALL '.join(f"SELECT '{model}' AS model, '{pooling}' AS pooling, row_id, dim, round_even(value, 6) AS value FROM {name}" for model, pooling, name, _ in _FAMILY_SQL)}""")
def embed_all_models(spark, folder):
    return sparse(families(spark, folder), "model", "pooling", "row_id", vector="vector")


def token_vectors(spark, folder):
    """Runs of eight vectors as the tokens of one text; some are masked, some texts fully."""
    v = vectors(spark, folder)
    row, pos = F.floor(F.col("row_id") / 8), F.col("row_id") % 8
    mask = F.when((row % 5 == 4) | (pos > row % 8), 0).otherwise(1)
    return v.select(row.alias("row_id"), pos.alias("pos"), mask.alias("mask"), "vector")


TOKEN_VECTORS_SQL = f"""{VECTORS_SQL}, token_vectors AS (SELECT row_id // 8 AS row_id, row_id % 8 AS pos,
  CASE WHEN (row_id // 8) % 5 = 4 OR row_id % 8 > (row_id // 8) % 8 THEN 0 ELSE 1 END AS mask, vector FROM vecs),
cells AS (SELECT row_id, pos, mask, unnest(vector) AS x, generate_subscripts(vector, 1) - 1 AS dim FROM token_vectors)"""


@query("masked_mean_pool", f"""WITH {TOKEN_VECTORS_SQL}
SELECT row_id, CAST(dim AS INTEGER) AS dim, round(sum(x * mask) / greatest(sum(mask), 1e-9), 6) AS value FROM cells GROUP BY 1, 2""")
def masked_mean_pool(spark, folder):
    return _long(E.pool_tokens(token_vectors(spark, folder), "mean", vector_size=64), "row_id")


@query("cls_pool", f"""WITH {TOKEN_VECTORS_SQL}
SELECT row_id, CAST(dim AS INTEGER) AS dim, round(x, 6) AS value FROM cells WHERE pos = 0""")
def cls_pool(spark, folder):
    pooled = E.pool_tokens(token_vectors(spark, folder), "cls")
    return _long(pooled.withColumn("vector", V.as_double(F.col("vector"))), "row_id")


# --- embeddings ------------------------------------------------------------

CENTERED_SQL = f"""{VECTORS_SQL},
dims AS (SELECT row_id, unnest(vector) AS x, generate_subscripts(vector, 1) AS dim FROM vecs),
means AS (SELECT dim, avg(x) AS m FROM dims GROUP BY 1),
centered AS (SELECT row_id, list(x - m ORDER BY dim) AS vector FROM dims JOIN means USING (dim) GROUP BY 1)"""


@query("corpus_mean_vector", f"WITH {CENTERED_SQL} SELECT CAST(dim - 1 AS INTEGER) AS dim, round(m, 6) AS value FROM means")
def corpus_mean_vector(spark, folder):
    return _long(S.corpus_mean_vector(vectors(spark, folder)), vector="mean")


@query("center_vectors", f"WITH {CENTERED_SQL} {_long_sql('centered', 'row_id')}")
def center_vectors(spark, folder):
    return _long(S.center_vectors(vectors(spark, folder)), "row_id", vector="centered")


def shifted(spark, folder):
    """A second family: reversed vectors under keys moved by 100."""
    v = vectors(spark, folder)
    return v.select((F.col("row_id") + 100).alias("row_id"), F.reverse("vector").alias("vector"))


SHIFTED_SQL = "shifted AS (SELECT row_id + 100 AS row_id, list_reverse(vector) AS vector FROM vecs)"


@query("align_embeddings", f"""WITH {VECTORS_SQL}, {SHIFTED_SQL}
SELECT a.row_id, round(list_dot_product(a.vector, b.vector), 6) AS product FROM vecs a JOIN shifted b USING (row_id)""")
def align_embeddings(spark, folder):
    both = S.align_embeddings(vectors(spark, folder), shifted(spark, folder))
    product = V.dot(V.as_double(F.col("left_vector")), V.as_double(F.col("right_vector")))
    return both.select("row_id", F.round(product, 6).alias("product"))


def _pairs_sql(source: str) -> str:
    return f"""(SELECT a.row_id AS i, b.row_id AS j, list_cosine_similarity(a.vector, b.vector) AS s
  FROM {source} a JOIN {source} b ON a.row_id < b.row_id)"""


@query("similarity_pairs", f"""WITH {VECTORS_SQL}
SELECT a.row_id, count(*) AS pairs, round(avg(s), 6) AS mean_similarity, round(min(s), 6) AS min_similarity, round(max(s), 6) AS max_similarity
FROM (SELECT a.row_id, list_cosine_similarity(a.vector, b.vector) AS s FROM vecs a JOIN vecs b ON a.row_id <> b.row_id) a GROUP BY 1""")
def similarity_pairs(spark, folder):
    pairs = S.similarity_pairs(vectors(spark, folder))
    return rounded(pairs, "mean_similarity", "min_similarity", "max_similarity")


@query("similarity_moments", f"""WITH {VECTORS_SQL}
SELECT count(*) AS pairs, round(avg(s), 6) AS mean, round(stddev_pop(s), 6) AS std FROM {_pairs_sql('vecs')}""")
def similarity_moments(spark, folder):
    return rounded(S.similarity_moments(vectors(spark, folder)), "mean", "std")


def _stats_sql(kind: str, source: str) -> str:
    return f"""SELECT '{kind}' AS kind, count(*) AS pairs, round(avg(s), 6) AS mean, round(stddev_pop(s), 6) AS std,
  round(min(s), 6) AS min, round(max(s), 6) AS max, round(quantile_cont(s, 0.5), 6) AS median FROM {_pairs_sql(source)}"""


@query("similarity_stats", f"WITH {CENTERED_SQL} {_stats_sql('raw', 'vecs')} UNION ALL {_stats_sql('centered', 'centered')}")
def similarity_stats(spark, folder):
    return rounded(S.similarity_stats(vectors(spark, folder)), "mean", "std", "min", "max", "median")


@query("similarity_histogram", f"""WITH {VECTORS_SQL}, pairs AS {_pairs_sql('vecs')},
ends AS (SELECT min(s) AS low, max(s) AS high FROM pairs),
binned AS (SELECT CAST(least(floor((s - low) / (high - low) * 80), 79) AS BIGINT) + 1 AS bin FROM pairs, ends)
SELECT bin, round(low + (bin - 1) * (high - low) / 80, 6) AS low, round(low + bin * (high - low) / 80, 6) AS high, count(*) AS pairs
FROM binned, ends GROUP BY bin, ends.low, ends.high""")
def similarity_histogram(spark, folder):
    return rounded(S.similarity_histogram(vectors(spark, folder)), "low", "high")


SAMPLE_SQL = "(SELECT row_id FROM vecs ORDER BY md5(row_id || '|42'), row_id LIMIT {})"
MATRIX_SQL = f"""sample AS (SELECT * FROM centered WHERE row_id IN {SAMPLE_SQL.format(20)}),
cells AS (SELECT a.row_id AS i, b.row_id AS j, round(list_cosine_similarity(a.vector, b.vector), 6) AS similarity FROM sample a, sample b)"""


def sample_matrix(spark, folder):
    centered = S.center_vectors(vectors(spark, folder)).select("row_id", F.col("centered").alias("vector"))
    return rounded(S.similarity_sample_matrix(centered), "similarity")


@query("similarity_sample_matrix", f"WITH {CENTERED_SQL}, {MATRIX_SQL} SELECT * FROM cells")
def similarity_sample_matrix(spark, folder):
    return sample_matrix(spark, folder)


@query("lower_triangle", f"WITH {CENTERED_SQL}, {MATRIX_SQL} SELECT * FROM cells WHERE j <= i")
def lower_triangle(spark, folder):
    return S.lower_triangle(sample_matrix(spark, folder))


@query("compare_embeddings", f"""WITH {VECTORS_SQL}, {SHIFTED_SQL},
both_sides AS (SELECT a.row_id, a.vector AS u, b.vector AS w FROM vecs a JOIN shifted b USING (row_id)
  ORDER BY md5(a.row_id || '|42'), a.row_id LIMIT 200),
du AS (SELECT row_id, unnest(u) AS x, unnest(w) AS y, generate_subscripts(u, 1) AS dim FROM both_sides),
mu AS (SELECT dim, avg(x) AS mx, avg(y) AS my FROM du GROUP BY 1),
c AS (SELECT row_id, list(x - mx ORDER BY dim) AS u, list(y - my ORDER BY dim) AS w FROM du JOIN mu USING (dim) GROUP BY 1),
cells AS (SELECT a.row_id AS i, b.row_id AS j, list_cosine_similarity(a.u, b.u) AS s, list_cosine_similarity(a.w, b.w) AS t FROM c a, c b)
SELECT (SELECT count(*) FROM c) AS rows, round(avg(s) FILTER (i < j), 6) AS left_mean, round(stddev_pop(s) FILTER (i < j), 6) AS left_std,
  round(avg(t) FILTER (i < j), 6) AS right_mean, round(stddev_pop(t) FILTER (i < j), 6) AS right_std, round(corr(s, t), 6) AS correlation FROM cells""")
def compare_embeddings(spark, folder):
    result = S.compare_embeddings(vectors(spark, folder), shifted(spark, folder))
    return rounded(result, "left_mean", "left_std", "right_mean", "right_std", "correlation")


@query("query_corpus_scores", f"""WITH {VECTORS_SQL}, q AS (SELECT vector AS q FROM vecs ORDER BY row_id LIMIT 1)
SELECT row_id, round(list_cosine_similarity(vector, q), 6) AS similarity FROM vecs, q""")
def query_corpus_scores(spark, folder):
    v = vectors(spark, folder)
    scored = S.query_corpus_scores(v, v.orderBy("row_id").limit(1))
    return rounded(scored.select("row_id", "similarity"), "similarity")


@query("semantic_search", f"""WITH {CENTERED_SQL}, q AS (SELECT vector AS q FROM centered ORDER BY row_id LIMIT 1),
hits AS (SELECT row_id, list_cosine_similarity(vector, q) AS s FROM centered, q ORDER BY 2 DESC, 1 LIMIT 10)
SELECT row_id, round(s, 6) AS similarity, substring(replace(text, chr(10), ' '), 1, 1000) AS snippet
FROM hits JOIN documents ON doc_id = row_id""")
def semantic_search(spark, folder):
    v = vectors(spark, folder)
    hits = S.semantic_search(v, v.orderBy("row_id").limit(1))
    texts = table(spark, folder, "documents").withColumnRenamed("doc_id", "row_id")
    return rounded(S.with_snippets(hits, texts), "similarity")


@query("random_sample", f"WITH {VECTORS_SQL} {SAMPLE_SQL.format(20)[1:-1]}")
def random_sample(spark, folder):
    return S.random_sample(vectors(spark, folder).select("row_id"), "row_id", 20)


@query("head_n", "SELECT doc_id, lang, substring(text, 1, 60) AS start FROM documents ORDER BY doc_id LIMIT 5")
def head_n(spark, folder):
    d = table(spark, folder, "documents").select("doc_id", "lang", F.substring("text", 1, 60).alias("start"))
    return S.head_rows(d, "doc_id", 5)


# --- clusters --------------------------------------------------------------

def centered(spark, folder):
    return S.center_vectors(vectors(spark, folder)).select("row_id", F.col("centered").alias("vector"))


@query("kmeans")
def kmeans(spark, folder):
    return C.kmeans(centered(spark, folder)).assigned


@query("kmeans_facts", """
SELECT count(*) AS rows, CAST(5 AS BIGINT) AS clusters, CAST(0 AS BIGINT) AS misplaced, 0.0 :: DOUBLE AS shift FROM embeddings""")
def kmeans_facts(spark, folder):
    """Every row is with its nearest centroid, and every centroid is the mean of its rows."""
    rows = centered(spark, folder)
    found = C.kmeans(rows)
    centers = spark.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(found.model.clusterCenters())], "cluster int, vector array<double>"
    )
    own = rows.select("row_id", V.as_double(F.col("vector")).alias("v")).join(found.assigned, "row_id").join(centers, "cluster")
    nearest = C.assign_nearest_centroid(rows, centers).select("row_id", "squared_distance")
    farther = V.squared_distance(F.col("v"), F.col("vector")) > F.col("squared_distance") + 1e-9
    misplaced = own.join(nearest, "row_id").agg(F.count(F.lit(1)).alias("rows"), F.count_if(farther).alias("misplaced"))
    off = own.groupBy("cluster").agg(vector_sum(V.divide(F.col("v"), F.lit(1.0))).alias("s"), F.count(F.lit(1)).cast("double").alias("n"), F.first("vector").alias("c"))
    shift = off.select(F.aggregate(F.zip_with(V.divide(F.col("s"), F.col("n")), "c", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda a, b: F.greatest(a, b)).alias("d"))
    return misplaced.select(
        "rows", off.agg(F.count(F.lit(1))).scalar().alias("clusters"), "misplaced",
        F.abs(F.round(shift.agg(F.max("d")).scalar(), 3)).alias("shift"),
    )


@query("cluster_families")
def cluster_families(spark, folder):
    return C.cluster_families(materialize(families(spark, folder), "families"), "row_id")


def label_centroids(spark, folder):
    v = vectors(spark, folder).withColumn("vector", V.as_double(F.col("vector")))
    sums = v.groupBy(F.col("label").alias("cluster")).agg(
        vector_sum(F.col("vector")).alias("s"), F.count(F.lit(1)).alias("n")
    )
    return sums.select("cluster", V.divide(F.col("s"), F.col("n").cast("double")).alias("vector"))


@query("assign_nearest_centroid", f"""WITH {VECTORS_SQL},
cells AS (SELECT row_id, label, unnest(vector) AS x, generate_subscripts(vector, 1) AS dim FROM vecs),
means AS (SELECT label, dim, avg(x) AS m FROM cells GROUP BY 1, 2),
centroids AS (SELECT label AS cluster, list(m ORDER BY dim) AS c FROM means GROUP BY 1),
distances AS (SELECT row_id, cluster, list_distance(vector, c) ** 2 AS d FROM vecs, centroids)
SELECT row_id, arg_min(cluster, d) AS cluster, round(min(d), 6) AS squared_distance FROM distances GROUP BY 1""")
def assign_nearest_centroid(spark, folder):
    nearest = C.assign_nearest_centroid(vectors(spark, folder), label_centroids(spark, folder))
    return rounded(nearest, "squared_distance")


def labelled(spark, folder):
    """Every document, with the label of the vector of the same number as its cluster; -1 where there is none."""
    v = vectors(spark, folder).select("row_id", F.col("label").alias("cluster"))
    d = table(spark, folder, "documents").select(F.col("doc_id").alias("row_id"), "text")
    return d.join(v, "row_id", "left").select("row_id", "text", F.coalesce("cluster", F.lit(-1)).alias("cluster"))


LABELLED_SQL = """labelled AS (SELECT doc_id AS row_id, text, coalesce(label, -1) AS cluster
  FROM documents LEFT JOIN embeddings ON vec_id = doc_id)"""


@query("cluster_summary", f"""WITH {LABELLED_SQL}
SELECT cluster, size, CAST(position AS INTEGER) AS position, substring(replace(text, chr(10), ' '), 1, 100) AS snippet FROM (
  SELECT *, count(*) OVER (PARTITION BY cluster) AS size, row_number() OVER (PARTITION BY cluster ORDER BY row_id) AS position FROM labelled)
WHERE position <= 3""")
def cluster_summary(spark, folder):
    return C.cluster_summary(labelled(spark, folder))


@query("cluster_members", f"WITH {LABELLED_SQL} SELECT * FROM labelled WHERE cluster = 3")
def cluster_members(spark, folder):
    return C.cluster_members(labelled(spark, folder), 3)


_ATTACH_SQL = "SELECT doc_id, lang AS model, source AS pooling, text AS sentence FROM documents"


@query("attach_clusters", f"""WITH sentences AS ({_ATTACH_SQL}),
assigned AS (SELECT model, pooling, sentence, quality + 2 * toxic AS cluster FROM sentences JOIN labels USING (doc_id))
SELECT doc_id, model, pooling, cluster FROM sentences LEFT JOIN assigned USING (model, pooling, sentence)""")
def attach_clusters(spark, folder):
    d = table(spark, folder, "documents").select(
        "doc_id", F.col("lang").alias("model"), F.col("source").alias("pooling"), F.col("text").alias("sentence")
    )
    assigned = d.join(table(spark, folder, "labels"), "doc_id").withColumn("cluster", F.col("quality") + 2 * F.col("toxic"))
    attached = C.attach_cluster_counts(d, assigned, ["model", "pooling", "sentence"])
    return C.expand_clusters(attached).select("doc_id", "model", "pooling", "cluster")


@query("attach_cluster_counts", f"""WITH sentences AS ({_ATTACH_SQL}),
assigned AS (SELECT model, pooling, sentence, quality + 2 * toxic AS cluster FROM sentences JOIN labels USING (doc_id))
SELECT doc_id, model, pooling, count(a.cluster) AS matches, count(DISTINCT a.cluster) AS clusters
FROM sentences s LEFT JOIN assigned a USING (model, pooling, sentence) GROUP BY doc_id, model, pooling""")
def attach_cluster_counts(spark, folder):
    """One row per document with how many labelled copies of its sentence match, and in how many clusters."""
    d = table(spark, folder, "documents").select(
        "doc_id", F.col("lang").alias("model"), F.col("source").alias("pooling"), F.col("text").alias("sentence")
    )
    assigned = d.join(table(spark, folder, "labels"), "doc_id").withColumn("cluster", F.col("quality") + 2 * F.col("toxic"))
    attached = C.attach_cluster_counts(d, assigned, ["model", "pooling", "sentence"])
    return attached.select(
        "doc_id", "model", "pooling", F.aggregate("clusters", F.lit(0).cast("long"), lambda a, m: a + m["copies"]).alias("matches"),
        F.size("clusters").cast("long").alias("clusters"),
    )


# --- projections -----------------------------------------------------------

@query("pca_project")
def pca_project(spark, folder):
    return rounded(P.pca_project(vectors(spark, folder), k=3).rows, "pc1", "pc2", "pc3")


@query("pca_facts", f"""WITH {VECTORS_SQL},
cells AS (SELECT unnest(vector) AS x, generate_subscripts(vector, 1) AS dim FROM vecs)
SELECT (SELECT count(*) FROM vecs) AS rows, round(sum(v), 4) AS total_variance, 0.0 :: DOUBLE AS center, 0.0 :: DOUBLE AS correlation, 0.0 :: DOUBLE AS skew
FROM (SELECT var_samp(x) AS v FROM cells GROUP BY dim)""")
def pca_facts(spark, folder):
    """Components are orthonormal, projections centered and uncorrelated, ratios shares of the total variance."""
    found = P.pca_project(vectors(spark, folder), k=3)
    skew = abs(found.components.T @ found.components - np.eye(3)).max()
    zero = lambda c, digits=6: F.abs(F.round(c, digits))
    return found.rows.agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.var_samp("pc1") / F.lit(found.ratios[0]), 4).alias("total_variance"),
        zero(F.greatest(*[F.abs(F.avg(f"pc{i}")) for i in (1, 2, 3)])).alias("center"),
        zero(F.greatest(F.abs(F.corr("pc1", "pc2")), F.abs(F.corr("pc1", "pc3")), F.abs(F.corr("pc2", "pc3")))).alias("correlation"),
        zero(F.lit(float(skew))).alias("skew"),
    )


@query("explained_variance")
def explained_variance(spark, folder):
    v = vectors(spark, folder)
    return rounded(P.explained_variance(P.pca_project(v, k=3), v), "ratio", "total_ratio")


@query("project_all_models")
def project_all_models(spark, folder):
    return rounded(P.project_all_models(materialize(families(spark, folder), "families"), "row_id"), "pc1", "pc2")
