"""Sources, sinks, nested JSON and the ledger of finished days."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import sqltext as Q
from catalog.base import LEDGER_SQL, POSTS_SQL, ledger, posts, query, table
from tidepost import schemas
from tidepost.operators import ledger as L
from tidepost.operators.encoder import concat_results as concat_tables
from tidepost.operators.row_ids import migrate_add_row_id
from tidepost.functions import text as T
from tidepost.session import scratch_path
from tidepost.sinks import posts as sinks
from tidepost.sources import metadata as M, posts as sources, vectors as VS

_WITH_POSTS = f"WITH {POSTS_SQL} "


# --- sources ---------------------------------------------------------------

@query("read_posts_csv", _WITH_POSTS + f"""
SELECT CAST(row_id AS VARCHAR) AS row_id, {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in schemas.POST_COLUMNS)} FROM posts""")
def read_posts_csv(spark, folder):
    path = scratch_path(spark, "posts-csv")
    sinks.export_csv(posts(spark, folder), path, ["row_id", *schemas.POST_COLUMNS], [])
    return sources.read_posts_csv(spark, path)


@query("read_posts_table", _WITH_POSTS + f"SELECT {', '.join(sources.EXPORT_COLUMNS)} FROM posts")
def read_posts_table(spark, folder):
    path = scratch_path(spark, "posts")
    sinks.append_posts(posts(spark, folder), path)
    return sources.read_posts_table(spark, path, ordered=True)


PAGE_POSTS = 20
BROKEN_DAY = "2023-12-31"


def page_texts(spark, folder):
    """Page envelopes of 20 posts each as JSON text, with gaps in the nested parts."""
    d = table(spark, folder, "documents")
    i = F.col("doc_id")
    as_text = lambda c: c.cast("string")
    post = F.struct(
        F.concat(F.lit("p"), as_text(i)).alias("id"), "text", "source",
        F.when(i % 13 != 0, F.concat(F.lit("https://posts.example/"), as_text(i))).alias("url"),
        F.lit("Tue Dec 10 07:00:30 2024").alias("createdAt"), "lang",
        F.when(i % 5 != 0, F.col("n_chars")).alias("likeCount"),
        as_text(i % 7).alias("viewCount"), (i % 3).alias("replyCount"),
        F.when(i % 4 != 0, F.concat(F.lit("c"), as_text(i % 97))).alias("conversationId"),
        (i % 4 != 0).alias("isReply"),
        F.when(i % 7 != 0, F.struct(
            F.concat(F.lit("a"), as_text(i % 150)).alias("id"),
            F.concat(F.lit("user"), as_text(i % 150)).alias("userName"), (i * 3).alias("followers"),
        )).alias("author"),
        F.when(i % 11 != 0, F.struct(
            F.array(
                F.struct(F.col("source").alias("text")), F.struct(F.lit("").alias("text")),
                F.struct(F.col("lang").alias("text")),
            ).alias("hashtags"),
            F.array(
                F.struct(
                    F.when(i % 3 == 0, F.lit("")).otherwise(F.lit("https://long.example/x")).alias("expanded_url"),
                    F.lit("https://t.co/s").alias("url"),
                ),
                F.struct(F.lit(None).cast("string").alias("expanded_url"), F.lit(None).cast("string").alias("url")),
            ).alias("urls"),
            F.array(F.struct(F.lit("ana").alias("screen_name"))).alias("user_mentions"),
        )).alias("entities"),
    )
    page = F.floor(i / PAGE_POSTS)
    # Pages have a fixed number of posts.
    pages = d.groupBy(page.alias("page")).agg(F.collect_list(post).alias("tweets"))
    cursor = F.when(F.col("page") % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("c"), as_text(F.col("page"))))
    envelope = lambda tweets: F.to_json(F.struct(
        tweets.alias("tweets"), cursor.alias("next_cursor"), (F.col("page") % 3 != 0).alias("has_next_page"),
    ))
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page") % 28).cast("int")), "yyyy-MM-dd")
    whole = pages.select("page", day.alias("search_date"), envelope(F.col("tweets")).alias("value"))
    # Besides: a page without posts for every ninth page, and the first half of every seventh, on a day of its own.
    empty = pages.filter("page % 9 = 8").select("page", day.alias("search_date"), envelope(F.lit(None).cast(pages.schema["tweets"].dataType)).alias("value"))
    broken = whole.filter("page % 7 = 0").select("page", F.lit(BROKEN_DAY).alias("search_date"), F.expr("left(value, length(value) div 2)").alias("value"))
    return whole.unionByName(empty).unionByName(broken)


@query("explode_pages", f"""
SELECT doc_id // {PAGE_POSTS} AS page, (doc_id // {PAGE_POSTS}) % 3 <> 0 AND (doc_id // {PAGE_POSTS}) % 4 <> 0 AS has_next,
       'p' || doc_id AS id, text
FROM documents""")
def explode_pages(spark, folder):
    exploded = sources.explode_pages(page_texts(spark, folder))
    return exploded.select("page", "has_next", F.col("post.id").alias("id"), F.col("post.text").alias("text"))


FLATTENED_SQL = f"""
SELECT strftime(DATE '2024-01-01' + CAST((doc_id // {PAGE_POSTS}) % 28 AS INTEGER), '%Y-%m-%d') AS search_date,
  'p' || doc_id AS id, CASE WHEN doc_id % 13 <> 0 THEN 'https://posts.example/' || doc_id ELSE '' END AS url,
  text, source, 'Tue Dec 10 07:00:30 2024' AS created_at, lang,
  CAST(0 AS BIGINT) AS retweet_count, doc_id % 3 AS reply_count,
  CASE WHEN doc_id % 5 <> 0 THEN n_chars ELSE 0 END AS like_count,
  CAST(0 AS BIGINT) AS quote_count, doc_id % 7 AS view_count, CAST(0 AS BIGINT) AS bookmark_count,
  CASE WHEN doc_id % 4 <> 0 THEN 'c' || doc_id % 97 ELSE '' END AS conversation_id,
  '' AS in_reply_to_id, '' AS in_reply_to_user_id, '' AS in_reply_to_username,
  doc_id % 4 <> 0 AS is_reply, false AS is_limited_reply,
  CASE WHEN doc_id % 7 <> 0 THEN 'a' || doc_id % 150 ELSE '' END AS author_id, '' AS author_name,
  CASE WHEN doc_id % 7 <> 0 THEN 'user' || doc_id % 150 ELSE '' END AS author_username, '' AS author_url,
  CASE WHEN doc_id % 7 <> 0 THEN doc_id * 3 ELSE 0 END AS author_followers, CAST(0 AS BIGINT) AS author_following,
  CASE WHEN doc_id % 11 <> 0 THEN source || '|' || lang ELSE '' END AS hashtags,
  CASE WHEN doc_id % 11 = 0 THEN '' WHEN doc_id % 3 = 0 THEN 'https://t.co/s' ELSE 'https://long.example/x' END AS urls,
  CASE WHEN doc_id % 11 <> 0 THEN 'ana' ELSE '' END AS mentions
FROM documents"""


@query("rejected_pages", f"""
SELECT DISTINCT doc_id // {PAGE_POSTS} AS page, '{BROKEN_DAY}' AS search_date FROM documents WHERE (doc_id // {PAGE_POSTS}) % 7 = 0""")
def rejected_pages(spark, folder):
    return sources.rejected_pages(page_texts(spark, folder)).select("page", "search_date")


@query("flatten_post", FLATTENED_SQL)
def flatten_post(spark, folder):
    flat = sources.flatten_post(sources.explode_pages(page_texts(spark, folder)))
    return sources.join_entities(flat).select(*schemas.POST_COLUMNS)


def vector_cells(spark, folder):
    """The vectors as text, and two more cells, broken and null, for every fifth."""
    e = table(spark, folder, "embeddings")
    whole = e.select("vec_id", F.to_json("embedding").alias("cell"))
    broken = e.filter("vec_id % 5 = 3").select((-1 - F.col("vec_id")).alias("vec_id"), F.lit("oops").alias("cell"))
    return whole.unionByName(broken).unionByName(broken.withColumn("cell", F.lit(None).cast("string")))


_PARSED_SQL = """SELECT vec_id, embedding AS v FROM embeddings
  UNION ALL SELECT -1 - vec_id, NULL FROM embeddings, (VALUES (1), (2)) WHERE vec_id % 5 = 3"""


@query("parse_vectors", f"""
SELECT vec_id, v IS NULL AS missing, CAST(len(v) AS INTEGER) AS size, list_transform(v, lambda x: round(CAST(x AS DOUBLE), 6)) AS components
FROM ({_PARSED_SQL})""")
def parse_vectors(spark, folder):
    v = VS.parse_vectors(vector_cells(spark, folder), "cell")
    return v.select(
        "vec_id", F.col("vector").isNull().alias("missing"),
        F.when(F.col("vector").isNotNull(), F.size("vector")).alias("size"),
        F.transform("vector", lambda x: F.round(x.cast("double"), 6)).alias("components"),
    )


@query("valid_vectors", f"""
SELECT vec_id, list_transform(v, lambda x: round(CAST(x AS DOUBLE), 6)) AS components FROM ({_PARSED_SQL}) WHERE v IS NOT NULL""")
def valid_vectors(spark, folder):
    v = VS.valid_vectors(VS.parse_vectors(vector_cells(spark, folder), "cell"))
    return v.select("vec_id", F.transform("vector", lambda x: F.round(x.cast("double"), 6)).alias("components"))


@query("parse_tokens", """
SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS n, text AS joined FROM documents
UNION ALL SELECT -1 - doc_id, 0, '' FROM documents, (VALUES (1), (2), (3)) WHERE doc_id % 5 = 3""")
def parse_tokens(spark, folder):
    d = table(spark, folder, "documents")
    cells = d.select("doc_id", F.to_json(F.split("text", " ")).alias("cell"))
    # Besides: broken, no list, and null, for every fifth document.
    for odd in ("[oops", '{"a": 1}', None):
        cells = cells.unionByName(d.filter("doc_id % 5 = 3").select((-1 - F.col("doc_id")).alias("doc_id"), F.lit(odd).cast("string").alias("cell")))
    t = VS.parse_token_lists(cells, "cell")
    return t.select("doc_id", F.size("tokens").alias("n"), F.array_join("tokens", " ").alias("joined"))


@query("read_stage_metadata", """
SELECT CAST(max(len(embedding)) AS BIGINT) AS vector_size, 'labels-' || count(DISTINCT label) AS model,
       'mean' AS pooling, CAST(128 AS BIGINT) AS max_length FROM embeddings""")
def read_stage_metadata(spark, folder):
    path = scratch_path(spark, "settings")
    e = table(spark, folder, "embeddings")
    sinks.write_stage_metadata(e.agg(
        F.max(F.size("embedding")).alias("vector_size"),
        F.concat(F.lit("labels-"), F.countDistinct("label").cast("string")).alias("model"),
    ), path)
    return M.read_stage_metadata(spark, path, M.ENCODER_DEFAULTS)


# --- sinks -----------------------------------------------------------------

@query("append_posts", _WITH_POSTS + """
SELECT search_date, count(*) * 2 AS stored, (SELECT count(*) FROM posts) AS appended FROM posts GROUP BY 1""")
def append_posts(spark, folder):
    path = scratch_path(spark, "posts")
    p = posts(spark, folder)
    sinks.append_posts(p, path)
    appended = sinks.append_posts(p, path)
    sinks.append_posts(p.filter("row_id IS NULL"), path)
    stored = sources.read_posts_table(spark, path)
    return L.completed_per_day(stored).select(
        "search_date", F.col("posts").alias("stored"), F.lit(appended).cast("bigint").alias("appended")
    )


@query("export_csv", f"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, text, '["' || array_to_string(t, '","') || '"]' AS tokens,
       '{{"chars":' || n_chars || '}}' AS counts
FROM (SELECT *, regexp_extract_all(text, {Q.lit(T.P.FEATURE_TOKEN)}) AS t FROM documents)""")
def export_csv(spark, folder):
    path = scratch_path(spark, "export")
    d = table(spark, folder, "documents").withColumns({
        "tokens": T.feature_tokens(F.col("text")), "counts": F.create_map(F.lit("chars"), F.col("n_chars")),
    })
    sinks.export_csv(d, path, ["doc_id", "lang", "text"], ["tokens", "counts"])
    return sources.read_posts_csv(spark, path)


@query("migrate_add_row_id", _WITH_POSTS + f"""
SELECT row_number() OVER (ORDER BY search_date, id, url) AS row_id, {', '.join(schemas.POST_COLUMNS)} FROM posts""")
def migrate(spark, folder):
    return migrate_add_row_id(posts(spark, folder).drop("row_id"), "search_date", "id", "url")


# --- ledger ----------------------------------------------------------------

_BUSIEST = "(SELECT query_key FROM ledger GROUP BY 1 ORDER BY count(*) DESC, query_key LIMIT 1)"


@query("ledger_range_filter", f"""WITH {LEDGER_SQL}
SELECT * FROM ledger WHERE query_key = {_BUSIEST} AND scrape_date BETWEEN '2024-01-05' AND '2024-01-20'""")
def ledger_range_filter(spark, folder):
    known = ledger(spark, folder)
    busiest = known.groupBy("query_key").count().orderBy(F.desc("count"), "query_key").limit(1)
    return L.ledger_range_filter(known, busiest.select("query_key").scalar(), "2024-01-05", "2024-01-20")


@query("exists_check", f"""WITH {LEDGER_SQL}
SELECT 'any' AS asked, EXISTS (SELECT 1 FROM ledger) AS found
UNION ALL SELECT 'late', EXISTS (SELECT 1 FROM ledger WHERE scrape_date > '2024-01-29')
UNION ALL SELECT 'none', EXISTS (SELECT 1 FROM ledger WHERE query_key = 'user=')""")
def exists_check(spark, folder):
    known = ledger(spark, folder)
    asked = {"any": None, "late": F.col("scrape_date") > "2024-01-29", "none": F.col("query_key") == "user="}
    parts = [L.exists_check(known, c).select(F.lit(name).alias("asked"), "found") for name, c in asked.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def user_ranges(spark, folder):
    """First and last event day of each user, with some bounds left out."""
    e = table(spark, folder, "events").groupBy("user_id").agg(
        F.min("ts").cast("date").alias("low"), F.max("ts").cast("date").alias("high")
    )
    return e.select(
        F.concat(F.lit("user="), F.col("user_id").cast("string")).alias("query_key"),
        F.when(F.col("user_id") % 4 < 2, F.col("high")).alias("newest"),
        F.when(F.col("user_id") % 2 == 0, F.col("low")).alias("oldest"),
    )


RANGES_SQL = """bounds AS (SELECT user_id, min(CAST(ts AS DATE)) AS low, max(CAST(ts AS DATE)) AS high FROM events GROUP BY 1),
asked AS (SELECT 'user=' || user_id AS query_key, CASE WHEN user_id % 4 < 2 THEN high END AS newest,
  CASE WHEN user_id % 2 = 0 THEN low END AS oldest FROM bounds),
ranges AS (SELECT query_key, coalesce(newest, oldest, DATE '2024-02-01') AS newest_date,
  coalesce(oldest, newest, DATE '2024-02-01') AS oldest_date, newest IS NULL AND oldest IS NULL AS keep_watching FROM asked)"""


def resolved(spark, folder):
    return L.resolve_date_range(
        user_ranges(spark, folder), "newest", "oldest", F.lit("2024-02-01").cast("date")
    )


@query("resolve_date_range", f"WITH {RANGES_SQL} SELECT * FROM ranges")
def resolve_date_range(spark, folder):
    return resolved(spark, folder)


@query("pending_dates", f"""WITH {LEDGER_SQL}, {RANGES_SQL},
days AS (SELECT query_key, CAST(unnest(generate_series(oldest_date, newest_date, INTERVAL 1 DAY)) AS DATE) AS pending_date FROM ranges)
SELECT query_key, pending_date FROM days
WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.query_key = days.query_key AND CAST(l.scrape_date AS DATE) = days.pending_date)""")
def pending_dates(spark, folder):
    pending = L.pending_dates(resolved(spark, folder), ledger(spark, folder))
    return pending.orderBy("query_key", F.desc("pending_date"))


@query("query_window_text", """
SELECT DISTINCT user_id, '#' || event_type || ' since:' || strftime(ts, '%Y-%m-%d') || '_00:00:00_UTC until:'
  || strftime(CAST(ts AS DATE) + 1, '%Y-%m-%d') || '_00:00:00_UTC' || CASE WHEN user_id % 2 = 0 THEN ' lang:pt' ELSE '' END AS search_text,
  'mode=date|query=#' || event_type || '|lang=' || CASE WHEN user_id % 2 = 0 THEN 'pt' ELSE '' END AS query_key
FROM events""")
def query_window_text(spark, folder):
    e = table(spark, folder, "events")
    base = F.concat(F.lit("#"), F.col("event_type"))
    lang = F.when(F.col("user_id") % 2 == 0, F.lit("pt")).otherwise(F.lit(""))
    return e.select(
        "user_id", L.query_window_text(F.col("ts").cast("date"), base, lang).alias("search_text"),
        L.query_key("date", base, lang).alias("query_key"),
    ).distinct()


@query("count_rows", _WITH_POSTS + "SELECT count(*) AS rows FROM posts")
def count_rows(spark, folder):
    return L.count_rows(posts(spark, folder))


@query("distinct_dates", _WITH_POSTS + """
SELECT DISTINCT CAST(search_date AS DATE) AS day FROM posts WHERE row_id % 3 <> 0""")
def distinct_dates(spark, folder):
    p = posts(spark, folder).withColumn(
        "search_date", F.when(F.col("row_id") % 3 == 0, F.lit("top")).otherwise(F.col("search_date"))
    )
    return L.distinct_dates(p)


@query("known_dates_union", _WITH_POSTS + """
SELECT DISTINCT CAST(search_date AS DATE) AS day FROM posts UNION SELECT DISTINCT CAST(ts AS DATE) FROM events
UNION SELECT CAST(max(ts) AS DATE) + 1 FROM events""")
def known_dates_union(spark, folder):
    events = table(spark, folder, "events")
    csv = events.select(F.date_format("ts", "yyyy-MM-dd").alias("search_date"))
    checkpoint = events.agg(F.concat(
        F.lit("last_completed_date="), F.date_format(F.date_add(F.max("ts").cast("date"), 1), "yyyy-MM-dd")
    ).alias("value"))
    return L.known_dates(posts(spark, folder), csv, checkpoint)


@query("concat_results", """
SELECT doc_id AS id, 'documents' AS origin, length(text) AS chars FROM documents
UNION ALL SELECT item_id, 'benchmark', length(text) FROM benchmark
UNION ALL SELECT conv_id * 1000 + turn, 'conversations', length(text) FROM conversations""")
def concat_results(spark, folder):
    chars = F.length("text").cast("bigint").alias("chars")
    part = lambda name, key: table(spark, folder, name).select(key.alias("id"), F.lit(name).alias("origin"), chars)
    return concat_tables([
        part("documents", F.col("doc_id")), part("benchmark", F.col("item_id")),
        part("conversations", F.col("conv_id") * 1000 + F.col("turn")),
    ])


@query("seed_ledger", f"""WITH {POSTS_SQL}, {LEDGER_SQL}
SELECT 'empty' AS start, 'k' AS query_key, search_date AS scrape_date, max(created_at) AS completed_at FROM posts GROUP BY 3
UNION ALL SELECT 'filled', * FROM ledger""")
def seed_ledger(spark, folder):
    known, p = ledger(spark, folder), posts(spark, folder)
    days = L.distinct_dates(p)
    stamp = F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit("T03:04:05"))
    empty = L.seed_ledger(known.filter("query_key IS NULL"), days, "k", stamp)
    filled = L.seed_ledger(known, days, "k", stamp)
    columns = ["query_key", "scrape_date", "completed_at"]
    return empty.select(F.lit("empty").alias("start"), *columns).unionByName(
        filled.select(F.lit("filled").alias("start"), *columns)
    )


@query("mark_completed", f"""WITH {LEDGER_SQL},
finished AS (SELECT DISTINCT 'user=' || user_id AS query_key, strftime(CAST(ts AS DATE) + 1, '%Y-%m-%d') AS scrape_date,
  '2024-01-15T00:00:00' AS completed_at FROM events)
SELECT query_key, scrape_date, max(completed_at) AS completed_at
FROM (SELECT * FROM ledger UNION ALL SELECT * FROM finished) GROUP BY 1, 2""")
def mark_completed(spark, folder):
    finished = table(spark, folder, "events").select(
        F.concat(F.lit("user="), F.col("user_id").cast("string")).alias("query_key"),
        F.date_format(F.date_add(F.col("ts").cast("date"), 1), "yyyy-MM-dd").alias("scrape_date"),
        F.lit("2024-01-15T00:00:00").alias("completed_at"),
    ).distinct()
    known = ledger(spark, folder)
    return L.mark_completed(L.mark_completed(known, finished), finished)


@query("completed_per_day", _WITH_POSTS + "SELECT search_date, count(*) AS posts FROM posts GROUP BY 1")
def completed_per_day(spark, folder):
    return L.completed_per_day(posts(spark, folder))


@query("ingest_totals", _WITH_POSTS + """
SELECT count(*) AS rows, count(DISTINCT search_date) AS days, min(search_date) AS first_day, max(search_date) AS last_day FROM posts""")
def ingest_totals(spark, folder):
    return L.ingest_totals(posts(spark, folder))
