"""Registry of checked queries and the tables they start from.

Every query reads the given tables in full.  `posts` and the other derived
tables are built by the same rules in Spark and in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register a query and, where SQL can express it, its oracle."""

    def register(function):
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


def cores(spark: SparkSession) -> int:
    """The tasks the catalog deals costly per-row work over: the cluster's default parallelism."""
    return spark.sparkContext.defaultParallelism


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


# --- posts derived from documents -----------------------------------------

_SAME = {
    "row_id": "doc_id",
    "id": "'p' || CAST(doc_id - doc_id % 2 AS VARCHAR(20))",
    "url": "'https://posts.example/' || CAST(doc_id AS VARCHAR(20))",
    "text": "text || ' https://ex.org/' || CAST(doc_id AS VARCHAR(20)) || ' #' || source || ' @u_' || CAST(doc_id AS VARCHAR(20))",
    "source": "source",
    "lang": "lang",
    "retweet_count": "doc_id * 7 % 23 - 2",
    "reply_count": "doc_id % 3",
    "like_count": "n_chars",
    "quote_count": "doc_id % 120",
    "view_count": "n_chars * n_chars",
    "bookmark_count": "doc_id * 31 % 1200",
    "conversation_id": "'c' || CAST(doc_id % 97 AS VARCHAR(20))",
    "in_reply_to_id": "CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'p' || CAST(doc_id % 89 AS VARCHAR(20)) END",
    "in_reply_to_user_id": "CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'a' || CAST(doc_id % 53 AS VARCHAR(20)) END",
    "in_reply_to_username": "CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'user' || CAST(doc_id % 53 AS VARCHAR(20)) END",
    "is_reply": "doc_id % 4 <> 0",
    "is_limited_reply": "doc_id % 10 = 0",
    "author_id": "'a' || CAST(doc_id % 150 AS VARCHAR(20))",
    "author_name": "'Author ' || CAST(doc_id % 150 AS VARCHAR(20))",
    "author_username": "'user' || CAST(doc_id % 150 AS VARCHAR(20))",
    "author_url": "'https://people.example/' || CAST(doc_id % 150 AS VARCHAR(20))",
    "author_followers": "doc_id * doc_id % 20000",
    "author_following": "doc_id % 1100",
    "hashtags": "CASE WHEN doc_id % 5 = 0 THEN '' ELSE source || '| ' || lang || ' ||' END",
    "urls": "'https://ex.org/' || CAST(doc_id AS VARCHAR(20))",
    "mentions": "'u_' || CAST(doc_id AS VARCHAR(20))",
}
_SPARK_DAY = "date_format(date_add(DATE'2024-01-01', CAST(doc_id % 28 AS INT)), 'yyyy-MM-dd')"
_DUCK_DAY = "strftime(DATE '2024-01-01' + CAST(doc_id % 28 AS INTEGER), '%Y-%m-%d')"


def posts(spark: SparkSession, folder: str) -> DataFrame:
    """29 columns; every id occurs twice, entities are `|`-joined text."""
    same = [f"{sql} AS {name}" for name, sql in _SAME.items()]
    return table(spark, folder, "documents").selectExpr(
        *same, f"{_SPARK_DAY} AS search_date", f"{_SPARK_DAY} || 'T03:04:05' AS created_at"
    )


POSTS_SQL = (
    "posts AS (SELECT "
    + ", ".join(f"{sql} AS {name}" for name, sql in _SAME.items())
    + f", {_DUCK_DAY} AS search_date, {_DUCK_DAY} || 'T03:04:05' AS created_at FROM documents)"
)


# --- ledger derived from events -------------------------------------------

def ledger(spark: SparkSession, folder: str) -> DataFrame:
    """A finished day for each user and each day with events of that user."""
    events = table(spark, folder, "events")
    return events.groupBy(
        F.concat(F.lit("user="), F.col("user_id").cast("string")).alias("query_key"),
        F.date_format("ts", "yyyy-MM-dd").alias("scrape_date"),
    ).agg(F.date_format(F.max("ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("completed_at"))


LEDGER_SQL = """ledger AS (
  SELECT 'user=' || user_id AS query_key, strftime(ts, '%Y-%m-%d') AS scrape_date,
         strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS completed_at
  FROM events GROUP BY 1, 2)"""


# --- vectors ---------------------------------------------------------------

def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.col("embedding").alias("vector"), "label"
    )


VECTORS_SQL = """vecs AS (
  SELECT vec_id AS row_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS vector, label
  FROM embeddings)"""


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison with the oracle."""
    return df.withColumns({name: F.round(name, digits) for name in names})
