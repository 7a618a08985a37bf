import json

import pytest
from pyspark.sql import functions as F

from tidepost import schemas
from tidepost.operators import ledger as L
from tidepost.operators.anonymize import anonymize_posts
from tidepost.operators.row_ids import assign_row_ids, migrate_add_row_id, short_ids
from tidepost.sinks import posts as sinks
from tidepost.sources import posts as sources
from tidepost.sources.posts import explode_pages, flatten_post, rejected_pages
from tidepost.sources.metadata import ENCODER_DEFAULTS, read_stage_metadata

FULL = {
    "id": 7, "text": "olá", "likeCount": "12", "viewCount": 3.9, "isReply": True, "author": {"id": "a", "followers": 5},
    "entities": {
        "hashtags": [{"text": "x"}, {"text": ""}, {}],
        "urls": [{"expanded_url": "", "url": "u1"}, {"expanded_url": "e2", "url": "u2"}, {}],
        "user_mentions": [{"screen_name": "m"}],
    },
}


def pages(spark, *payloads):
    rows = [(json.dumps(p), "2024-01-01") for p in payloads]
    return spark.createDataFrame(rows, "value string, search_date string")


def test_pages_and_posts(spark):
    df = pages(
        spark, {"tweets": [FULL, {"id": "7", "author": None, "entities": None, "likeCount": None}],
                "has_next_page": True, "next_cursor": "c"},
        {"has_next_page": True, "next_cursor": ""}, {"tweets": []},
    )
    assert [r.has_next for r in sources.parse_pages(df).collect()] == [True, False, False]
    flat = sources.flatten_post(sources.explode_pages(df)).select(*schemas.POST_COLUMNS).collect()
    assert len(flat) == 2
    full, bare = flat
    assert (full.id, full.like_count, full.view_count, full.is_reply, full.author_followers) == ("7", 12, 3, True, 5)
    assert (full.hashtags, full.urls, full.mentions) == (["x"], ["u1", "e2"], ["m"])
    assert (bare.id, bare.text, bare.like_count, bare.is_reply, bare.author_name, bare.hashtags) == ("7", "", 0, False, "", [])


def test_count_that_is_no_number_raises(spark):
    df = pages(spark, {"tweets": [{"id": "1", "likeCount": "many"}]})
    with pytest.raises(Exception, match="like_count is not a number"):
        sources.flatten_post(sources.explode_pages(df)).collect()


def post_rows(spark, texts):
    df = spark.createDataFrame([(f"p{i}", t) for i, t in enumerate(texts)], "id string, text string")
    for name in schemas.POST_COLUMNS:
        if name in ("id", "text"):
            continue
        value = F.lit("2024-01-0").cast("string") if name == "search_date" else F.lit("")
        if name.endswith("count") or name in ("author_followers", "author_following"):
            value = F.lit(5).cast("bigint")
        elif name.startswith("is_"):
            value = F.lit(True)
        df = df.withColumn(name, value)
    return df.withColumn("search_date", F.concat("search_date", F.substring("id", 2, 1))).select(*schemas.POST_COLUMNS)


TEXTS = ['a "quoted", text', "two\nlines", "", "último"]


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "csv")
    sinks.export_csv(post_rows(spark, TEXTS).withColumn("tokens", F.split("text", " ")), path, ["id", "text"], ["tokens"])
    back = {r.id: (r.text, json.loads(r.tokens)) for r in sources.read_posts_csv(spark, path).collect()}
    assert back == {f"p{i}": (t, t.split(" ")) for i, t in enumerate(TEXTS)}
    sinks.export_csv(post_rows(spark, TEXTS).limit(0), path + "2", ["id"], [])
    with pytest.raises(ValueError, match="no rows"):
        sources.read_posts_csv(spark, path + "2")


def test_append_keeps_duplicates(spark, tmp_path):
    path = str(tmp_path / "posts")
    df = post_rows(spark, TEXTS).withColumn("row_id", F.lit(1))
    assert [sinks.append_posts(df, path), sinks.append_posts(df, path), sinks.append_posts(df.limit(0), path)] == [4, 4, 0]
    stored = sources.read_posts_table(spark, path)
    assert stored.count() == 8 and dict(stored.dtypes)["search_date"] == "string"
    plan = sources.read_posts_table(spark, path).filter("search_date = '2024-01-01'")._jdf.queryExecution().toString()
    assert "author_name" not in plan.split("ReadSchema")[1]


@pytest.mark.parametrize("partitions", [1, 7])
def test_row_ids_are_dense_and_ordered(spark, partitions):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v")).repartition(partitions)
    rows = assign_row_ids(df, "v").orderBy("row_id").collect()
    assert [(r.row_id, r.v) for r in rows] == [(i + 1, i) for i in range(1000)]


def test_migrate_keeps_rows_and_columns(spark):
    df = post_rows(spark, TEXTS)
    new = migrate_add_row_id(df, "search_date", "id")
    assert new.columns == ["row_id", *schemas.POST_COLUMNS]
    assert [r.id for r in new.orderBy("row_id").collect()] == ["p0", "p1", "p2", "p3"]
    again = migrate_add_row_id(new, "search_date", "id")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, new.collect()))


def test_short_ids_use_the_first_position(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "c"), (5, None)], "pos int, s string")
    assert [r.sid for r in short_ids(df, "s", "pos").orderBy("pos").collect()] == ["S1", "S2", "S1", "S4", None]


PAGE = {"tweets": [{"id": "1", "text": "a"}, {"id": "2", "text": "b"}], "next_cursor": "c", "has_next_page": True}


@pytest.mark.parametrize("value, posts, rejected", [
    (json.dumps(PAGE), 2, 0), (json.dumps(PAGE, indent=2), 2, 0), (json.dumps(PAGE) + "\n" + json.dumps(PAGE) + "\n", 4, 0),
    (json.dumps(PAGE)[:-9], 0, 1), (json.dumps(PAGE) + "\n" + json.dumps(PAGE)[:-9], 0, 1), (json.dumps(PAGE) + " x", 0, 1),
    ("{}", 0, 0), ('{"tweets": null}', 0, 0), ('{"tweets": []}', 0, 0), ('{"tweets": "oops"}', 0, 1), ("", 0, 1), (None, 0, 1), ("[]", 0, 1), ("7", 0, 1),
])
def test_no_page_is_lost(spark, value, posts, rejected):
    df = spark.createDataFrame([(value, 1)], "value string, page int")
    assert (explode_pages(df).count(), rejected_pages(df).count()) == (posts, rejected)


def test_count_beyond_64_bits_raises(spark):
    df = spark.createDataFrame([(json.dumps({"tweets": [{"id": "1", "viewCount": "9" * 20}]}), "2024-01-01")], "value string, search_date string")
    with pytest.raises(Exception, match="view_count does not fit"):
        flatten_post(explode_pages(df)).collect()


def test_anonymized_columns(spark):
    out = anonymize_posts(post_rows(spark, ["@ana em recuperação https://x.y", ""]))
    assert out.columns == schemas.ANONYMIZED_COLUMNS
    hidden = {"id", "url", "text", "author_id", "author_name", "author_username", "author_url", "in_reply_to_id",
              "in_reply_to_user_id", "in_reply_to_username", "conversation_id", "hashtags", "urls", "mentions"}
    assert not hidden & set(out.columns)
    row = out.first()
    assert (row.text_redacted, row.text_length, row.contains_recovery_term) == ("[mention] em recuperação [url]", 31, True)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_metadata_defaults(spark, tmp_path):
    path = str(tmp_path / "settings")
    sinks.write_stage_metadata(spark.sql("SELECT 'm' AS model, 5 AS vector_size"), path)
    row = read_stage_metadata(spark, path, ENCODER_DEFAULTS).first()
    assert (row.model, row.vector_size, row.pooling, row.max_length) == ("m", 5, "mean", 128)
    # A stated null means that nothing was cut.
    sinks.write_stage_metadata(spark.sql("SELECT 'm' AS model, CAST(NULL AS int) AS max_length"), path)
    assert read_stage_metadata(spark, path, ENCODER_DEFAULTS).first().max_length is None


# --- ledger ----------------------------------------------------------------

def ledger_of(spark, rows):
    return spark.createDataFrame(rows, "query_key string, scrape_date string, completed_at string")


def test_pending_dates(spark):
    known = ledger_of(spark, [("k", "2024-01-02", "t"), ("other", "2024-01-01", "t"), ("k", "top", "t")])
    ranges = spark.sql("SELECT 'k' AS query_key, date'2024-01-01' AS oldest_date, date'2024-01-03' AS newest_date")
    days = [str(r.pending_date) for r in L.pending_dates(ranges, known).orderBy(F.desc("pending_date")).collect()]
    assert days == ["2024-01-03", "2024-01-01"]
    done = spark.sql("SELECT 'k' AS query_key, date'2024-01-02' AS oldest_date, date'2024-01-02' AS newest_date")
    assert L.pending_dates(done, known).isEmpty()


def test_date_range(spark):
    df = spark.sql("SELECT cast(NULL AS date) AS newest, date'2024-01-02' AS oldest UNION ALL SELECT NULL, NULL")
    rows = L.resolve_date_range(df, "newest", "oldest", F.lit("2024-02-01").cast("date")).collect()
    assert [(str(r.newest_date), str(r.oldest_date), r.keep_watching) for r in rows] == [
        ("2024-01-02", "2024-01-02", False), ("2024-02-01", "2024-02-01", True)]
    bad = spark.sql("SELECT date'2024-01-01' AS newest, date'2024-01-02' AS oldest")
    with pytest.raises(Exception, match="after the newest"):
        L.resolve_date_range(bad, "newest", "oldest").collect()


def test_known_dates_and_seed(spark):
    table = spark.createDataFrame([("2024-01-01",), ("top",), ("",)], "search_date string")
    csv = spark.createDataFrame([("2024-01-02",)], "search_date string")
    note = spark.createDataFrame([(" last_completed_date=2024-01-03 ",), ("2024-01-01",), ("",)], "value string")
    days = L.known_dates(table, csv, note)
    assert sorted(str(r.day) for r in days.collect()) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    empty = ledger_of(spark, [])
    assert L.seed_ledger(empty, days, "k", F.lit("t")).count() == 3
    filled = ledger_of(spark, [("other", "2024-01-09", "t")])
    assert L.seed_ledger(filled, days, "k", F.lit("t")).count() == 1


def test_mark_completed_is_an_idempotent_upsert(spark):
    known = ledger_of(spark, [("k", "2024-01-01", "1"), ("k", "2024-01-02", "1")])
    new = ledger_of(spark, [("k", "2024-01-02", "2"), ("k", "2024-01-03", "2")])
    once = L.mark_completed(known, new)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, L.mark_completed(once, new).collect()))
    assert {r.scrape_date: r.completed_at for r in once.collect()} == {
        "2024-01-01": "1", "2024-01-02": "2", "2024-01-03": "2"}


def test_count_rows_refuses_nothing(spark):
    assert L.count_rows(spark.range(3)).first().rows == 3
    with pytest.raises(Exception, match="no rows"):
        L.count_rows(spark.range(0)).collect()


def test_query_texts(spark):
    df = spark.sql("SELECT date'2024-02-28' AS d")
    row = df.select(
        L.query_window_text(F.col("d"), "#x", "pt").alias("a"), L.query_window_text(F.col("d"), "#x", None).alias("b"),
        L.query_key("top", "#x", None).alias("k"),
    ).first()
    assert row.a == "#x since:2024-02-28_00:00:00_UTC until:2024-02-29_00:00:00_UTC lang:pt"
    assert row.b.endswith("_UTC") and row.k == "mode=top|query=#x|lang="
