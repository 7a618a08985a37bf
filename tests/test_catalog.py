import duckdb
import pytest

import catalog
from tools.check_queries import TABLES, rows_of

# One of each kind at the smallest scale; tools/check_queries.py runs them all.
CHECKED = [
    "anonymize_posts", "stem_tokens", "flatten_post", "pending_dates", "top_terms_per_language",
    "mean_word_vector_fallback", "similarity_stats", "assign_nearest_centroid", "stream_daily_counts",
]


@pytest.mark.parametrize("key", CHECKED)
def test_query_matches_its_oracle(spark, tables, key):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{name}.parquet'")
    df = catalog.QUERIES[key](spark, tables)
    cursor = db.execute(catalog.ORACLES[key])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cursor.fetchall())


def test_every_oracle_has_a_query():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)


def test_no_cross_joins_in_the_plans(spark, tables):
    for key in ("tfidf", "semantic_search", "center_vectors", "assign_nearest_centroid", "similarity_pairs"):
        plan = catalog.QUERIES[key](spark, tables)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, key
