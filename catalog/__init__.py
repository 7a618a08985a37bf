"""All registered queries with their oracle SQL."""

from catalog import ingest_queries, job_queries, text_queries, vector_queries  # noqa: F401
from catalog.base import ORACLES, QUERIES  # noqa: F401
