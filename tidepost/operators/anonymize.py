"""De-identified export of posts: one projection, no shuffle."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, functions as F

from tidepost import schemas
from tidepost.checks import require_columns, require_rows
from tidepost.functions import text as T
from tidepost.sinks.posts import export_csv

_COUNTS = list(schemas.COUNT_FIELDS)
_NEEDED = [
    "search_date", "created_at", "lang", "source", "text", "is_reply", "is_limited_reply",
    *_COUNTS, *schemas.ENTITY_COLUMNS,
]


def anonymize_posts(df: DataFrame, terms: Iterable[str] = T.RECOVERY_TERMS) -> DataFrame:
    """The fixed anonymized columns; ids, names and links are gone.

    `hashtags`, `urls` and `mentions` are `|`-joined text or arrays.  Free text
    keeps whatever names people wrote in prose.
    """
    require_columns(df, *_NEEDED)
    types = dict(df.dtypes)
    text = T.text_or_empty(F.col("text"))

    def entity_count(name: str):
        if types[name].startswith("array"):
            return F.size(F.filter(F.coalesce(name, F.array()), lambda item: item != ""))
        return F.size(T.split_pipe(F.col(name)))

    columns = {
        "search_date": T.truncate_date(F.col("search_date")),
        "created_date": T.truncate_date(F.col("created_at")),
        "lang": T.text_or_empty(F.col("lang")),
        "source": T.text_or_empty(F.col("source")),
        "text_redacted": T.redact_text(text),
        "text_length": F.length(text),
        "is_reply": F.coalesce(F.col("is_reply").cast("boolean"), F.lit(False)),
        "is_limited_reply": F.coalesce(F.col("is_limited_reply").cast("boolean"), F.lit(False)),
        "contains_recovery_term": T.contains_recovery_term(text, terms),
    }
    columns |= {f"{name}_bucket": T.bucketize_metric(F.col(name)) for name in _COUNTS}
    columns |= {f"{name}_count": entity_count(name) for name in schemas.ENTITY_COLUMNS}
    return df.select(*[columns[name].alias(name) for name in schemas.ANONYMIZED_COLUMNS])


def export_anonymized(posts: DataFrame, path: str, terms: Iterable[str] = T.RECOVERY_TERMS) -> int:
    """Write the anonymized posts as CSV; returns the number of rows, and raises if there is none."""
    rows = anonymize_posts(require_rows(posts, "no posts to export"), terms)
    written = Observation()
    export_csv(rows.observe(written, F.count(F.lit(1)).alias("rows")), path, schemas.ANONYMIZED_COLUMNS, [])
    return written.get["rows"]
