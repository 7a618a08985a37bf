"""Sidecar JSON with the settings of a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Settings used where a sidecar file lacks the key.
ENCODER_DEFAULTS = {"model": "default", "vector_size": 768, "pooling": "mean", "max_length": 128}
WORD2VEC_DEFAULTS = {"vector_size": 100, "window": 5, "min_count": 1, "sg": 0}


def read_stage_metadata(spark: SparkSession, path: str, defaults: dict) -> DataFrame:
    """One row with the keys of `defaults`; the fallback value holds where the file lacks the key, a stated null stays."""
    ddl = ", ".join(
        f"`{key}` {'string' if isinstance(value, str) else 'bigint'}"
        for key, value in defaults.items()
    )
    df = spark.read.text(path, wholetext=True).filter(F.trim("value") != "")
    parsed = df.select(F.from_json("value", ddl).alias("_s"), F.json_object_keys("value").alias("_keys"))
    stated = lambda k: F.array_contains(F.coalesce("_keys", F.array().cast("array<string>")), k)
    return parsed.select(*[F.when(stated(k), F.col(f"_s.`{k}`")).otherwise(F.lit(v)).alias(k) for k, v in defaults.items()])
