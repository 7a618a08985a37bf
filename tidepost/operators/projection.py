"""Principal components of centered vectors."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from tidepost.checks import require_columns
from tidepost.functions import vectors as V
from tidepost.operators.similarity import center_vectors
from tidepost.operators.vector_sums import vector_sum
from tidepost.session import materialize


@dataclass(frozen=True)
class Projection:
    """Components (d x k, signs fixed), variance ratios and the projected rows."""

    components: np.ndarray
    ratios: list[float]
    rows: DataFrame


def pca_project(df: DataFrame, key: str = "row_id", vector: str = "vector", k: int = 2) -> Projection:
    """(key, pc1..pck) of the centered vectors.

    The sign of a component is fixed so that its largest loading is positive.
    The covariance is a tree aggregation; only d x k numbers reach the driver.
    """
    require_columns(df, key, vector)
    centered = center_vectors(df.filter(F.col(vector).isNotNull()).select(key, vector), vector)
    features = centered.select(key, "centered", array_to_vector("centered").alias("features"))
    model = PCA(k=k, inputCol="features", outputCol="projected").fit(features)
    components = model.pc.toArray()
    largest = components[np.abs(components).argmax(axis=0), range(k)]
    components = components * np.where(largest < 0, -1.0, 1.0)
    rows = centered.select(
        key,
        *[
            V.dot(F.col("centered"), F.array(*[F.lit(float(x)) for x in components[:, c]])).alias(f"pc{c + 1}")
            for c in range(k)
        ],
    )
    return Projection(components, [float(r) for r in model.explainedVariance.toArray()], rows)


def explained_variance(projection: Projection, df: DataFrame) -> DataFrame:
    """(component, ratio, total_ratio) of a projection."""
    total = float(sum(projection.ratios))
    return df.sparkSession.createDataFrame(
        [(f"pc{i + 1}", ratio, total) for i, ratio in enumerate(projection.ratios)],
        "component string, ratio double, total_ratio double",
    )


def project_all_models(df: DataFrame, key: str, k: int = 2) -> DataFrame:
    """(model, pooling, key, pc1..pck): one projection per embedding family, all families at once."""
    return project_families(df, key, k).rows


@dataclass(frozen=True)
class FamilyProjection:
    """Per family: the projected rows, the components (signs fixed) and the shares of variance."""

    rows: DataFrame
    components: DataFrame
    ratios: DataFrame


def _partial_grams(family: list[str]):
    """mapInPandas: per family, the sums of centered outer products of a partition's rows, as Gram rows."""
    def run(batches):
        sums = {}
        for batch in batches:
            for keys, part in batch.groupby(family, sort=False, dropna=False):
                block = np.stack(part["_c"].to_numpy())
                gram = block.T @ block
                sums[keys] = sums[keys] + gram if keys in sums else gram
        for (model, pooling), gram in sums.items():
            yield pd.DataFrame({"model": model, "pooling": pooling, "i": np.arange(len(gram)), "g": list(gram)})

    return run


def _components(k: int):
    """applyInPandas per family: the k leading eigenvectors of its covariance and every eigenvalue's share."""
    def run(gram: pd.DataFrame) -> pd.DataFrame:
        gram = gram.sort_values("i")
        matrix = np.stack(gram["g"].to_numpy())
        values, vectors = np.linalg.eigh((matrix + matrix.T) / 2)
        order = np.argsort(values)[::-1][:k]
        total = float(values.clip(min=0).sum()) or 1.0
        picked = vectors[:, order]
        largest = picked[np.abs(picked).argmax(axis=0), range(picked.shape[1])]
        picked = picked * np.where(largest < 0, -1.0, 1.0)
        return pd.DataFrame({
            "model": gram["model"].iloc[0], "pooling": gram["pooling"].iloc[0], "component": np.arange(1, len(order) + 1),
            "loading": list(picked.T), "ratio": values[order].clip(min=0) / total,
        })

    return run


def project_families(df: DataFrame, key: str, k: int = 2) -> FamilyProjection:
    """(model, pooling, key, pc1..pck) of every family at once.

    Each family is centered by its mean (grouped sums); partial sums of outer products per
    family are made inside each task and added as Gram rows grouped by (family, row of the
    matrix), so the d x d covariance is all that meets in one task, whatever the number of rows;
    `eigh` of it gives the components (largest loading positive) and shares of variance.  A
    component beyond the rank of a family has ratio 0.  Rows without vector are left out.
    """
    require_columns(df, "model", "pooling", key, "vector")
    family = ["model", "pooling"]
    rows = df.where(F.col("vector").isNotNull()).select(*family, F.col(key).alias("_key"), V.as_double(F.col("vector")).alias("_v"))
    means = rows.groupBy(*family).agg(vector_sum(F.col("_v")).alias("_s"), F.count(F.lit(1)).alias("_n")).select(
        *family, F.transform("_s", lambda x: x / F.col("_n")).alias("_m")
    )
    centered = materialize(
        rows.join(means, family).select(*family, "_key", F.zip_with("_v", "_m", lambda a, b: a - b).alias("_c")), "centered-families"
    )
    grams = centered.select(*family, "_c").mapInPandas(_partial_grams(family), "model string, pooling string, i long, g array<double>")
    summed = grams.groupBy(*family, "i").agg(vector_sum(F.col("g")).alias("g"))
    found = materialize(
        summed.groupBy(*family).applyInPandas(
            _components(k), "model string, pooling string, component int, loading array<double>, ratio double"
        ),
        "family-components",
    )
    packed = found.groupBy(*family).agg(F.collect_list(F.struct("component", "loading")).alias("_pcs"))
    joined = centered.join(packed, family)
    pick = lambda c: F.filter("_pcs", lambda p: p["component"] == c)
    projected = joined.select(
        *family, F.col("_key").alias(key),
        *[F.coalesce(V.dot(F.col("_c"), F.get(pick(c), 0)["loading"]), F.lit(0.0)).alias(f"pc{c}") for c in range(1, k + 1)],
    )
    return FamilyProjection(projected, found.select(*family, "component", "loading"), found.select(*family, "component", "ratio"))
