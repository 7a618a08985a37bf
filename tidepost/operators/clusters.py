"""K-means with restarts, assignment and cluster summaries."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidepost.checks import require_columns
from tidepost.functions import vectors as V
from tidepost.functions.text import snippet
from tidepost.operators.encoder import concat_results
from tidepost.operators.vector_sums import vector_sum
from tidepost.operators.word_blocks import list_column
from tidepost.session import materialize

# Settings of the clustering.
CLUSTERS = 5
RESTARTS = 10
SEED = 42
# Centroids met by a row at a time.
CENTROID_BLOCK = 1024
# Numbers of a partition's rows, and of a stored block of one family's rows.
BLOCK_VALUES, STORED_VALUES = 1 << 20, 1 << 16
# A reader holds up to 4096 lines of a row group at once, so blocks are stored in small ones.
STORED_AS = {"parquet.block.size": str(2 << 20), "parquet.block.size.row.check.min": "16", "parquet.page.size.row.check.min": "1", "parquet.enable.dictionary": "false"}
# Families whose sums a task keeps at once.
KEPT_FAMILIES = 64


@dataclass(frozen=True)
class Clustering:
    """The best of several runs, with the cost of each."""

    model: KMeansModel
    costs: list[float]
    assigned: DataFrame


def kmeans(df: DataFrame, key: str = "row_id", vector: str = "vector", k: int = CLUSTERS,
           restarts: int = RESTARTS, seed: int = SEED, max_iter: int = 300, parallelism: int = 4) -> Clustering:
    """Euclidean K-means on the vectors; the run with the lowest cost wins.

    Runs are independent Spark jobs; a few are submitted at a time.
    """
    require_columns(df, key, vector)
    rows = df.filter(F.col(vector).isNotNull())
    # A table of few large files is clustered by as many tasks as its numbers ask for.
    parts = -(-(rows.agg(F.sum(F.size(vector).cast("long"))).first()[0] or 0) // BLOCK_VALUES)
    if parts > rows.rdd.getNumPartitions():
        rows = rows.repartition(parts, key)
    # Stored, not persisted: a fit over a persisted table decodes it twice in every iteration, over
    # any other it keeps the decoded vectors with their norms until it ends.
    features = materialize(rows.select(key, array_to_vector(V.as_double(F.col(vector))).alias("features")), "kmeans-features")

    def fit(run: int) -> KMeansModel:
        return KMeans(k=k, seed=seed + run, maxIter=max_iter, predictionCol="cluster").fit(features)

    with ThreadPool(min(parallelism, restarts)) as pool:
        models = pool.map(inheritable_thread_target(df.sparkSession)(fit), range(restarts))
    costs = [model.summary.trainingCost for model in models]
    best = models[costs.index(min(costs))]
    assigned = materialize(best.transform(features).select(key, "cluster"), "clusters")
    return Clustering(best, costs, assigned)


@dataclass(frozen=True)
class FamilyClustering:
    """Per family: the assignment of the cheapest restart, all restarts' costs, the final centroids."""

    assigned: DataFrame
    costs: DataFrame
    centroids: DataFrame


def _pack_points(single: bool):
    """mapInPandas: a batch's rows as blocks of at most STORED_VALUES numbers of one family."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (model, pooling), part in batch.groupby(["model", "pooling"], sort=False):
                points = np.stack(part["_v"].to_numpy()).astype("<f4" if single else "<f8")
                step = max(1, min(BLOCK_VALUES, STORED_VALUES) // max(1, points.shape[1]))
                for at in range(0, len(part), step):
                    yield pd.DataFrame({
                        "model": [model], "pooling": [pooling], "_keys": [part["_key"].iloc[at:at + step].tolist()],
                        "_points": [points[at:at + step].tobytes()],
                    })

    return run


def _nearest(single: bool, sums: bool):
    """mapInArrow: per block and restart, the nearest centroid of each row (ties go to the lower cluster).

    Yields the sum and number of a task's rows per family and cluster, or each row with its cluster and squared distance.
    """
    def lines_of(families: dict, kinds: tuple) -> Iterator[pa.RecordBatch]:
        for (model, pooling), (restart, cluster, s, n) in families.items():
            used = np.flatnonzero(n)
            same = [pa.array([value] * len(used), kind) for value, kind in zip((model, pooling), kinds)]
            yield pa.record_batch({
                "model": same[0], "pooling": same[1], "restart": pa.array(restart[used], pa.int32()),
                "cluster": pa.array(cluster[used], pa.int32()), "s": list_column(s[used]), "n": pa.array(n[used]),
            })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        families, kinds = {}, ()
        for batch in batches:
            column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            kinds, out = (column["model"].type, column["pooling"].type), []
            for i in range(batch.num_rows):
                family = (column["model"][i].as_py(), column["pooling"][i].as_py())
                restart, cluster = (np.asarray(column[c][i].values) for c in ("restarts", "clusters"))
                lines = np.asarray(column["lines"][i].values, float).reshape(len(cluster), -1)
                points = np.frombuffer(column["points"][i].as_buffer(), "<f4" if single else "<f8").reshape(-1, lines.shape[1]).astype(float)
                # Differences, not products: as exact as the squared distance they stand for.
                squared = np.empty((len(points), len(cluster)))
                for j, line in enumerate(lines):
                    off = points - line
                    squared[:, j] = np.einsum("ij,ij->i", off, off)
                if sums and family not in families:
                    if len(families) >= KEPT_FAMILIES:
                        yield from lines_of(families, kinds)
                        families = {}
                    families[family] = (restart, cluster, np.zeros(lines.shape), np.zeros(len(cluster), np.int64))
                for r in np.unique(restart):
                    mine = np.flatnonzero(restart == r)
                    best = squared[:, mine].argmin(axis=1)
                    if sums:
                        _, _, s, n = families[family]
                        for u in np.unique(best):
                            s[mine[u]] += points[best == u].sum(axis=0)
                            n[mine[u]] += (best == u).sum()
                    else:
                        same = [pa.array([value] * len(points), kind) for value, kind in zip(family, kinds)]
                        out.append(pa.record_batch({
                            "model": same[0], "pooling": same[1], "_key": column["keys"][i].values,
                            "restart": pa.array(np.full(len(points), r), pa.int32()), "cluster": pa.array(cluster[mine[best]], pa.int32()),
                            "d": pa.array(squared[np.arange(len(points)), mine[best]]),
                        }))
            if out:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
        yield from lines_of(families, kinds)

    return run


def kmeans_families(df: DataFrame, key: str, vector: str = "vector", k: int = 3, restarts: int = 1,
                    seed: int = SEED, rounds: int = 50, tolerance: float = 1e-12) -> FamilyClustering:
    """Lloyd's K-means for every (model, pooling) family and restart at once.

    Seeding is by random partition: restart r puts each row in cluster hash(key, family, r, seed)
    mod k, and the first centroids are those clusters' means.  Rows are stored as blocks of one
    family; a round joins each block with its family's restarts x k centroids (one row per
    family), takes the nearest per restart and adds up the task's rows per family and cluster in numpy, and
    the new centroids are grouped sums of those over (model, pooling, restart, cluster): one job
    for all families, no loop over them.  A cluster left empty keeps its centroid.  The
    rounds end when no centroid moves by more than `tolerance` (squared) or after `rounds`.
    The cheapest restart of each family wins, ties to the lower restart.  Rows without vector or
    family are left out.
    """
    require_columns(df, "model", "pooling", key, vector)
    family = ["model", "pooling"]
    single = df.schema[vector].dataType.simpleString() == "array<float>"
    rows = df.where(F.col(vector).isNotNull() & F.col("model").isNotNull() & F.col("pooling").isNotNull()).select(
        *family, F.col(key).alias("_key"), F.col(vector).alias("_v")
    )
    rows = materialize(rows if single else rows.withColumn("_v", V.as_double(F.col("_v"))), "family-rows")
    kinds = {c: rows.schema[c].dataType.simpleString() for c in [*family, "_key"]}
    named = ", ".join(f"{c} {kinds[c]}" for c in family)
    blocks = materialize(rows.mapInPandas(_pack_points(single), f"{named}, _keys array<{kinds['_key']}>, _points binary"), "family-blocks", **STORED_AS)
    start = rows.select(*family, "_key", V.as_double(F.col("_v")).alias("_v"), F.explode(F.sequence(F.lit(0), F.lit(restarts - 1))).alias("restart")).withColumn(
        "cluster", F.pmod(F.xxhash64(F.col("_key"), *family, "restart", F.lit(seed)), F.lit(k)).cast("int")
    )

    def means(summed: DataFrame) -> DataFrame:
        return summed.select(*family, "restart", "cluster", V.divide(F.col("_s"), F.col("_n").cast("double")).alias("c"))

    def assign(centroids: DataFrame, sums: bool, schema: str) -> DataFrame:
        packed = centroids.groupBy(*family).agg(F.sort_array(F.collect_list(F.struct("restart", "cluster", "c"))).alias("_cs"))
        met = blocks.join(packed, family).select(
            *family, F.col("_cs.restart").alias("restarts"), F.col("_cs.cluster").alias("clusters"), F.flatten("_cs.c").alias("lines"),
            F.col("_points").alias("points"), *([] if sums else [F.col("_keys").alias("keys")]),
        )
        return met.mapInArrow(_nearest(single, sums), f"{named}, {schema}")

    first = start.groupBy(*family, "restart", "cluster").agg(vector_sum(F.col("_v")).alias("_s"), F.count(F.lit(1)).alias("_n"))
    centroids = materialize(means(first), "centroids-0")
    for round_ in range(1, rounds + 1):
        summed = assign(centroids, True, "restart int, cluster int, s array<double>, n bigint").groupBy(*family, "restart", "cluster")
        moved = means(summed.agg(vector_sum(F.col("s")).alias("_s"), F.sum("n").alias("_n")))
        # An empty cluster keeps its centroid.
        fresh = centroids.alias("o").join(moved.alias("n"), [*family, "restart", "cluster"], "left").select(
            *family, "restart", "cluster", F.coalesce(F.col("n.c"), F.col("o.c")).alias("c"),
            V.squared_distance(F.col("o.c"), F.coalesce(F.col("n.c"), F.col("o.c"))).alias("_shift"),
        )
        fresh = materialize(fresh, f"centroids-{round_}")
        shift = fresh.agg(F.max("_shift")).first()[0]
        centroids = fresh.drop("_shift")
        if shift is None or shift <= tolerance:
            break
    final = materialize(assign(centroids, False, f"_key {kinds['_key']}, restart int, cluster int, d double"), "family-assignments")
    costs = materialize(final.groupBy(*family, "restart").agg(F.sum("d").alias("cost")), "family-costs")
    chosen = costs.groupBy(*family).agg(F.min_by("restart", F.struct("cost", "restart")).alias("restart"))
    assigned = final.join(chosen, [*family, "restart"]).select(*family, F.col("_key").alias(key), "cluster")
    return FamilyClustering(assigned, costs, centroids.join(chosen, [*family, "restart"]).select(*family, "cluster", "c"))


def cluster_families(df: DataFrame, key: str, k: int = 3, restarts: int = 1, seed: int = SEED) -> DataFrame:
    """(model, pooling, key, cluster): one clustering per embedding family, all families at once."""
    return kmeans_families(df, key, "vector", k, restarts, seed).assigned


def assign_nearest_centroid(df: DataFrame, centroids: DataFrame, key: str = "row_id",
                            vector: str = "vector") -> DataFrame:
    """(key, cluster, squared_distance) of the nearest centroid; ties go to the lower cluster.

    Centroids are dealt by hash to blocks of about CENTROID_BLOCK; every row meets every block
    (an equi-join on the block number), keeps the nearest of each block, and the nearest of
    those wins (a grouped minimum by the row).  No limit on the number of centroids.
    """
    require_columns(df, key, vector)
    require_columns(centroids, "cluster", "vector")
    count = centroids.agg(F.count(F.lit(1))).first()[0]
    blocks = max(1, -(-count // CENTROID_BLOCK))
    packed = materialize(
        centroids.select(F.pmod(F.xxhash64("cluster"), F.lit(blocks)).cast("int").alias("_block"),
                         F.struct("cluster", V.as_double(F.col("vector")).alias("vector")).alias("_c"))
        .groupBy("_block").agg(F.collect_list("_c").alias("_centroids")),
        "centroid-blocks",
    )
    rows = materialize(
        df.select(F.monotonically_increasing_id().alias("_row"), key, V.as_double(F.col(vector)).alias("_v")), "centroid-rows"
    )
    dealt = rows.select("_row", "_v", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"))
    nearest = F.array_min(F.transform(
        "_centroids",
        lambda c: F.struct(V.squared_distance(F.col("_v"), c["vector"]).alias("d"), c["cluster"].alias("c")),
    ))
    best = dealt.join(packed, "_block").select("_row", nearest.alias("_n")).groupBy("_row").agg(F.min("_n").alias("_n"))
    return rows.join(best, "_row", "left").select(
        key, F.col("_n.c").alias("cluster"), F.col("_n.d").alias("squared_distance")
    )


def cluster_members(df: DataFrame, cluster) -> DataFrame:
    return require_columns(df, "cluster").filter(F.col("cluster") == cluster)


def cluster_summary(df: DataFrame, key: str = "row_id", text: str = "text", first: int = 3,
                    length: int = 100) -> DataFrame:
    """(cluster, size, position, snippet): size and the first posts of each cluster.

    The rank filter is pushed below the shuffle, so a cluster that holds most
    rows sends only `first` of them per task.
    """
    require_columns(df, "cluster", key, text)
    sizes = df.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    by_key = Window.partitionBy("cluster").orderBy(key)
    head = df.select("cluster", key, snippet(F.col(text), length).alias("snippet"))
    head = head.withColumn("position", F.row_number().over(by_key)).filter(F.col("position") <= first)
    return head.join(sizes, "cluster").select("cluster", "size", "position", "snippet")


def attach_clusters(df: DataFrame, clusters: DataFrame, on: list[str]) -> DataFrame:
    """Left join of cluster numbers; several matches multiply the row."""
    require_columns(df, *on)
    require_columns(clusters, *on, "cluster")
    return df.join(clusters.select(*on, "cluster"), on, "left")


def attach_cluster_counts(df: DataFrame, clusters: DataFrame, on: list[str]) -> DataFrame:
    """The rows of `df`, each once, with `clusters`: array<struct<cluster, copies>> of the matching rows of `clusters`.

    The matches of a class are counted before the join, keyed by the digest of `on`, so m equal
    rows on both sides give m rows and a count of m, not m x m rows.  A row with a null in `on`
    matches nothing (as in an equi-join) and gets an empty array.  `expand_clusters` gives the
    rows of the plain left join.
    """
    require_columns(df, *on)
    require_columns(clusters, *on, "cluster")
    def digest(frame: DataFrame) -> Column:
        known = F.lit(True)
        for c in on:
            known = known & F.col(c).isNotNull()
        return F.when(known, F.sha2(F.to_json(F.struct(*[F.col(c) for c in on])), 256))

    counted = clusters.select(digest(clusters).alias("_class"), "cluster").where(F.col("_class").isNotNull()).groupBy(
        "_class", "cluster"
    ).agg(F.count(F.lit(1)).alias("copies"))
    per_class = counted.groupBy("_class").agg(F.sort_array(F.collect_list(F.struct("cluster", "copies"))).alias("clusters"))
    empty = F.array().cast("array<struct<cluster:" + clusters.schema["cluster"].dataType.simpleString() + ",copies:bigint>>")
    return df.withColumn("_class", digest(df)).join(per_class, "_class", "left").select(
        *[F.col(f"`{c}`") for c in df.columns], F.coalesce(F.col("clusters"), empty).alias("clusters")
    )


def expand_clusters(attached: DataFrame) -> DataFrame:
    """The rows of the left join that `attach_cluster_counts` stands for: each match `copies` times, null where none."""
    others = [F.col(f"`{c}`") for c in attached.columns if c != "clusters"]
    copies = F.transform("clusters", lambda m: F.array_repeat(m["cluster"], m["copies"].cast("int")))
    return attached.select(*others, F.explode_outer(F.flatten(copies)).alias("cluster"))
