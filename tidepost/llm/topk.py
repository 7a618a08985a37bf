"""Exact top-k by inner product: columnar branch-and-bound.

Vectors are kept in blocks, dimension by dimension.  For a block of queries and a block of
candidates the inner products grow one group of dimensions at a time.  What the rest of two
vectors can still add is at most the product of their remaining norms; a pair whose sum so
far plus that bound stays below the query's k-th best score is dropped, and the arrays are
compacted to the survivors.  Survivors of the last group are scored in 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidepost.session import scratch_path

CANDIDATE_ROWS, QUERY_ROWS = 16_384, 2_048
DIMENSION_GROUP, TILE = 8, 2_048
_BLOCKS = "queries boolean, block long, size int, rows binary, ids binary, columns binary"
_HITS = "query_row long, query_id long, vec_id long, row long, score long"


def quantized(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, x (array of floor(scale * component)); rows without id, vector or a finite number in each place are left out."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(whole, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("x"),
    )


def store_blocks(rows: DataFrame, every: int, candidate_rows: int, query_rows: int) -> DataFrame:
    """Candidate and query blocks, each one row of column-wise binary, written to the shared folder.

    Blocks are cut from the stream of each input split, so a repeated id or vector cannot
    make a block larger.  `rows` in a block number the input rows over all splits.
    """

    def block(queries, number, kept):
        row, ids, x = zip(*kept)
        wide = np.zeros((len(kept), max(map(len, x))), np.int64)
        for i, values in enumerate(x):
            wide[i, : len(values)] = values
        return (queries, number, len(kept), np.array(row, np.int64).tobytes(), np.array(ids, np.int64).tobytes(), np.ascontiguousarray(wide.T).tobytes())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("queries", pa.bool_()), ("block", pa.int64()), ("size", pa.int32()),
            ("rows", pa.binary()), ("ids", pa.binary()), ("columns", pa.binary()),
        ])
        first = TaskContext.get().partitionId() << 33
        row, number, held = first, first, {True: [], False: []}

        def flush(queries):
            nonlocal number
            number += 1
            out = block(queries, number, held[queries])
            held[queries].clear()
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(out, schema)], schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                for vec_id, x in zip(batch.column(0).slice(at, 1024).to_pylist(), batch.column(1).slice(at, 1024).to_pylist()):
                    row += 1
                    held[False].append((row, vec_id, x))
                    if vec_id % every == 0:
                        held[True].append((row, vec_id, x))
                    for queries, most in ((False, candidate_rows), (True, query_rows)):
                        if len(held[queries]) >= most:
                            yield flush(queries)
        for queries in (False, True):
            if held[queries]:
                yield flush(queries)

    path = scratch_path(rows.sparkSession, "vector-blocks")
    rows.mapInArrow(cut, _BLOCKS).write.partitionBy("queries").parquet(path)
    schema = _BLOCKS.removeprefix("queries boolean, ") + ", queries boolean"
    return rows.sparkSession.read.schema(schema).parquet(path)


class BestScores:
    """The k best rows so far for each query of a block."""

    def __init__(self, queries: int, k: int):
        self.k, self.queries = k, queries
        self.query = np.zeros(0, np.int64)
        self.score, self.id, self.row = self.query, self.query, self.query
        self.floor = np.full(queries, -np.inf)
        self.floor_score = np.full(queries, np.iinfo(np.int64).min)
        self.floor_id = np.full(queries, np.iinfo(np.int64).max)

    def add(self, query, score, ids, rows):
        keep = (score > self.floor_score[query]) | (score == self.floor_score[query]) & (ids <= self.floor_id[query])
        query, score, ids, rows = (np.concatenate([a, b[keep]]) for a, b in ((self.query, query), (self.score, score), (self.id, ids), (self.row, rows)))
        order = np.lexsort((rows, ids, ~score, query))
        query, score, ids, rows = query[order], score[order], ids[order], rows[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        keep, last = place < self.k, place == self.k - 1
        self.floor[query[last]] = score[last]
        self.floor_score[query[last]], self.floor_id[query[last]] = score[last], ids[last]
        self.query, self.score, self.id, self.row = query[keep], score[keep], ids[keep], rows[keep]


def search_block(q, q_rows, c, c_rows, c_ids, best: BestScores) -> None:
    """Add to `best` what a block of candidates holds for a block of queries; q and c are [dimension, row]."""
    dims = min(len(q), len(c))
    order = np.argsort(-(c[:dims].astype(np.float64) ** 2).sum(1))
    groups = [order[i : i + DIMENSION_GROUP] for i in range(0, dims, DIMENSION_GROUP)] or [order]
    by_norm = np.argsort(-(c[:dims].astype(np.float64) ** 2).sum(0), kind="stable")
    qf = [q[g].astype(np.float64) for g in groups]
    q_rest = _rests(qf)
    for at in range(0, c.shape[1], TILE):
        tile = by_norm[at : at + TILE]
        own = c[:, tile]
        cf = [own[g].astype(np.float64) for g in groups]
        c_rest = _rests(cf)
        # A slack for the rounding of sums and norms, in proportion to the largest product.
        slack = 1e-9 * c_rest[0].max(initial=0) * q_rest[0].max(initial=0) + 1e-6
        dense = cf[0].T @ qf[0]
        k = 1
        while True:
            alive = dense + np.outer(c_rest[k], q_rest[k]) + slack >= best.floor
            if k == len(groups) or alive.mean() < 0.1:
                break
            dense += cf[k].T @ qf[k]
            k += 1
        ci, qi = np.nonzero(alive)
        partial = dense[ci, qi]
        for j in range(k, len(groups)):
            partial = partial + np.einsum("ij,ij->j", cf[j][:, ci], qf[j][:, qi])
            alive = partial + c_rest[j + 1][ci] * q_rest[j + 1][qi] + slack >= best.floor[qi]
            ci, qi, partial = ci[alive], qi[alive], partial[alive]
        for i in range(0, len(ci), 1 << 18):
            a, b = ci[i : i + (1 << 18)], qi[i : i + (1 << 18)]
            other = c_rows[tile[a]] != q_rows[b]
            a, b = a[other], b[other]
            score = (own[:dims, a] * q[:dims, b]).sum(0)
            best.add(b, score, c_ids[tile[a]], c_rows[tile[a]])


def _rests(groups: list[np.ndarray]) -> list[np.ndarray]:
    """Norm of what is left of each vector before each group, and zero after the last."""
    squares = [np.zeros(groups[0].shape[1])]
    for group in reversed(groups):
        squares.append(squares[-1] + (group**2).sum(0))
    return [np.sqrt(s) for s in reversed(squares)]


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, candidate_rows: int = CANDIDATE_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """For each query row (vec_id divisible by `every`) the k rows of the highest inner product.

    query_id, rank from 1, vec_id, score; ties go to the smaller vec_id.  A row is not its
    own candidate; other rows of the same vec_id are, and repeated rows are queries of their
    own.  Rows without vec_id or with a vector that is null or holds a null or non-finite
    component take no part; a shorter vector counts as filled up with zeros, an empty one
    scores 0.  Fewer than k other rows give fewer hits, an empty table none.  Scores must
    fit 64 bits.

    Every candidate block meets every query block in one join on group numbers; only blocks
    are repeated.  A task holds one pair of blocks at a time and reports k rows per query.
    """
    spark = vectors.sparkSession
    blocks = store_blocks(quantized(vectors, scale), every, candidate_rows, query_rows)
    queries, candidates = blocks.filter("queries"), blocks.filter("NOT queries")
    n = max(1, queries.count())
    lanes = max(1, -(-2 * spark.sparkContext.defaultParallelism // n))
    lane, group = (lambda m: F.pmod(F.xxhash64("block"), F.lit(m)).cast("int")), (lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
    left = queries.select(lane(n).alias("q"), group(lanes).alias("c"), F.struct("block", "size", "rows", "ids", "columns").alias("query"))
    right = candidates.select(group(n).alias("q"), lane(lanes).alias("c"), F.struct("block", "size", "rows", "ids", "columns").alias("candidate"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(name, pa.int64()) for name in ("query_row", "query_id", "vec_id", "row", "score")])
        current, best = None, None

        def arrays(block):
            columns = np.frombuffer(block["columns"], np.int64)
            return columns.reshape(-1, block["size"]), *(np.frombuffer(block[name], np.int64) for name in ("rows", "ids"))

        def report():
            return pa.RecordBatch.from_arrays(
                [pa.array(a) for a in (q_rows[best.query], q_ids[best.query], best.id, best.row, best.score)], schema=schema
            )

        for batch in batches:
            for i in range(batch.num_rows):
                query, candidate = (batch.column(name)[i].as_py() for name in ("query", "candidate"))
                if query["block"] != current:
                    if best is not None:
                        yield report()
                    current = query["block"]
                    q, q_rows, q_ids = arrays(query)
                    best = BestScores(len(q_ids), k)
                c, c_rows, c_ids = arrays(candidate)
                search_block(q, q_rows, c, c_rows, c_ids, best)
        if best is not None:
            yield report()

    hits = left.join(right, ["q", "c"]).select("query", "candidate").mapInArrow(search, _HITS)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
