"""Mean-centering, cosine statistics and search over embedding tables.

A table of n vectors has n(n-1)/2 pairs.  Mean, deviation and correlation of
all pairs follow from sums over rows (see `vector_sums`).  Minimum, maximum,
median and histogram need every pair: rows are dealt into blocks, each pair of
blocks is one task of fixed size, and a task returns a summary, never pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidepost.checks import require_columns
from tidepost.functions import vectors as V
from tidepost.functions.text import snippet
from tidepost.session import materialize
from tidepost.operators.vector_sums import gram_matrix, total_vector

# Numbers per block: the task of one pair of blocks holds two of them (16 MB each) and a strip's results.
# A row goes to as many tasks as there are blocks, so what is shuffled falls as blocks grow.
BLOCK_VALUES = 1 << 21
# Least rows of a block, and similarities worked on at a time.
STRIP_ROWS, STRIP_CELLS = 256, 1 << 20
# Rows and columns of a tile in single precision; of its cells one in so many is worked out again one by one, more all together.
TILE_ROWS, TILE_COLUMNS, EXACT_SHARE = 256, 2048, 32
# Bins of one counting pass when locating the median.
MEDIAN_BINS = 65536
# Sampled rows that one task opens at a time, twice.
SAMPLE_BLOCK = 512


# --- rows ----------------------------------------------------------------

def align_embeddings(left: DataFrame, right: DataFrame, key: str = "row_id",
                     names: tuple[str, str] = ("left_vector", "right_vector")) -> DataFrame:
    """(key, left vector, right vector) of the rows both tables have."""
    require_columns(left, key, "vector")
    require_columns(right, key, "vector")
    return left.select(key, F.col("vector").alias(names[0])).filter(F.col(names[0]).isNotNull()).join(
        right.select(key, F.col("vector").alias(names[1])).filter(F.col(names[1]).isNotNull()), key
    )


def corpus_mean_vector(df: DataFrame, vector: str = "vector") -> DataFrame:
    """One row (mean): the mean per dimension."""
    require_columns(df, vector)
    total = total_vector(df.select(V.as_double(F.col(vector)).alias(vector)), vector)
    return total.select(V.divide(F.col("total"), F.col("rows").cast("double")).alias("mean"))


def center_vectors(df: DataFrame, vector: str = "vector", mean: DataFrame | None = None,
                   out: str = "centered") -> DataFrame:
    """Add the vector minus the mean of the table, or minus a given one-row mean."""
    mean = corpus_mean_vector(df, vector) if mean is None else mean
    return (
        df.withColumn("_mean", mean.select("mean").scalar())
        .withColumn(out, V.subtract(V.as_double(F.col(vector)), F.col("_mean")))
        .drop("_mean")
    )


def unit_vectors(df: DataFrame, vector: str, out: str = "unit") -> DataFrame:
    """Add the vector scaled to length one; a zero vector stays zero."""
    return df.withColumn(out, V.unit(V.as_double(F.col(vector))))


def random_sample(df: DataFrame, key: str, size: int, seed: int = 42) -> DataFrame:
    """`size` rows by the order of a seeded hash of the key, the same on any partitioning."""
    require_columns(df, key)
    rank = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    return df.withColumn("_rank", rank).orderBy("_rank", key).limit(size).drop("_rank")


def head_rows(df: DataFrame, key: str, size: int) -> DataFrame:
    return df.orderBy(key).limit(size)


# --- all pairs: sums -------------------------------------------------------

def _moments(pairs: Column, total: Column, squares: Column) -> dict[str, Column]:
    mean = total / pairs
    return {
        "pairs": pairs.cast("bigint"),
        "mean": mean,
        "std": F.sqrt(F.greatest(squares / pairs - mean * mean, F.lit(0.0))),
    }


def similarity_moments(df: DataFrame, vector: str = "vector") -> DataFrame:
    """(pairs, mean, std) of the cosine of all pairs i<j, from one pass over the rows.

    With unit vectors u and G the sum of u uᵀ, the cells of the whole matrix
    sum to |Σu|² and their squares to |G|²; the diagonal is taken off.  A
    leading one in each vector makes Σu the first row of the matrix.
    """
    require_columns(df, vector)
    units = unit_vectors(df.select(vector).filter(F.col(vector).isNotNull()), vector)
    # The diagonal of the similarity matrix: one for each non-zero vector.
    gram = gram_matrix(units.select(F.concat(F.array(F.lit(1.0)), "unit").alias("z")), "z")
    tail = F.slice("gram_row", 2, F.greatest(F.size("gram_row") - 1, F.lit(0)))
    squares = F.aggregate(tail, F.lit(0.0), lambda s, x: s + x * x)
    parts = gram.agg(
        F.sum(F.when(F.col("i") == 0, F.get("gram_row", F.lit(0)))).alias("n"),
        F.sum(F.when(F.col("i") == 0, squares)).alias("sum_all"),
        F.sum(F.when(F.col("i") > 0, squares)).alias("squares_all"),
        F.sum(F.when(F.col("i") > 0, F.get("gram_row", F.col("i")))).alias("diagonal"),
    )
    n = F.col("n")
    columns = _moments(
        n * (n - 1) / 2,
        (F.col("sum_all") - F.col("diagonal")) / 2,
        (F.col("squares_all") - F.col("diagonal")) / 2,
    )
    return parts.select(*[c.alias(name) for name, c in columns.items()])


def compare_embeddings(left: DataFrame, right: DataFrame, key: str = "row_id",
                       sample_size: int | None = 200, seed: int = 42,
                       left_mean: DataFrame | None = None) -> DataFrame:
    """Pair mean and std of both families and the correlation of their matrices.

    The correlation runs over all n² cells, the diagonal included.  Both
    samples are centered by their own mean unless `left_mean` is given.
    """
    both = align_embeddings(left, right, key)
    if sample_size is not None:
        both = random_sample(both, key, sample_size, seed)
    # Read by both means and by the sums below.
    both = materialize(both, "aligned")
    both = center_vectors(both, "left_vector", left_mean, "_left")
    both = center_vectors(both, "right_vector", None, "_right")
    both = unit_vectors(unit_vectors(both, "_left", "_u"), "_right", "_w")
    stacked = both.select(F.concat(F.array(F.lit(1.0)), "_u", "_w").alias("z"))
    sizes = both.agg(F.max(F.size("_u")).alias("size"))
    gram = gram_matrix(stacked, "z").withColumn("_d", sizes.scalar())

    d, i, row = F.col("_d"), F.col("i"), F.col("gram_row")
    squared = lambda part: F.aggregate(part, F.lit(0.0), lambda s, x: s + x * x)
    in_u = F.slice(row, F.lit(2), d)
    in_w = F.slice(row, d + 2, F.size(row))
    is_u, is_w = i.between(1, d), i > d
    parts = gram.agg(
        F.sum(F.when(i == 0, F.get(row, F.lit(0)))).alias("n"),
        F.sum(F.when(i == 0, squared(in_u))).alias("su"),
        F.sum(F.when(i == 0, squared(in_w))).alias("sw"),
        F.sum(F.when(is_u, squared(in_u))).alias("suu"),
        F.sum(F.when(is_w, squared(in_w))).alias("sww"),
        F.sum(F.when(is_u, squared(in_w))).alias("suw"),
        F.sum(F.when(is_u, F.get(row, i))).alias("du"),
        F.sum(F.when(is_w, F.get(row, i))).alias("dw"),
    )
    n = F.col("n")
    pairs, cells = n * (n - 1) / 2, n * n
    u = _moments(pairs, (F.col("su") - F.col("du")) / 2, (F.col("suu") - F.col("du")) / 2)
    w = _moments(pairs, (F.col("sw") - F.col("dw")) / 2, (F.col("sww") - F.col("dw")) / 2)
    mean_u, mean_w = F.col("su") / cells, F.col("sw") / cells
    covariance = F.col("suw") / cells - mean_u * mean_w
    spread = F.sqrt(
        (F.col("suu") / cells - mean_u * mean_u) * (F.col("sww") / cells - mean_w * mean_w)
    )
    return parts.select(
        n.cast("bigint").alias("rows"),
        u["mean"].alias("left_mean"), u["std"].alias("left_std"),
        w["mean"].alias("right_mean"), w["std"].alias("right_std"),
        (covariance / spread).alias("correlation"),
    )


# --- all pairs: block tasks -----------------------------------------------

def _stack(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


class RowSummary:
    """Per row of the two blocks: number, sum, least and greatest similarity to others."""

    schema = "key bigint, pairs bigint, total double, least double, greatest double"

    def start(self, left_keys: np.ndarray, right_keys: np.ndarray, same: bool) -> None:
        self.keys = left_keys if same else np.concatenate([left_keys, right_keys])
        self.split = 0 if same else len(left_keys)
        size = len(self.keys)
        self.pairs, self.total = np.zeros(size, np.int64), np.zeros(size)
        self.least, self.greatest = np.full(size, np.inf), np.full(size, -np.inf)

    def add(self, at: int, sims: np.ndarray, upper: np.ndarray | None) -> None:
        shown = np.ones(sims.shape, bool) if upper is None else upper
        low, high = np.where(shown, sims, np.inf), np.where(shown, sims, -np.inf)
        kept = np.where(shown, sims, 0.0)
        rows = slice(at, at + sims.shape[0])
        columns = slice(self.split, self.split + sims.shape[1])
        for part, axis in ((rows, 1), (columns, 0)):
            self.pairs[part] += shown.sum(axis=axis)
            self.total[part] += kept.sum(axis=axis)
            self.least[part] = np.minimum(self.least[part], low.min(axis=axis))
            self.greatest[part] = np.maximum(self.greatest[part], high.max(axis=axis))

    def result(self) -> dict:
        return {"key": self.keys, "pairs": self.pairs, "total": self.total,
                "least": self.least, "greatest": self.greatest}


class BinCounts:
    """Number and sum of the similarities in each of `bins` equal bins of [low, high]."""

    schema = "bin bigint, pairs bigint, total double, least double, greatest double"

    def __init__(self, low: float, high: float, bins: int):
        self.low, self.high, self.bins = low, high, bins

    def start(self, left_keys: np.ndarray, right_keys: np.ndarray, same: bool) -> None:
        self.pairs, self.total = np.zeros(self.bins, np.int64), np.zeros(self.bins)
        self.least, self.greatest = np.inf, -np.inf

    def add(self, at: int, sims: np.ndarray, upper: np.ndarray | None) -> None:
        values = sims.reshape(-1) if upper is None else sims[upper]
        values = values[(values >= self.low) & (values <= self.high)]
        if not len(values):
            return
        width = (self.high - self.low) or 1.0
        # The last bin is closed.
        place = np.minimum((values - self.low) / width * self.bins, self.bins - 1).astype(np.int64)
        self.pairs += np.bincount(place, minlength=self.bins)
        self.total += np.bincount(place, weights=values, minlength=self.bins)
        self.least = min(self.least, values.min())
        self.greatest = max(self.greatest, values.max())

    def result(self) -> dict:
        found = np.flatnonzero(self.pairs)
        return {"bin": found + 1, "pairs": self.pairs[found], "total": self.total[found],
                "least": np.full(len(found), self.least), "greatest": np.full(len(found), self.greatest)}


class _Tile:
    """Similarities of some rows with some others, in single precision, at most `eps` off; exact ones on request."""

    def __init__(self, sims: np.ndarray, left: np.ndarray, right: np.ndarray, eps: float):
        self.sims, self.left, self.right, self.eps = sims, left, right, eps

    def exact(self, wanted: np.ndarray) -> np.ndarray:
        """The exact values of the wanted cells."""
        found = np.flatnonzero(wanted)
        if len(found) > wanted.size // EXACT_SHARE:
            values = (self.left @ self.right.T)[wanted]
        else:
            i, j = np.divmod(found, wanted.shape[1])
            values = np.einsum("ij,ij->i", self.left[i], self.right[j])
        return np.clip(values, -1.0, 1.0)


class NearBins:
    """The similarities counted in `bins` equal bins of [-1, 1], a bin's edges `eps` off; exact least and greatest."""

    schema = BinCounts.schema

    def __init__(self, bins: int):
        self.bins = bins

    def start(self) -> None:
        self.pairs, self.least, self.greatest = np.zeros(self.bins, np.int64), np.inf, -np.inf

    def add(self, tile: _Tile, shown: np.ndarray | None) -> None:
        sims = tile.sims
        values = sims.reshape(-1) if shown is None else sims[shown]
        if not len(values):
            return
        # Only cells that may pass the ends so far are looked at again; none passes 1 or -1.
        low, high, eps = float(values.min()), float(values.max()), tile.eps
        if low - eps < self.least and self.least > -1.0:
            self.least = min(self.least, tile.exact(sims <= min(low + 2 * eps, self.least + eps)).min(initial=np.inf))
        if high + eps > self.greatest and self.greatest < 1.0:
            self.greatest = max(self.greatest, tile.exact(sims >= max(high - 2 * eps, self.greatest - eps)).max(initial=-np.inf))
        # In place: nothing reads the tile after this.  Rounding may carry values over the ends, by less than `over` bins.
        half, over = self.bins / 2, math.ceil(eps * self.bins / 2) + 1
        values *= np.float32(half)
        values += np.float32(half + over)
        pairs = np.bincount(values.astype(np.intp), minlength=self.bins + 2 * over)
        self.pairs += pairs[over:-over]
        self.pairs[0] += pairs[:over].sum()
        self.pairs[-1] += pairs[-over:].sum()

    def result(self) -> dict:
        found = np.flatnonzero(self.pairs)
        return {"bin": found + 1, "pairs": self.pairs[found], "total": np.zeros(len(found)),
                "least": np.full(len(found), self.least), "greatest": np.full(len(found), self.greatest)}


class WindowBins(BinCounts):
    """The exact number of similarities below `low` (as bin 0), and those in [low, high] as in BinCounts."""

    def start(self) -> None:
        super().start(None, None, False)
        self.below = 0

    def add(self, tile: _Tile, shown: np.ndarray | None) -> None:
        sims, eps = tile.sims, tile.eps
        under = sims < self.low - eps
        self.below += np.count_nonzero(under)
        under ^= sims <= self.high + eps
        values = tile.exact(under)
        self.below += np.count_nonzero(values < self.low)
        super().add(0, values, None)

    def result(self) -> dict:
        first = {"bin": 0, "pairs": self.below, "total": 0.0, "least": np.inf, "greatest": -np.inf}
        return {name: np.append(first[name], column) for name, column in super().result().items()}


def _add_tiles(summary: NearBins | WindowBins, left: np.ndarray, right: np.ndarray, same: bool) -> None:
    """The similarities of two blocks in single precision, by tiles that stay in a core's cache."""
    # A row with a value that is no finite number has no similarity.
    left, right = (block[np.isfinite(block).all(axis=1)] for block in (left, right))
    # Rounding of d products and their sum, whose terms add up to 1 at most, and of the bins.
    eps = (left.shape[1] + 16) * 2.0 ** -24
    short, other = left.astype(np.float32), right.astype(np.float32)
    for i in range(0, len(left), TILE_ROWS):
        for j in range(0, len(right), TILE_COLUMNS):
            upper = None
            if same and j < i + TILE_ROWS:
                upper = np.arange(j, min(j + TILE_COLUMNS, len(right))) > np.arange(i, min(i + TILE_ROWS, len(left)))[:, None]
                if not upper.any():
                    continue
            sims = short[i:i + TILE_ROWS] @ other[j:j + TILE_COLUMNS].T
            if upper is not None:
                sims[~upper] = np.nan
            summary.add(_Tile(sims, left[i:i + TILE_ROWS], right[j:j + TILE_COLUMNS], eps), upper)


def _block_task(summary: RowSummary | BinCounts | NearBins, table: pa.Table) -> pa.Table:
    """All similarities of one pair of blocks, a strip at a time, summed up and dropped."""
    # A fixed order makes the floating-point results repeatable.
    table = table.sort_by("key")
    same = table.column("block_i")[0].as_py() == table.column("block_j")[0].as_py()
    left = right = table
    if not same:
        left = table.filter(pc.equal(table.column("side"), 0))
        right = table.filter(pc.equal(table.column("side"), 1))
    left_keys, right_keys = left.column("key").to_numpy(), right.column("key").to_numpy()
    if isinstance(summary, (NearBins, WindowBins)):
        summary.start()
        if len(left_keys) and len(right_keys):
            _add_tiles(summary, _stack(left.column("unit")), _stack(right.column("unit")), same)
    else:
        summary.start(left_keys, right_keys, same)
        if len(left_keys) and len(right_keys):
            rows, columns = _stack(left.column("unit")), _stack(right.column("unit")).T
            strip = max(1, STRIP_CELLS // len(right_keys))
            for at in range(0, len(rows), strip):
                sims = np.clip(rows[at:at + strip] @ columns, -1.0, 1.0)
                upper = None
                if same:
                    upper = np.arange(sims.shape[1]) > (at + np.arange(len(sims)))[:, None]
                summary.add(at, sims, upper)
    fields = pa.schema([
        (name, pa.int64() if kind == "bigint" else pa.float64())
        for name, kind in (field.split() for field in summary.schema.split(", "))
    ])
    return pa.table(summary.result(), schema=fields)


def block_count(rows: int, block_rows: int, cores: int) -> int:
    """Blocks of at most about `block_rows`; smaller ones if that leaves cores idle."""
    for_size = -(-rows // block_rows)
    for_cores = min(-(-rows // STRIP_ROWS), math.isqrt(2 * cores))
    return max(1, for_size, for_cores)


def block_tasks(df: DataFrame, key: str, vector: str, block_rows: int | None = None) -> DataFrame:
    """Copies of the unit vectors, one for each pair of blocks they take part in.

    Without `block_rows` a block has as many rows as make BLOCK_VALUES numbers.
    """
    df = df.filter(F.col(vector).isNotNull())
    found = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.max(F.size(vector)), F.lit(1)).alias("size")).first()
    block_rows = block_rows or max(STRIP_ROWS, BLOCK_VALUES // max(1, found["size"]))
    blocks = block_count(found["rows"], block_rows, df.sparkSession.sparkContext.defaultParallelism)
    units = unit_vectors(df, vector).select(
        F.col(key).cast("bigint").alias("key"),
        F.pmod(F.xxhash64(F.col(key)), F.lit(blocks)).cast("int").alias("_own"), "unit",
    )
    copies = units.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_other"))
    return copies.select(
        "key", "unit",
        F.least("_own", "_other").alias("block_i"), F.greatest("_own", "_other").alias("block_j"),
        (F.col("_own") > F.col("_other")).cast("int").alias("side"),
    )


def _run_blocks(tasks: DataFrame, summary: RowSummary | BinCounts | NearBins) -> DataFrame:
    def task(table: pa.Table) -> pa.Table:
        return _block_task(summary, table)

    return tasks.groupBy("block_i", "block_j").applyInArrow(task, summary.schema)


def _bin_table(tasks: DataFrame, summary: BinCounts | NearBins) -> list:
    """One line per non-empty bin, in order: at most as many as the summary has bins."""
    return _run_blocks(tasks, summary).groupBy("bin").agg(
        F.sum("pairs").alias("pairs"), F.sum("total").alias("total"),
        F.min("least").alias("least"), F.max("greatest").alias("greatest"),
    ).orderBy("bin").collect()


def similarity_pairs(df: DataFrame, key: str = "row_id", vector: str = "vector",
                     block_rows: int | None = None) -> DataFrame:
    """Per row: number of other rows, mean, least and greatest cosine to them.

    Every pair is evaluated; the result has one line per row instead of the
    n² cells.  Keys are unique whole numbers.
    """
    require_columns(df, key, vector)
    merged = _run_blocks(block_tasks(df, key, vector, block_rows), RowSummary()).groupBy("key").agg(
        F.sum("pairs").alias("pairs"), F.sum("total").alias("total"),
        F.min("least").alias("least"), F.max("greatest").alias("greatest"),
    )
    paired = F.col("pairs") > 0
    return merged.select(
        F.col("key").alias(key), "pairs",
        F.when(paired, F.col("total") / F.col("pairs")).alias("mean_similarity"),
        F.when(paired, F.col("least")).alias("min_similarity"),
        F.when(paired, F.col("greatest")).alias("max_similarity"),
    )


def similarity_extremes(df: DataFrame, key: str = "row_id", vector: str = "vector",
                        block_rows: int | None = None, bins: int = MEDIAN_BINS) -> DataFrame:
    """(min, max, median) of the cosine of all pairs i<j.

    The first pass counts the pairs in bins of [-1, 1] by similarities in single precision, whose error has a
    bound, and finds the exact ends.  An order statistic moves by no more than that error, so the median lies in
    its bin, widened by it: the second pass counts the pairs below, exactly, and splits that window; by then a bin
    is narrower than 1e-8 (1e-9 up to some 200 dimensions).
    """
    require_columns(df, key, vector)
    tasks = block_tasks(df, key, vector, block_rows)
    table = _bin_table(tasks, NearBins(bins))
    values = (None, None, None)
    if table:
        pairs = sum(row["pairs"] for row in table)
        size = df.agg(F.max(F.size(vector))).first()[0]
        width, margin = 2.0 / bins, (size + 16) * 2.0 ** -24
        found, split = [], {}
        for rank in sorted({(pairs - 1) // 2, pairs // 2}):
            left = rank
            for row in table:
                if left < row["pairs"]:
                    break
                left -= row["pairs"]
            low = -1.0 + (row["bin"] - 1) * width
            if row["bin"] not in split:
                split[row["bin"]] = _bin_table(tasks, WindowBins(max(-1.0, low - margin), min(1.0, low + width + margin), bins))
            left = rank
            for part in split[row["bin"]]:
                if left < part["pairs"]:
                    break
                left -= part["pairs"]
            if part["bin"] == 0 or left >= part["pairs"]:
                raise ArithmeticError("the median lies outside its window")
            found.append(part["total"] / part["pairs"])
        values = (
            min(row["least"] for row in table), max(row["greatest"] for row in table),
            sum(found) / len(found),
        )
    return df.sparkSession.createDataFrame([values], "min double, max double, median double")


def similarity_stats(df: DataFrame, key: str = "row_id", vector: str = "vector",
                     block_rows: int | None = None) -> DataFrame:
    """One row each for the raw and the centered vectors: pairs, mean, std, min, max, median."""
    results = []
    centered = center_vectors(df.select(key, vector), vector).select(key, F.col("centered").alias(vector))
    for kind, table in (("raw", df.select(key, vector)), ("centered", centered)):
        ends = similarity_extremes(table, key, vector, block_rows).first()
        results.append(
            similarity_moments(table, vector).select(
                F.lit(kind).alias("kind"), "pairs", "mean", "std",
                *[F.lit(ends[name]).cast("double").alias(name) for name in ("min", "max", "median")],
            )
        )
    return results[0].unionByName(results[1])


def similarity_histogram(df: DataFrame, key: str = "row_id", vector: str = "vector", bins: int = 80,
                         block_rows: int | None = None) -> DataFrame:
    """(bin, low, high, pairs): `bins` equal bins from the least to the greatest similarity."""
    require_columns(df, key, vector)
    tasks = block_tasks(df, key, vector, block_rows)
    ends = _bin_table(tasks, BinCounts(-1.0, 1.0, 1))
    low, high = (ends[0]["least"], ends[0]["greatest"]) if ends else (0.0, 0.0)
    counts = _run_blocks(tasks, BinCounts(low, high, bins)).groupBy("bin").agg(F.sum("pairs").alias("pairs"))
    width = (high - low) / bins
    return counts.select(
        "bin", (F.lit(low) + (F.col("bin") - 1) * F.lit(width)).alias("low"),
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("high"), "pairs",
    )


# --- samples and search ---------------------------------------------------

def similarity_sample_matrix(df: DataFrame, key: str = "row_id", vector: str = "vector",
                             size: int = 20, seed: int = 42) -> DataFrame:
    """(i, j, similarity) for all cells of a random sample of `size` rows.

    The sample is dealt by hash to blocks of about SAMPLE_BLOCK rows; every pair of blocks is
    one task (an equi-join on the partner block's number), which opens both and yields its cells.
    The matrix has size x size cells by nature; no task holds more than two blocks.
    """
    sample = unit_vectors(random_sample(df.select(key, vector), key, size, seed), vector)
    blocks = max(1, -(-size // SAMPLE_BLOCK))
    packed = sample.groupBy(F.pmod(F.xxhash64(F.col(key)), F.lit(blocks)).alias("_block")).agg(
        F.collect_list(F.struct(F.col(key).alias("key"), "unit")).alias("_rows")
    )
    left = packed.select(F.col("_rows").alias("_a"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_partner"))
    right = packed.select(F.col("_block").alias("_partner"), F.col("_rows").alias("_b"))
    cells = left.join(right, "_partner").select(F.explode("_a").alias("a"), "_b").select("a", F.explode("_b").alias("b"))
    return cells.select(
        F.col("a.key").alias("i"), F.col("b.key").alias("j"),
        V.dot(F.col("a.unit"), F.col("b.unit")).alias("similarity"),
    )


def lower_triangle(cells: DataFrame) -> DataFrame:
    """The cells on and below the diagonal."""
    return cells.filter(F.col("j") <= F.col("i"))


def query_corpus_scores(df: DataFrame, query: DataFrame, vector: str = "vector",
                        out: str = "similarity") -> DataFrame:
    """Add the cosine of each row to the single vector of the one-row table `query` (`vector`).

    The query enters the scan as a constant: no join.  A zero vector scores 0.
    """
    require_columns(df, vector)
    wanted = query.select(V.unit(V.as_double(F.col("vector"))).alias("vector"))
    v = V.as_double(F.col(vector))
    length = V.norm(v)
    scored = df.withColumn("_query", wanted.scalar())
    return scored.withColumn(
        out, V.dot(v, F.col("_query")) / F.when(length > 0, length).otherwise(F.lit(1.0))
    ).drop("_query")


def semantic_search(corpus: DataFrame, query: DataFrame, key: str = "row_id", vector: str = "vector",
                    k: int = 10) -> DataFrame:
    """(key, similarity) of the k rows closest to the query, both centered by the corpus mean."""
    mean = corpus_mean_vector(corpus, vector)
    centered = center_vectors(corpus.select(key, vector), vector, mean)
    wanted = center_vectors(query.select("vector"), "vector", mean).select(F.col("centered").alias("vector"))
    scored = query_corpus_scores(centered.select(key, F.col("centered").alias(vector)), wanted, vector)
    # Without a query vector (no known word) there is no result.
    scored = scored.filter(wanted.exists())
    return scored.select(key, "similarity").orderBy(F.desc("similarity"), F.asc(key)).limit(k)


def with_snippets(hits: DataFrame, posts: DataFrame, key: str = "row_id", text: str = "text",
                  length: int = 1000) -> DataFrame:
    """Add the text of a bounded list of hits, on one line and cut to `length`; null for a hit without text."""
    texts = posts.select(key, snippet(F.col(text), length).alias("snippet"))
    return hits.join(texts, key, "left")
