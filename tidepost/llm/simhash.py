"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints within `distance` bits of each other agree well on some partition of the bits:
with thresholds that sum to distance - partitions + 1, at least one partition differs in no
more bits than its threshold.  Correlated bits are put in one partition, so partitions differ
in how many candidates they let through, and dynamic programming gives each a threshold (-1:
not probed) for the least estimated work.  A partition with threshold t is probed with every
choice of t of its bits left out; equal keys are candidates, and candidates are verified on
all 64 bits.  Buckets too large for one task are split by applying the principle to the bits
that their key leaves free, so no bucket is cut short and none is unbounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidepost.llm.common import in_batches, text_or_empty
from tidepost.llm.components import connected_components
from tidepost.session import materialize

BITS = 64
# Fingerprints that one task compares with each other.
BUCKET = 1024
# What probing with one key costs, counted in comparisons of two fingerprints.
KEY_COST = 4.0


# --- fingerprints -----------------------------------------------------------

def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """SimHash of the word shingles of a UTF-8 text; 0 for a text without words."""
    import xxhash

    # bytes.lower and bytes.split know A-Z and the six ASCII white spaces only.
    words = text.lower().split()
    if not words:
        return 0
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    if len(words) > width:
        starts, ends = starts[: 1 - width], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), 1 << 16):
        spans = zip(starts[at : at + (1 << 16)].tolist(), (ends[at : at + (1 << 16)] - 1).tolist())
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, width: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fingerprint (signed 64-bit); one row per row, null text as empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                texts = batch.column(1).cast(pa.binary())
                for i, doc_id in enumerate(batch.column(0).to_pylist()):
                    value = fingerprint(texts[i].as_py(), width, seed)
                    yield doc_id, value - (1 << 64) if value >> 63 else value

        yield from in_batches(rows(), schema, lambda row: 16)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, fingerprint long")


# --- partitions and thresholds ----------------------------------------------

def bit_statistics(fps: DataFrame) -> tuple[np.ndarray, int]:
    """How often each two bits are both set, and the number of fingerprints; each task sends one sum per pair of bits."""
    schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, rows = np.zeros((BITS + 1, BITS + 1), np.int64), 0
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(values), 1 << 14):
                bits = (values[at : at + (1 << 14), None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)
                bits = np.hstack([bits, np.ones((len(bits), 1))]).astype(np.float64)
                both += (bits.T @ bits).astype(np.int64)
                rows += len(bits)
        if rows:
            i, j = np.nonzero(np.triu(both))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(both[i, j])], schema=schema)

    sums = fps.select("fingerprint").mapInArrow(count, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect()
    both = np.zeros((BITS + 1, BITS + 1))
    for i, j, n in sums:
        both[i, j] = both[j, i] = n
    return both, int(both[BITS, BITS])


def group_bits(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """`parts` groups of equal size; each grows by the bit most correlated with it, from the bit most correlated with what is left."""
    share = both[:BITS, BITS] / max(n, 1)
    covariance = both[:BITS, :BITS] / max(n, 1) - np.outer(share, share)
    spread = np.sqrt(np.clip(np.diag(covariance), 1e-12, None))
    strength = np.abs(covariance) / np.outer(spread, spread)
    np.fill_diagonal(strength, 0)
    left, groups = list(range(BITS)), []
    for part in range(parts):
        size = len(left) // (parts - part)
        group = [max(left, key=lambda b: (strength[b, left].sum(), -b))]
        while len(group) < size:
            group.append(max((b for b in left if b not in group), key=lambda b: (strength[b, group].sum(), -b)))
        groups.append(sorted(group))
        left = [b for b in left if b not in group]
    return groups


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds from -1 up, one per partition, summing to `total` at the least cost; costs[i][t + 1] is that of t in partition i."""
    best = {0: (0.0, [])}
    for row in costs:
        step = {}
        for used, (cost, chosen) in best.items():
            for t, more in enumerate(row, -1):
                value = (cost + more, [*chosen, t])
                if used + t not in step or value < step[used + t]:
                    step[used + t] = value
        best = step
    return best[total]


def plan_masks(fps: DataFrame, distance: int, partitions: tuple[int, ...] = (2, 3)) -> list[int]:
    """Bit masks under which all fingerprints within `distance` bits share a key at least once.

    Pairs that agree on a whole partition are counted over all fingerprints; pairs that
    differ in some bits of it follow from the share of each bit.
    """
    both, n = bit_statistics(fps)
    share = both[:BITS, BITS] / max(n, 1)
    differ = np.clip(2 * share * (1 - share), 1e-9, 0.5)
    ratio = differ / (1 - differ)
    options = [group_bits(both, n, m) for m in partitions]
    masks = [_mask(group) for groups in options for group in groups]
    keys = fps.select(F.explode(F.array(*[F.struct(F.lit(i).alias("mask"), _key(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)])).alias("k"))
    sizes = keys.groupBy("k.mask", "k.key").agg(F.count(F.lit(1)).cast("double").alias("n"))
    pairs = dict(sizes.groupBy("mask").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).collect())
    results, at = [], 0
    for groups in options:
        costs = []
        for group in groups:
            equal, row, elementary = max(pairs.get(at, 0.0), 1.0), [0.0], np.array([1.0])
            for t in range(distance + 1):
                if t:
                    elementary = np.array([sum(np.prod(ratio[list(c)]) for c in combinations(group, k)) for k in range(t + 1)])
                probes = len(list(combinations(group, t)))
                row.append(equal * float(elementary.sum()) + KEY_COST * n * probes)
            costs.append(row)
            at += 1
        results.append((*allocate(costs, distance - len(groups) + 1), groups))
    _, thresholds, groups = min(results, key=lambda r: (r[0], len(r[2])))
    return [_mask([b for b in group if b not in out]) for group, t in zip(groups, thresholds) if t >= 0 for out in combinations(group, t)]


def _mask(bits) -> int:
    return sum(1 << b for b in bits)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _key(mask):
    return F.col("fingerprint").bitwiseAND(mask)


# --- probing ----------------------------------------------------------------

def link_buckets(members: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) between fingerprints of one (mask, key), reduced to one root per connected part of a bucket."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def bucket(values: np.ndarray) -> Iterator[tuple[int, int]]:
        near = np.bitwise_count(np.bitwise_xor.outer(values, values)) <= distance
        label = np.arange(len(values))
        while True:
            least = np.where(near, label, len(values)).min(1)
            if (least == label).all():
                break
            label = least[least]
        for i in np.flatnonzero(label != np.arange(len(values))).tolist():
            yield values[i].view(np.int64).item(), values[label[i]].view(np.int64).item()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            held, last = [], None
            for batch in batches:
                mask, key, fp = (batch.column(i).to_numpy() for i in range(3))
                cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
                for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(fp)]):
                    if a < b:
                        if (mask[a], key[a]) != last:
                            if held:
                                yield from bucket(np.concatenate(held))
                            held, last = [], (mask[a], key[a])
                        held.append(fp[a:b].view(np.uint64))
            if held:
                yield from bucket(np.concatenate(held))

        yield from in_batches(rows(), schema, lambda row: 16)

    dealt = members.select("mask", "key", "fingerprint").repartition("mask", "key").sortWithinPartitions("mask", "key", "fingerprint")
    return dealt.mapInArrow(run, "a long, b long")


def similar_fingerprints(fps: DataFrame, distance: int, bucket_rows: int = BUCKET) -> DataFrame:
    """Edges (a, b) that connect exactly the distinct fingerprints linked by `distance` or fewer differing bits.

    Bucket sizes are counted before any bucket is gathered.  Buckets of one row are left,
    those of up to `bucket_rows` are compared whole, larger ones split: their free bits
    fall in distance + 1 parts, one of which must agree.  A bucket whose mask leaves at most
    `distance` free bits holds at most 2 ** distance distinct fingerprints, and splitting it would
    give the same mask again; so `bucket_rows` below 2 ** distance is refused.
    """
    if bucket_rows < 2**distance:
        raise ValueError(f"bucket_rows must be at least 2 ** distance = {2**distance}")
    masks = plan_masks(fps, distance)
    keyed = fps.select("fingerprint", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    found = []
    while True:
        keyed = materialize(keyed.select("mask", _key(F.col("mask")).alias("key"), "fingerprint").distinct(), "probes")
        sizes = materialize(keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "bucket-sizes")
        small = keyed.join(sizes.filter(F.col("n") <= bucket_rows).select("mask", "key"), ["mask", "key"], "left_semi")
        found.append(link_buckets(small, distance))
        large = sizes.filter(F.col("n") > bucket_rows)
        hot = [r[0] for r in large.select("mask").distinct().collect()]
        if not hot:
            break
        finer = {m: [m | _signed(_mask(free[i :: distance + 1])) for i in range(distance + 1)] for m in hot for free in [[b for b in range(BITS) if not m >> b & 1]]}
        table = F.create_map(*[x for m, f in finer.items() for x in (F.lit(m), F.array(*[F.lit(_signed(v % (1 << 64))) for v in f]))])
        rest = keyed.join(large.select("mask", "key"), ["mask", "key"], "left_semi")
        keyed = rest.select("fingerprint", F.explode(table[F.col("mask")]).alias("mask"))
    edges = found[0]
    for more in found[1:]:
        edges = edges.union(more)
    return edges


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = 2, seed: int = 42, bucket_rows: int = BUCKET) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id for every row.

    Fingerprints that differ in `distance` or fewer bits are linked; component_id is the
    smallest doc_id that links lead to, the row's own included.  Texts without words share
    the fingerprint zero and link like others.  Repeated rows stay; rows without doc_id get
    a component, null if nothing in it has an id.  Equal fingerprints are one node, so
    copies are never paired.
    """
    marked = materialize(fingerprints(docs, width, seed), "fingerprints")
    nodes = materialize(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = connected_components(similar_fingerprints(nodes.select("fingerprint"), distance, bucket_rows))
    rooted = nodes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    members = rooted.join(least, "root").select("fingerprint", "component_id")
    return marked.join(members, "fingerprint", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, width: int = 3, distance: int = 2, seed: int = 42) -> DataFrame:
    """The rows of `docs` whose doc_id is the smallest of their component; one row where ids repeat.

    Rows without doc_id can't be told apart and stay.
    """
    kept = near_duplicates(docs, width, distance, seed).filter("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n"))
    kept = materialize(kept, "kept-ids")
    # The ids grow with the documents, so they are never sent to all executors.
    chosen = lambda condition: docs.join(kept.filter(condition).select("doc_id").hint("merge"), "doc_id", "left_semi")
    single, repeated = chosen("_n = 1"), chosen("_n > 1").dropDuplicates(["doc_id"])
    return single.unionByName(repeated).unionByName(docs.filter("doc_id IS NULL")).select(*docs.columns)
