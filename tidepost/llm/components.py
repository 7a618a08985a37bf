"""Connected components by contraction, with the lineage cut at each round."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidepost.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """node, root for every node of `edges` (a, b); root is one node of the component.

    In each round every node points at the least of itself and its neighbours, in an order
    given by a hash, and the edges move to where their ends point.  Connection is kept and
    a constant share of the nodes drops out on average, so the rounds grow with the
    logarithm of the component, not with its diameter.  Minima are combined before the
    shuffle; a node with very many edges is split by adaptive execution in the joins.
    """
    links = materialize(edges.filter("a <> b").select("a", "b").distinct(), "links")
    pointers = []
    while not links.isEmpty():
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ranked = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
        least = both.groupBy("a").agg(F.min(ranked("b")).alias("m"))
        pointer = materialize(least.select(F.col("a").alias("node"), F.least("m", ranked("a"))["v"].alias("to")), "pointers")
        pointers.append(pointer)
        moved = (
            links.join(pointer.withColumnsRenamed({"node": "a", "to": "x"}), "a")
            .join(pointer.withColumnsRenamed({"node": "b", "to": "y"}), "b")
            .filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        )
        links = materialize(moved.distinct(), "links")
    if not pointers:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = pointers[-1].withColumnRenamed("to", "root")
    for pointer in reversed(pointers[:-1]):
        later = roots.withColumnRenamed("node", "to")
        roots = pointer.join(later, "to", "left").select("node", F.coalesce("root", "to").alias("root"))
    return roots
