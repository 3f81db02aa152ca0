"""Connected components of a link table, by alternating star contraction.

Links are compressed by union-find inside each partition, then large-star and
small-star rounds run until nothing changes. Every round is a shuffle over the
links; they are never gathered on one machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.blocks import materialize

#: Rows a union-find forest holds before it is sent on, so that its memory is bounded.
_FOREST_ROWS = 200_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a partition as stars: each node with the least node of its tree."""
    parent: dict = {}

    def root(x):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    def stars():
        pairs = [(x, r) for x in list(parent) if (r := root(x)) != x]
        parent.clear()
        kind = pa.binary()
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in pairs], kind), pa.array([b for _, b in pairs], kind)], names=["u", "v"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > _FOREST_ROWS:
            yield stars()
    yield stars()


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    least = _least(edges)
    joined = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v binary): the root is the
    least node reachable, and is listed too. No links give no rows."""
    edges = materialize(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").mapInArrow(_forest, "u binary, v binary").distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.max(F.lit(1))).first()
        if state[0] == 0 or state == before:
            break
        before = state
        edges = materialize(_small_star(_large_star(edges)), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v"), F.col("v")).distinct())
