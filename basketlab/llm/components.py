"""Connected components of an undirected graph given as a table of links.

Alternates the large-star and small-star steps, each one aggregation and one join,
until the links stop changing; then every node hangs below the smallest node of its
component.  A first pass inside each partition replaces links by a spanning forest.
Every round is written to the shared folder, so a lost executor costs a re-read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from basketlab.storage import materialize


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of one partition -> links of each node to the smallest node that the partition joins it with."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    pairs = [(x, root(x)) for x in parent]
    pairs = [(x, r) for x, r in pairs if x != r]
    yield pa.RecordBatch.from_pydict(
        {"a": pa.array([x for x, _ in pairs], pa.int64()), "b": pa.array([r for _, r in pairs], pa.int64())}
    )


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """Links (a, b) of long nodes -> (node, component): the smallest node of each linked node's component."""
    links = links.mapInArrow(_forest, "a long, b long").distinct()
    links = materialize(links, "component-links")
    mark = _mark(links)
    while True:
        # large star: what is larger than a node moves to the smallest of its neighbourhood
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        links = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: what is smaller hangs below the smallest of them
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = materialize(least.withColumnRenamed("m", "b").unionByName(moved).distinct(), "component-links")
        if (now := _mark(links)) == mark:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        mark = now
