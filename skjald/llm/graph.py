"""Connected components of large graphs, without a group's members ever meeting in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skjald.llm.common import cut

#: Edges that a task contracts by itself.
EDGES = 250_000


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def contracted(edges: DataFrame) -> DataFrame:
    """Each partition's edges as stars around the smallest nodes of their components, by union-find."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.setdefault(x, x)) != x:
                root[x] = x = root.setdefault(up, up)
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = find(a), find(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
        nodes = np.array([x for x in root if find(x) != x], np.int64)
        tops = np.array([find(x) for x in nodes.tolist()], np.int64)
        for at in range(0, len(nodes), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(tops[at : at + 50_000]), pa.array(nodes[at : at + 50_000])], ["u", "v"])

    return edges.select("u", "v").mapInArrow(run, "u long, v long")


def components(edges: DataFrame, each: int = EDGES) -> DataFrame:
    """node and component (its smallest node) of every node with an edge to another one in `edges` (u, v: long).

    `edges` is read more than once: cut its lineage before. Tasks contract `each` edges at a
    time by union-find, which settles graphs of one task. For larger ones, large-star
    links each node's larger neighbours to its smallest one and small-star its smaller
    ones; in the end all nodes of a component hang on its smallest. A round moves each
    edge once, by joins whose skew Spark can split, and rounds grow as the logarithm of the
    longest chain."""
    state = None
    while True:
        n = edges.count() if state is None else state[0]
        parts = max(1, -(-n // each))
        stars = contracted(edges.coalesce(parts))
        if parts == 1:
            edges = cut(stars)
            break
        near = _both(cut(stars))
        least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = near.join(least, "u").filter("v > u").select(F.col("m").alias("u"), "v").filter("u < v").distinct()
        # Each edge of `large` has its larger end in v: its smaller neighbours hang on the least of them.
        lower = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(lower, "v").select("m", "u", "v")
        edges = cut(small.select(F.col("m").alias("u"), "v").union(small.select(F.col("m").alias("u"), F.col("u").alias("v"))).filter("u < v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.groupBy("v").agg(F.min("u").alias("component")).withColumnRenamed("v", "node")
    return roots.union(edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
