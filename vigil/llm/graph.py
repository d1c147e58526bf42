"""Connected components of an edge table, on the cluster."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.tables import saved

CHUNK = 1_000_000  # edges that a task holds at once


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components with an edge from each node to the smallest one."""
    names, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    root = np.arange(len(names))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    other = np.flatnonzero(root != np.arange(len(names)))
    return names[other], names[root[other]]


def contracted(edges: DataFrame, chunk: int) -> DataFrame:
    """Edges (u, v) with the same components, ``chunk`` edges of a partition
    at a time replaced by their stars: never more edges than before."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                held.append([c.to_numpy() for c in batch.slice(at, chunk).columns])
                size += len(held[-1][0])
                if size >= chunk:
                    yield pa.RecordBatch.from_arrays([*map(pa.array, stars(*map(np.concatenate, zip(*held))))], ["u", "v"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([*map(pa.array, stars(*map(np.concatenate, zip(*held))))], ["u", "v"])

    return edges.mapInArrow(run, "u long, v long")


def components(edges: DataFrame, a: str = "a", b: str = "b", chunk: int = CHUNK) -> DataFrame:
    """(node, component) for every node (a long) of an undirected edge table,
    the component being its smallest node.

    Alternates large-star and small-star steps until the edges stay as they
    are; each step is one aggregation and one join over the edges, and the
    number of rounds grows with the logarithm of the longest path. Before each
    round every task replaces its edges by stars, so that few edges need one
    round: a round's plans, threads and broadcasts weigh on the driver,
    however few its rows are. Loops and repeated edges are allowed; null ends
    are ignored."""
    nodes = edges.select(F.col(a).alias("u")).union(edges.select(F.col(b).alias("u"))).dropna()
    e = saved(contracted(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).dropna().where("u != v").distinct(), chunk), free=True)
    before, rounds = None, 0
    while True:
        rounds += 1
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before or not state[0]:
            break
        before = tuple(state)
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # a node's larger neighbours are those whose edge ends at it
        large = e.join(low.withColumnRenamed("u", "v"), "v").select("u", F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        e = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        e = saved(contracted(e, chunk), free=rounds % 3 == 0)
    return nodes.distinct().join(e, "u", "left").select(F.col("u").alias("node"), F.coalesce("v", "u").alias("component"))
