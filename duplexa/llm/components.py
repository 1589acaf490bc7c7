"""Connected components of an undirected graph held as a DataFrame of edges."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duplexa.llm.scratch import Scratch


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of the given edges: (node, its smallest node), roots left out."""
    if not len(a):
        return a[:0], a[:0]
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        while (jump := root[root]).tobytes() != root.tobytes():
            root = jump
        if root.tobytes() == before.tobytes():
            break
    keep = root != np.arange(len(nodes))
    return nodes[keep], nodes[root[keep]]


def _local_stars(batches):
    """Each task keeps a spanning star of the edges it holds, folded in as they come."""
    a = b = np.empty(0, np.int64)
    for batch in batches:
        a = np.concatenate([a, batch.column(0).to_numpy(zero_copy_only=False)])
        b = np.concatenate([b, batch.column(1).to_numpy(zero_copy_only=False)])
        if len(a) > 2_000_000:
            a, b = forest(a, b)
    a, b = forest(a, b)
    if len(a):
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


#: So many edges, 16 MB of numbers, are joined by one task; the graphs of larger ones take turns of all tasks.
TOGETHER = 1_000_000


def _components(batches):
    """(node, component) of the edges that one task holds, TOGETHER of them at most."""
    parts = [(b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)) for b in batches]
    if parts:
        a, b = forest(*(np.concatenate(x) for x in zip(*parts)))
        roots = np.unique(b)
        for node, component in ((a, b), (roots, roots)):
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(component)], ["node", "component"])


def connected_components(edges: DataFrame, scratch: Scratch, label: str = "cc") -> DataFrame:
    """(node, component) for every node of ``edges(a long, b long)``; component is the smallest node reachable.

    Edges shrink to one star a task and component first. Then large-star and small-star
    steps alternate until nothing changes: every step joins each node with the smallest
    node near it, so no list of neighbours is ever gathered, and a hub's edges are an
    equi-join that adaptive execution may split. Once no more than TOGETHER edges are left
    (a graph over more nodes than that never has so few), one task joins them, which saves
    a small graph the turns. Self-links are dropped; repeated edges
    count once; nulls must not occur. No edges: an empty result.
    """
    link = "a long, b long"
    # Dealt by one end, a node that many links join with others leaves its task with one.
    now = edges.where("a <> b").select(F.col("a").cast("long"), F.col("b").cast("long")).repartition("a").mapInArrow(_local_stars, link)
    now = scratch.save(now, f"{label}0")
    turn, before = 0, None
    while True:
        summary = now.select(F.count("*"), F.expr("coalesce(sum(cast(xxhash64(a, b) as decimal(38,0))), 0)")).first()
        if summary == before or not summary[0]:
            break
        if summary[0] <= TOGETHER:
            done = scratch.save(now.coalesce(1).mapInArrow(_components, "node long, component long"), f"{label}-done")
            scratch.drop(f"{label}{turn}")
            return done
        before = summary
        turn += 1
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # The smaller end of each edge now points at its smallest neighbour as well.
        large = large.union(low.where("m < a").select("a", F.col("m").alias("b"))).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = small.union(least.select("a", F.col("m").alias("b"))).distinct()
        after = scratch.save(after, f"{label}{turn}")
        scratch.drop(f"{label}{turn - 1}")
        now = after
    roots = now.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
