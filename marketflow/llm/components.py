"""Connected components by repeated contraction, on tables of any size.

Each task first replaces its share of the edges by a spanning forest of stars.
Then every round maps each node to the neighbour (or itself) that comes first in
an order, and replaces the edges by the edges between the images. Mapping nodes
to nodes of their own component keeps the components. The first round's order is
that of the ids, which collapses whole stars; the later ones are random, which
shrinks any graph, long paths too, by a constant share a round. A node's root is
the composition of the rounds' maps. Every round's tables are written, so joins
read plain scans (which Spark can split at a hub), a lost executor costs one
step, and tables are cut into files by the number of edges left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import materialise

EDGES = 1 << 20  # edges a task holds at once


def component_roots(edges: DataFrame, seed: int = 1) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)``; equal roots mean one component.

    Loops, repeated edges and either direction are allowed; rows with a null end
    are ignored. No edges give no rows.
    """
    links = materialise(edges.where("a <> b").select("a", "b"), "edges")
    first = None
    steps = []
    while (left := links.count()) > 0:
        files = -(-left // EDGES)
        links = materialise(links.coalesce(files).mapInArrow(_forests, "a bigint, b bigint"), "links", files)
        first = links if first is None else first
        both = links.union(links.select("b", "a")).groupBy("a").agg(
            F.min(_order(F.col("b"), seed, len(steps))).alias("best"))
        own = _order(F.col("a"), seed, len(steps))
        step = materialise(both.select(F.col("a").alias("node"), F.least(F.col("best"), own)["id"].alias("to")),
                           "step", files)
        steps.append(step)
        moved = (links.join(step.toDF("a", "fa"), "a").join(step.toDF("b", "fb"), "b")
                 .select(F.col("fa").alias("a"), F.col("fb").alias("b")).where("a <> b"))
        links = materialise(moved, "moved", files)
    if first is None:
        return links.toDF("node", "root")
    roots = first.select(F.col("a").alias("node")).union(first.select("b")).distinct()
    roots = roots.withColumn("root", F.col("node"))
    for step in steps:
        roots = (roots.join(step.select(F.col("node").alias("root"), "to"), "root", "left")
                 .select("node", F.coalesce("to", "root").alias("root")))
    return materialise(roots, "roots", -(-first.count() // EDGES))


def _order(node: Column, seed: int, step: int) -> Column:
    rank = F.xxhash64(node, F.lit(seed + step)) if step else F.lit(0).cast("bigint")
    return F.struct(rank.alias("rank"), node.alias("id"))


def _forests(batches):
    """Stars with the same components as a task's edges, held in bounded memory."""
    held = np.zeros((2, 0), np.int64)

    def reduced(edges):
        nodes, at = np.unique(edges, return_inverse=True)
        at = at.reshape(edges.shape)
        child, root = spanning_forest(at[0], at[1], len(nodes))
        return np.stack([nodes[child], nodes[root]])

    def batch_of(edges):
        return pa.RecordBatch.from_arrays([pa.array(edges[0]), pa.array(edges[1])], ["a", "b"])

    for batch in batches:
        held = np.concatenate([held, np.stack([c.to_numpy() for c in batch.columns])], axis=1)
        if held.shape[1] > EDGES:
            held = reduced(held)
            if held.shape[1] > EDGES // 2:
                yield batch_of(held)
                held = held[:, :0]
    yield batch_of(reduced(held))


def smallest_member(roots: DataFrame, members: DataFrame) -> DataFrame:
    """``(node, component)``: the smallest ``id`` among ``members (node, id)`` of each node's component."""
    files = -(-max(1, roots.count()) // EDGES)
    held = materialise(roots.join(members, "node"), "members", files)
    best = materialise(held.groupBy("root").agg(F.min("id").alias("component")), "smallest", files)
    return held.join(best, "root").select("node", "component")


def spanning_forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Within a task: under ``n`` edges that connect what the links ``(i, j)`` among ``0..n-1`` connect."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, i, label[j])
        np.minimum.at(low, j, label[i])
        low = low[low]
        if (low == label).all():
            child = np.nonzero(label != np.arange(n))[0]
            return child, label[child]
        label = low
