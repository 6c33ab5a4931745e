"""Connected components of a distributed edge table by hooking and pointer jumping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Scratch

#: Up to so many edges (of 16 bytes) are settled in one task; more take rounds over tables. Both give the same components.
FEW_EDGES = 1 << 19


def least_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of edges (a, b), sorted, and for each the smallest id of its component."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(ids))
    while True:
        rx, ry = root[x], root[y]
        apart = rx != ry
        if not apart.any():
            return ids, ids[root]
        x, y, rx, ry = x[apart], y[apart], rx[apart], ry[apart]
        np.minimum.at(root, np.maximum(rx, ry), np.minimum(rx, ry))
        while not np.array_equal(up := root[root], root):
            root = up


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if parts:
        ids, comp = least_reachable(np.concatenate([a for a, _ in parts]), np.concatenate([b for _, b in parts]))
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(comp)], names=["u", "p"])


def components(scratch: Scratch, edges: DataFrame, few: int = FEW_EDGES) -> DataFrame:
    """(id, comp) for every id of ``edges`` (a, b): comp is the smallest id that can be reached.

    In each round every root hooks to its smallest neighbour, pointers are doubled until all trees are stars, and the edges
    are rewritten between roots; inner edges vanish. Every tree has two roots of the round before at least, so that rounds grow
    with the logarithm of a component's size, as do the doublings of a round; all state stays in tables. Edges between
    roots that have become few are settled in one task.
    """
    e = scratch.cut(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = None
    while True:
        n = e.count()
        if labels is not None and not n:
            return labels
        if n <= few:
            settled = scratch.cut(e.repartition(1).mapInArrow(_settled, "u long, p long"))
            if labels is None:
                return settled.select(F.col("u").alias("id"), F.col("p").alias("comp"))
            settled = settled.withColumnRenamed("u", "comp")
            settled = F.broadcast(settled) if 2 * n <= BROADCAST_ROWS else settled
            return scratch.cut(labels.join(settled, "comp", "left").select("id", F.coalesce("p", "comp").alias("comp")))
        if labels is None:
            labels = scratch.cut(e.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("comp", F.col("id")))
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(e.select("b", "a"))
        hook = scratch.cut(both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("p")))
        jump = hook
        while True:  # until every tree is a star
            up = jump.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            higher = scratch.cut(jump.select("u", "p").join(up, "p").select("u", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")))
            scratch.drop(jump)
            jump = higher
            if jump.where("moved").isEmpty():
                jump = jump.drop("moved")
                break
        labels2 = scratch.cut(labels.join(jump.withColumnRenamed("u", "comp"), "comp", "left").select("id", F.coalesce("p", "comp").alias("comp")))
        e2 = e.join(jump.select(F.col("u").alias("a"), F.col("p").alias("pa")), "a").join(jump.select(F.col("u").alias("b"), F.col("p").alias("pb")), "b")
        e2 = scratch.cut(e2.where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
        scratch.drop(e, higher, labels)
        e, labels = e2, labels2
