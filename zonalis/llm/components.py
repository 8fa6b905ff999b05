"""Connected components of large edge lists by alternating large and small stars."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.session import stage

FLUSH_EDGES = 1_000_000


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct nodes of the edges and the smallest node each one reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    parent = np.arange(len(nodes))
    while len(u):
        ru, rv = parent[u], parent[v]
        low = np.minimum(ru, rv)
        if (ru == rv).all():
            break
        np.minimum.at(parent, ru, low)
        np.minimum.at(parent, rv, low)
        while (parent[parent] != parent).any():
            parent = parent[parent]
    return nodes, nodes[parent]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a task as stars, which keep what is connected."""
    a, b, n = [], [], 0

    def stars():
        node, root = roots(np.concatenate(a), np.concatenate(b))
        keep = node != root
        return pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(root[keep])], ["u", "v"])

    for batch in batches:
        a.append(batch.column(0).to_numpy(zero_copy_only=False))
        b.append(batch.column(1).to_numpy(zero_copy_only=False))
        n += len(batch)
        if n >= FLUSH_EDGES:
            yield stars()
            a, b, n = [], [], 0
    if n:
        yield stars()


def _least(edges: DataFrame) -> DataFrame:
    """Smallest neighbour by node, written down: a join with it can then be split at a hot node."""
    return stage(edges.groupBy("u").agg(F.min("v").alias("m")), "least")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id`` and ``component`` (smallest id reached) of every node that has an edge.

    Ids are longs; edges with a null end and loops are left out. Each round halves the depth, is
    written to the shared folder, and reads two small rows per edge; a node with very many edges
    is one side of a join that adaptive execution splits.
    """
    known = edges.select(F.col(a).cast("bigint").alias("u"), F.col(b).cast("bigint").alias("v"))
    known = known.where("u IS NOT NULL AND v IS NOT NULL AND u != v")
    now = stage(known.mapInArrow(_local, "u bigint, v bigint"), "stars")
    last = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "stars")
        low = _least(large)
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stage(small.unionByName(low.withColumnRenamed("m", "v")).distinct(), "stars")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == last:
            break
        last = mark
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
