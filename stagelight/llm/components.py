"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round replaces each edge by one that points to a smaller neighbour, so the table never grows; no edge or label
reaches the driver but the count that tells whether a round changed anything. Hubs are handled by a partially
aggregated minimum and a join that adaptive execution can split. What is left at LOCAL edges or fewer goes to one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagelight.llm.common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """edges (u, v), u > v: each larger neighbour of a node goes to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m")).select("c", F.least("c", "m").alias("m"))
    return edges.join(least, edges.v == least.c).select("u", F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the least of them."""
    least = edges.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    joined = edges.join(least, edges.u == least.c)
    ends = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
    return joined.select(F.explode(ends).alias("e")).select("e.u", "e.v").where("u <> v").distinct()


#: A table with at most so many edges is solved in one task, in about 100 MB: rounds over little data cost more than it
LOCAL = 1_000_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v) of all edges -> (u, v): each node that is no root, and its root, the smallest of its component."""
    ends = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    u, v = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*ends, strict=True) if ends else ((), ())))
    nodes, place = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            break
        np.minimum.at(root, high[apart], low[apart])  # each root goes to the smallest beside it: half of them at least go
        while (root[root] != root).any():
            root = root[root]
    inner = root != np.arange(len(nodes))
    yield pa.RecordBatch.from_arrays([pa.array(nodes[inner]), pa.array(nodes[root[inner]])], names=["u", "v"])


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) for every node that has an edge to another: root is the smallest node reachable. Nulls, loops and
    repeated edges are ignored; an empty table gives an empty one. Nodes are whole numbers."""
    now = edges.where(F.col(u).isNotNull() & F.col(v).isNotNull() & (F.col(u) != F.col(v)))
    now = cut(now.select(F.greatest(u, v).cast("long").alias("u"), F.least(u, v).cast("long").alias("v")).distinct())
    state = None
    while True:
        # a table that a round leaves as it is consists of stars around roots
        h = F.xxhash64("u", "v")
        after = tuple(now.agg(F.count("*"), F.sum(h.bitwiseAND(F.lit(2**31 - 1))), F.sum(F.shiftrightunsigned(h, 33))).head())
        if after[0] == 0 or after == state:
            break
        if after[0] <= LOCAL:
            now = cut(now.coalesce(1).mapInArrow(_contract, "u long, v long"))
            break
        state = after
        now = cut(_small_star(_large_star(now)))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
