"""Connected components of an edge table, as alternating star rounds of joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkeep.llm.common import staged


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges and the smallest node each is tied to by these edges alone."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if np.array_equal(new, root):
            return nodes, nodes[root]
        root = new


def contract(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) of one task as star edges to local roots; a batch at a time, merged."""
    a = b = np.empty(0, np.int64)
    for batch in rows:
        a = np.concatenate([a, batch.column(0).to_numpy(zero_copy_only=False)])
        b = np.concatenate([b, batch.column(1).to_numpy(zero_copy_only=False)])
        if len(a) > 1_000_000:
            node, root = local_roots(a, b)
            a, b = node[node != root], root[node != root]
            if len(a) > 500_000:  # full of true stars: hand them on and start anew
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
                a = b = np.empty(0, np.int64)
    if len(a):
        node, root = local_roots(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(node[node != root]), pa.array(root[node != root])], ["a", "b"])


def _pairs(e: DataFrame) -> DataFrame:
    return e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def connected_components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, component) of every node on an edge; component is its smallest node.

    ``edges`` has two long columns. Edges are first contracted where they are. Then each
    round ties every node's larger neighbours, and after that its smaller ones, to the
    smallest neighbour, until nothing changes: about log(n) rounds, whatever the shape. A
    round moves edges only, aggregates before it shuffles, and its joins are inner joins of
    two shuffles, so a node with millions of edges is split by adaptive execution. Rounds
    are cut by tables in the shared folder. NULL ends and loops are left out; repeated
    edges count once; an empty table has no nodes.
    """
    a, b = edges.columns[:2]
    e = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    e = e.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").mapInArrow(contract, "a long, b long")
    e = staged(_pairs(e), purpose)
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            low.select("a", F.col("low").alias("b"))
        )
        e = staged(small.where("a <> b").distinct(), purpose)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = e.select(F.col("b").alias("node")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
