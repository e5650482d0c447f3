"""Connected components of a graph that may be too large for one task."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.operators.ordering import by_shuffle
from kinlink.storage import discard, materialize

#: Edges that one task settles, some 50 bytes each.
EDGES_AT_ONCE = 1_000_000


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All components in turns: each root joins the least root that an edge leads to."""
    edges = pa.Table.from_batches(batches)
    nodes, ends = np.unique(np.concatenate([edges[c].to_numpy() for c in ("node", "other")]), return_inverse=True)
    a, b = ends.reshape(2, -1)
    root = np.arange(len(nodes))
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
        a, b = root[a], root[b]
        a, b = a[a != b], b[a != b]
    yield from pa.table({"node": nodes, "component": nodes[root]}).to_batches()


def _state(edges: DataFrame) -> tuple:
    digest = F.bit_xor(F.xxhash64("node", "other"))
    return tuple(edges.agg(F.count("*"), digest).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges`` (node and other, numbers); a component is named by its least node.

    Large-star and small-star rounds: each node links its larger neighbours, then its smaller ones, to the least node it
    knows, until every node is linked to nothing but the least of its component. Rounds grow with the logarithm of the
    nodes, not with the length of a chain; each is a written table and takes aggregates and joins only. Up to
    ``EDGES_AT_ONCE`` edges are settled in one task.
    """
    edges = edges.select("node", "other").where("node != other")
    edges = materialize(edges.selectExpr("greatest(node, other) AS node", "least(node, other) AS other").distinct(), "edges")
    state = _state(edges)
    if 0 < state[0] <= EDGES_AT_ONCE:
        return edges.coalesce(1).mapInArrow(_settle, "node bigint, component bigint")
    while state[0]:
        both = edges.union(edges.select("other", "node"))
        least = both.groupBy("node").agg(F.min("other").alias("_least"))
        least = least.select("node", F.least("node", "_least").alias("_least"))
        large = both.where("other > node").join(by_shuffle(least), "node").selectExpr("other AS node", "_least AS other").distinct()
        large = materialize(large, "large-star")
        least = large.groupBy("node").agg(F.min("other").alias("_least"))
        small = large.join(by_shuffle(least), "node").selectExpr("IF(other = _least, node, other) AS node", "_least AS other").distinct()
        small = materialize(small, "small-star")
        discard(large)
        discard(edges)
        edges, before, state = small, state, _state(small)
        if state == before:
            break
    roots = edges.select(F.col("other").alias("node"), F.col("other").alias("component")).distinct()
    return edges.select("node", F.col("other").alias("component")).union(roots)
