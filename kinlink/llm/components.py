"""Connected components of a table of links, with small tables and no driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.storage import materialize


def _nearest(links: DataFrame) -> DataFrame:
    """Each node's least neighbour or itself; ``links`` has a row (a, b) for each direction that counts."""
    return links.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))


def _checksum(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b of type long); a component is named by its least node.

    Links are rewired in turn to the least neighbour of the larger and of the smaller end, until nothing changes; what is
    left are stars. The rounds grow with the logarithm of a component's diameter. Every round is a written table.
    """
    now = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = _checksum(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _nearest(both)
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.where("a <> b").distinct()
        least = _nearest(large)
        small = large.join(least, "a").select("a", "b", "least")
        small = small.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            small.select("a", F.col("least").alias("b"))
        )
        now = materialize(small.where("a <> b").distinct(), "links")
        before, seen = seen, _checksum(now)
        if before == seen:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
