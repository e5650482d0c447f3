"""Nearest neighbours by cosine: stable projections to few dimensions, a kd-tree over them and a chi-square stopping test.

Vectors are scaled to length one, so the largest cosine is the smallest distance. Each is projected by a Gaussian matrix to
``DIMENSIONS`` numbers; the squared projected distance of a pair, over its squared distance, is chi-square distributed with
so many degrees of freedom. A query opens the leaves of the tree in the order of projected distance and verifies points
in full, nearest projections first. It stops where a point nearer than its k-th best would, with probability ``SURE``, have
come before.

Rows are cut into blocks and queries into runs; a task holds one block's tree and one run. Every row is indexed.
"""

from __future__ import annotations

from math import exp, factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIMENSIONS = 8
SURE = 0.95
BLOCK, RUN, LEAF = 16_384, 4_096, 64


def chi_square(x: float, degrees: int = DIMENSIONS) -> float:
    """The distribution function for an even number of degrees."""
    half = x / 2
    return 1 - exp(-half) * sum(half**j / factorial(j) for j in range(degrees // 2))


def chi_square_quantile(share: float, degrees: int = DIMENSIONS) -> float:
    low, high = 0.0, 1_000.0
    while high - low > 1e-9:
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < share else (low, middle)
    return high


def projection(size: int, seed: int = 17) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((size, DIMENSIONS))


class Tree:
    """A kd-tree whose leaves are stretches of ``order``; each leaf has the box of its points."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        todo, bounds = [(0, len(points))], []
        while todo:
            a, b = todo.pop()
            own = points[self.order[a:b]]
            spans = np.ptp(own, axis=0) if b > a else np.zeros(1)
            if b - a <= leaf or spans.max() == 0:
                bounds.append((a, b, own.min(0), own.max(0)))
                continue
            middle = (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(own[:, spans.argmax()], middle)]
            todo += [(a, a + middle), (a + middle, b)]
        self.begin = np.array([x[0] for x in bounds])
        self.end = np.array([x[1] for x in bounds])
        self.low = np.array([x[2] for x in bounds])
        self.high = np.array([x[3] for x in bounds])

    def leaves_from(self, point: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaves by the squared distance of their boxes, and those distances: incremental neighbours, a leaf at a time."""
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        far = (gap * gap).sum(1)
        order = np.argsort(far, kind="stable")
        return order, far[order]


def exact_cosines(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosines summed component by component in order, so that equal vectors have equal scores anywhere."""
    dot, own, other = np.zeros(len(rows)), np.zeros(len(rows)), 0.0
    for j in range(rows.shape[1]):
        dot += rows[:, j] * query[j]
        own += rows[:, j] * rows[:, j]
        other += query[j] * query[j]
    return dot / (np.sqrt(own) * np.sqrt(other))


class Block:
    """One block of vectors with its tree. Equal vectors are one point with the ids of all its rows, ascending."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
        as_bytes = vectors.view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel()
        _, first, of_row = np.unique(as_bytes, return_index=True, return_inverse=True)
        by_point = np.argsort(of_row, kind="stable")
        self.owned = np.split(ids[by_point], np.searchsorted(of_row[by_point], np.arange(1, len(first))))
        raw = vectors[first]
        unit = raw / np.sqrt((raw * raw).sum(1, keepdims=True))
        self.matrix = projection(raw.shape[1])
        projected = unit @ self.matrix
        self.tree = Tree(projected)
        self.points = self.tree.order
        self.low_points = projected[self.points]
        self.copies = np.array([len(x) for x in self.owned])[self.points]
        self.raw, self.unit = raw[self.points], unit[self.points]
        place = np.argsort(self.points)[of_row]
        found, begins = np.unique(ids, return_index=True)
        self.places = dict(zip(found.tolist(), np.split(place, begins[1:])))

    def nearest(self, own_id: int, query: np.ndarray, k: int, limit: float) -> tuple[list[tuple[int, float]], int]:
        """The k best (id, cosine) found, ties to the smaller id, and how many points were verified.

        Rows of the query's own id are no candidates; any other row counts, whether its id is repeated or not.
        """
        copies = self.copies.copy()
        own_places = self.places.get(own_id, np.zeros(0, np.int64))
        np.subtract.at(copies, own_places, 1)
        copies = np.minimum(copies, k + 1)
        most = k if len(own_places) else k + 1
        unit = query / np.sqrt((query * query).sum())
        aim = unit @ self.matrix
        leaves, far = self.tree.leaves_from(aim)
        begin, end, far = self.tree.begin[leaves], self.tree.end[leaves], np.append(far, np.inf)
        at, step, best = 0, 4, np.zeros(0)
        waiting, distance = np.zeros(0, np.int64), np.zeros(0)
        seen_places, seen_cosines = [waiting], [distance]
        reach = np.inf
        while at < len(leaves) and far[at] <= reach:
            stop = min(at + step, len(leaves))
            new = np.concatenate([np.arange(a, b) for a, b in zip(begin[at:stop], end[at:stop])])
            waiting = np.concatenate([waiting, new])
            distance = np.concatenate([distance, ((self.low_points[new] - aim) ** 2).sum(1)])
            at, step = stop, step * 2
            # nothing outside the opened leaves is projected nearer than the next box
            ready = distance <= min(far[at], reach)
            places, waiting, distance = waiting[ready], waiting[~ready], distance[~ready]
            cosines = self.unit[places] @ unit
            seen_places.append(places)
            seen_cosines.append(cosines)
            near = cosines > best[-1] if len(best) >= most else np.ones(len(cosines), bool)
            best = np.sort(np.concatenate([best, np.repeat(cosines[near], copies[places[near]])]))[::-1][:most]
            if len(best) >= most:
                reach = limit * max(2 - 2 * best[-1], 0.0)
        if at < len(leaves) or len(waiting):  # what lies between the last box and the reach
            ready = distance <= reach
            seen_places.append(waiting[ready])
            seen_cosines.append(self.unit[waiting[ready]] @ unit)
        places, cosines = np.concatenate(seen_places), np.concatenate(seen_cosines)
        verified = len(places)
        if len(best):
            places = places[cosines >= best[-1] - 1e-9]
        scores = exact_cosines(self.raw[places], query)
        others = lambda p: (ids := self.owned[self.points[p]])[ids != own_id][:k].tolist()
        found = [(-s, i) for p, s in zip(places, scores) for i in others(p)]
        return [(i, -s) for s, i in sorted(found)[:k]], verified


def usable(vector: str) -> Column:
    """Whether a vector is neither null, empty nor zero and all its components are finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(F.col(vector).isNotNull() & F.forall(vector, finite) & some, F.lit(False))


def nearest(vectors: DataFrame, queries: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", sure: float = SURE) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found of every row for which ``queries`` holds.

    A query is held against all rows but its own; vectors of another length than its own are none of its candidates. Nulls,
    zero vectors and those with null or non-finite components take no part, nor do rows without an id. Fewer than k
    candidates are all returned; an empty table gives no rows. Candidate rows that repeat an id count as rows, each with a
    rank of its own. Rows that repeat id and vector ask once; different vectors under one id each ask for their own k.
    """
    source = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"), queries.alias("asks"))
    rows = source.where(usable("v") & F.col("id").isNotNull()).withColumn("dim", F.size("v"))
    total = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("asks").cast("long")), F.lit(0)).alias("q")).first()
    blocks, runs = -(-total["n"] // BLOCK) or 1, -(-total["q"] // RUN) or 1
    hashed = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    data = rows.select("dim", "id", "v", hashed(blocks).alias("block")).withColumn("run", every(runs))
    once = rows.where("asks").select("dim", "id", "v").distinct()
    asking = once.select("*", F.xxhash64("v").alias("of"), hashed(runs).alias("run")).withColumn("block", every(blocks))
    limit = chi_square_quantile(sure)

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            block = Block(left["id"].to_numpy(), np.stack(left["v"].to_numpy()), k)
            for own, of, query in zip(right["id"].tolist(), right["of"].tolist(), right["v"]):
                out += [(own, of, i, s) for i, s in block.nearest(own, np.asarray(query), k, limit)[0]]
        return pd.DataFrame(out, columns=["query_id", "of", "vec_id", "score"]).astype({"query_id": "int64", "of": "int64", "vec_id": "int64", "score": "float64"})

    keys = ["dim", "block", "run"]
    found = data.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInPandas(search, "query_id long, of long, vec_id long, score double")
    order = Window.partitionBy("query_id", "of").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
