"""Pairs of rows whose vectors are near, exactly, without all products of a block.

The angle between unit vectors is a metric, so two rows can be within an angle of each other only if their angles to any
third vector, a pivot, differ by no more. Pivots are rows of the block itself: one, and the row farthest from it. They
serve twice: a block larger than a tile on both sides is cut into cells by the angles to its pivots, unless the reach is
wide, and cells that are too far apart never meet; inside a tile rows are sorted by the angle to a pivot, and each run of rows meets only the rows whose angles
are near its own. Streets come first, on distinct vectors; names are compared only under streets that pass.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinlink.operators.rules import Rule
from kinlink.operators.tiles import compare_tiles
from kinlink.storage import materialize

_ROWS, _STEP = 8192, 256
#: Pairs under passing streets whose names are compared at once.
_PAIRS = 200_000
#: Products of a tile's distinct names that are kept, 8 bytes each.
_GRID = 4_000_000
#: Cosines are rounded to so many digits before they are compared with thresholds and with each other.
_DIGITS = 9
#: More than rounding errors of cosines and angles come to.
_SLACK = 1e-6
#: A cell is the reach of the weakest street threshold over this wide, in the angle to either pivot.
_CELLS = 1
#: With a wider reach few cells are too far apart, and cutting only repeats rows.
_WIDEST = math.pi / 4

_SCHEMA = (
    "block string, left_class bigint, right_class bigint, parent string, "
    "street_score double, name_score double, parent_score double"
)


def unit_rows(column: pd.Series, size: int) -> np.ndarray:
    grid = np.stack([np.zeros(size) if v is None else np.asarray(v, dtype=np.float64) for v in column])
    norm = np.sqrt((grid * grid).sum(axis=1, keepdims=True))
    return grid / np.where(norm > 0, norm, 1.0)


def reach(least: float) -> float:
    """The widest angle between vectors with a cosine of ``least`` or more; none is wider than pi."""
    return math.acos(max(min(least, 1.0), -1.0)) + _SLACK if least > 0 else math.pi + _SLACK


def _angles(rows: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(rows @ pivot, -1.0, 1.0))


def near_rows(a: np.ndarray, b: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Places in ``a`` and ``b`` and rounded cosines of all pairs of unit rows at or above ``least``; and how many cosines
    were computed. A row of zeros has the cosine 0 to all others."""
    wide = reach(least)
    pivots = [b[0]] if len(b) else []
    if pivots:
        pivots.append(b[_angles(b, pivots[0]).argmax()])
    of_a, of_b = ([_angles(x, p) for p in pivots] for x in (a, b))
    rows, order = (np.argsort(x[0], kind="stable") if pivots else np.zeros(0, int) for x in (of_a, of_b))
    found, computed = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0))], 0
    for start in range(0, len(rows) if len(order) else 0, _STEP):
        own = rows[start : start + _STEP]
        low, high = np.searchsorted(of_b[0][order], [of_a[0][own[0]] - wide, of_a[0][own[-1]] + wide], side="left")
        others = order[low : high + 1]
        second = of_a[1][own]
        others = others[(of_b[1][others] >= second.min() - wide) & (of_b[1][others] <= second.max() + wide)]
        # the last bits of a product depend on its place in the matrix: equal texts must have equal scores
        cosines = np.round(a[own] @ b[others].T, _DIGITS)
        computed += cosines.size
        i, j = np.nonzero(cosines >= least)
        found.append((own[i], others[j], cosines[i, j]))
    return *(np.concatenate(x) for x in zip(*found)), computed


def _distinct(column: pd.Series, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows of the distinct vectors of a column and the number of each row's own."""
    which, firsts = pd.factorize(pd.Series([b"" if v is None else np.asarray(v).tobytes() for v in column]))
    places = np.zeros(len(firsts), int)
    places[which[::-1]] = np.arange(len(column))[::-1]
    return unit_rows(column.iloc[places], size), which


def _grouped(own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows sorted by their distinct vector, and where the rows of each vector begin and how many they are."""
    counts = np.bincount(own)
    return np.argsort(own, kind="stable"), np.cumsum(counts) - counts, counts


def _counting(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For stretches of the given lengths, one after the other: which stretch each place is in, and the how manieth there."""
    which = np.repeat(np.arange(len(lengths)), lengths)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _expanded(i: np.ndarray, j: np.ndarray, own: np.ndarray, other: np.ndarray):
    """Pairs of rows for pairs of their distinct vectors, a bounded number of them at a time, and which pair each is of."""
    (mine, mine_at, mine_n), (theirs, theirs_at, theirs_n) = _grouped(own), _grouped(other)
    for base in range(0, len(i), _PAIRS):
        p, q = i[base : base + _PAIRS], j[base : base + _PAIRS]
        step = np.maximum(_PAIRS // theirs_n[q], 1)  # left rows of a pair that are taken at once
        pair, part = _counting(-(-mine_n[p] // step))
        first = part * step[pair]
        size = np.minimum(mine_n[p][pair] - first, step[pair]) * theirs_n[q][pair]
        first += mine_at[p][pair]
        ends, start = np.cumsum(size), 0
        while start < len(pair):
            end = max(int(np.searchsorted(ends, ends[start] - size[start] + _PAIRS, side="right")), start + 1)
            which, at = _counting(size[start:end])
            which = which + start
            some = q[pair[which]]
            left, right = np.divmod(at, theirs_n[some])
            yield mine[first[which] + left], theirs[theirs_at[some] + right], pair[which] + base
            start = end


class _Products:
    """Rounded cosines of pairs of rows. Where the grid of both sides is small, each pair is computed once for a tile."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self._a, self._b = a, b
        self._grid = np.full(len(a) * len(b), np.nan) if len(a) * len(b) <= _GRID else None

    def _computed(self, key: np.ndarray) -> np.ndarray:
        out = np.empty(len(key))
        for start in range(0, len(key), 20_000):
            p, q = np.divmod(key[start : start + 20_000], len(self._b))
            out[start : start + 20_000] = np.einsum("ij,ij->i", self._a[p], self._b[q])
        return np.round(out, _DIGITS)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        key = i * len(self._b) + j
        if self._grid is None:
            key, back = np.unique(key, return_inverse=True)
            return self._computed(key)[back]
        new = np.unique(key[np.isnan(self._grid[key])])
        self._grid[new] = self._computed(new)
        return self._grid[key]


@F.pandas_udf(T.DoubleType())
def _angle(vector: pd.Series, pivot: pd.Series) -> pd.Series:
    size = max((len(v) for column in (vector, pivot) for v in column if v is not None), default=1)
    cosines = (unit_rows(vector, size) * unit_rows(pivot, size)).sum(axis=1) if len(vector) else np.zeros(0)
    return pd.Series(np.arccos(np.clip(cosines, -1.0, 1.0)))


def _in_cells(lefts: DataFrame, rights: DataFrame, wide: float, rows: int) -> tuple[DataFrame, DataFrame, bool]:
    """Both sides with the cells of their streets' angles to two pivots; blocks of which one side fits a tile are one cell,
    as there each row of the other side is in one tile anyway.

    The pivots are a right row and the right row farthest from it: one row for each large block.
    """
    if wide > _WIDEST:
        return lefts, rights, False
    counts = [df.groupBy("block").agg(F.count("*").alias("n")).where(F.col("n") > rows) for df in (lefts, rights)]
    large = materialize(counts[0].join(counts[1].select("block"), "block").select("block"), "large-vector-blocks")
    if large.isEmpty():
        return lefts, rights, False
    known = rights.where("vs IS NOT NULL").join(large, "block", "left_semi")
    first = known.groupBy("block").agg(F.min_by("vs", F.xxhash64("right_class")).alias("_p"))
    placed = known.join(first, "block").select("block", "vs", _angle("vs", "_p").alias("angle"))
    second = placed.groupBy("block").agg(F.max_by("vs", "angle").alias("_q"))
    pivots = materialize(first.join(second, "block"), "pivots")
    cell = lambda p: F.coalesce(F.floor(_angle("vs", p) / F.lit(wide / _CELLS)).cast("int"), F.lit(0))

    def with_cells(df: DataFrame) -> DataFrame:
        inside = df.join(large, "block", "left_semi").join(pivots, "block", "left")
        inside = inside.withColumns({"_c": cell("_p"), "_d": cell("_q")}).drop("_p", "_q")
        outside = df.join(large, "block", "left_anti").withColumns({"_c": F.lit(0), "_d": F.lit(0)})
        return inside.unionByName(outside)

    return with_cells(lefts), with_cells(rights), True


def _of_texts(column: pd.Series, texts: pd.Index, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows of the distinct texts of a column and the number of each row's own; a missing text is a row of zeros."""
    which, firsts = pd.factorize(texts.get_indexer(column))
    return np.where((firsts >= 0)[:, None], rows[firsts], 0.0), which


def vector_pairs(
    lefts: DataFrame, rights: DataFrame, rules: list[Rule], tile_rows: int = _ROWS, counters: dict | None = None, vectors: DataFrame | None = None
) -> DataFrame:
    """Scored pairs from ready vectors: ``vs``, ``vn`` and, on the right, ``vp`` with its ``parent`` text.

    With ``vectors``, a table ``(text, vector)``, rows have their texts ``ts``, ``tn``, ``tp`` in place of ``vn`` and ``vp``, and a
    tile gets the vector of each of its texts once; ``vs`` only cuts large blocks into cells.

    ``counters`` may hold accumulators: ``pairs`` counts pairs of distinct streets in tiles, ``streets`` the products of
    them that were computed, ``names`` the pairs of rows whose names were compared.
    """
    least = min(r.street for r in rules)
    tell = counters or {}

    def compare(x: pd.DataFrame, y: pd.DataFrame, known: pd.DataFrame | None = None) -> pd.DataFrame:
        if known is None:
            size = len(y["vs"].iloc[0])
            distinct, street_of, own_name_of, parent_text = (lambda c: _distinct(c, size)), "vs", "vn", "vp"
        else:
            texts = pd.Index(known["text"])
            rows = unit_rows(known["vector"], len(known["vector"].iloc[0]))
            distinct, street_of, own_name_of, parent_text = (lambda c: _of_texts(c, texts, rows)), "ts", "tn", "tp"
        (own_street, own), (street, other) = distinct(x[street_of]), distinct(y[street_of])
        (own_name, name_of), (names, theirs), (parents, parent_of) = (
            distinct(c) for c in (x[own_name_of], y[own_name_of], y[parent_text])
        )
        no_name, no_parent = (y[c].isna().to_numpy() for c in (own_name_of, parent_text))
        i, j, score, computed = near_rows(own_street, street, least)
        by_name, by_parent = _Products(own_name, names), _Products(own_name, parents)
        compared, found = 0, []
        for left, right, pair in _expanded(i, j, own, other):
            at = score[pair]
            compared += len(left)
            name, parent = (
                np.where(missing[right], -1.0, products(name_of[left], which[right]))
                for products, which, missing in ((by_name, theirs, no_name), (by_parent, parent_of, no_parent))
            )
            keep = np.zeros(len(left), bool)
            for r in rules:
                keep |= (at >= r.street) & ((name >= r.name) | (parent >= r.parent))
            left, right = left[keep], right[keep]
            found.append(
                pd.DataFrame(
                    {
                        "block": x["block"].to_numpy()[left],
                        "left_class": x["left_class"].to_numpy()[left],
                        "right_class": y["right_class"].to_numpy()[right],
                        "parent": y["parent"].to_numpy()[right],
                        "street_score": at[keep],
                        "name_score": name[keep],
                        "parent_score": parent[keep],
                    }
                )
            )
        for key, n in (("pairs", len(own_street) * len(street)), ("streets", computed), ("names", compared)):
            if key in tell:
                tell[key].add(n)
        return pd.concat(found) if found else pd.DataFrame({c.split()[0]: [] for c in _SCHEMA.split(", ")}, dtype=object)

    wide = reach(least)
    lefts, rights, cut = _in_cells(lefts, rights, wide, tile_rows)
    known = None
    if vectors is not None:
        lefts, rights = lefts.drop("vs"), rights.drop("vs")
        known = vectors, {"left": ["ts", "tn"], "right": ["ts", "tn", "tp"]}
    far = f"abs(l_{{0}} - r_{{0}}) - 1 >= {_CELLS} + {_SLACK}"
    meet = " AND ".join(f"NOT ({far.format(c)})" for c in ("_c", "_d")) if cut else None
    return compare_tiles(
        lefts, rights, ["block"], "left_class", "right_class", compare, _SCHEMA, tile_rows, ["_c", "_d"] if cut else [], meet, known
    )
