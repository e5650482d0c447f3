"""Best candidate per text inside a block: top one by a string score."""

from collections.abc import Callable, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.functions.edits import code_points, lcs_of_codes, ranges, ratio_from
from kinlink.functions.wordsets import Vocabulary, WordSets, best_ratio, pair_scores
from kinlink.operators.tiles import compare_tiles

_TILE_ROWS = 2048
_STEP = 64
_LETTERS = 64


def _letter_counts(codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How often each text has letters of each of 64 kinds; the counts in common bound a common subsequence."""
    row = np.repeat(np.arange(len(lengths)), lengths)
    counts = np.bincount(row * _LETTERS + codes % _LETTERS, minlength=len(lengths) * _LETTERS)
    return counts.reshape(len(lengths), _LETTERS)


def _letters_in_common(own: np.ndarray, other: np.ndarray) -> np.ndarray:
    grid = np.zeros((len(own), len(other)), dtype=np.int64)
    for k in np.flatnonzero(own.any(axis=0) & other.any(axis=0)):
        grid += np.minimum(own[:, k, None], other[None, :, k])
    return grid


class Ratio:
    """Insert/delete ratio, bounded by the texts' lengths and the letters they have in common."""

    def __init__(self, own: np.ndarray, other: np.ndarray):
        codes, lengths = code_points([*own, *other])
        starts, counts = np.cumsum(lengths) - lengths, _letter_counts(codes, lengths)
        n = len(own)
        self.codes, self.start_a, self.start_b = codes, starts[:n], starts[n:]
        self.len_a, self.len_b, self.count_a, self.count_b = lengths[:n], lengths[n:], counts[:n], counts[n:]

    def bound(self, rows: slice) -> np.ndarray:
        common = _letters_in_common(self.count_a[rows], self.count_b)
        return ratio_from(common, self.len_a[rows, None] + self.len_b[None, :])

    def score(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        lcs = lcs_of_codes(self.codes, self.start_a[i], self.len_a[i], self.start_b[j], self.len_b[j])
        return ratio_from(lcs, self.len_a[i] + self.len_b[j])


class SortedTokens(Ratio):
    """The same ratio of the texts' words in alphabetical order."""

    def __init__(self, own: np.ndarray, other: np.ndarray):
        super().__init__(*([" ".join(sorted(t.split())) for t in texts] for texts in (own, other)))


class TokenSet:
    """Word-set ratio. Postings of the words say which words a pair shares; letters in common bound what the rests share."""

    def __init__(self, own: np.ndarray, other: np.ndarray):
        self.own, self.other = Vocabulary(own, other).sides()
        self.sizes = self.own.vocabulary.lengths
        self.order = np.argsort(self.other.words, kind="stable")
        self.rows = np.repeat(np.arange(len(other)), self.other.counts)[self.order]
        self.first = np.searchsorted(self.other.words[self.order], np.arange(len(self.sizes) + 1))
        self.letters_a, self.letters_b = (self._letters(s) for s in (self.own, self.other))
        self.count_a, self.count_b = (self._counts(s) for s in (self.own, self.other))

    def _letters(self, side: WordSets) -> np.ndarray:
        row = np.repeat(np.arange(len(side.counts)), side.counts)
        return np.bincount(row, weights=self.sizes[side.words], minlength=len(side.counts)).astype(np.int64)

    def _counts(self, side: WordSets) -> np.ndarray:
        v = side.vocabulary
        row = np.repeat(np.arange(len(side.counts)), side.counts)
        letters = v.codes[ranges(v.starts[side.words], v.lengths[side.words])]
        lengths = np.bincount(row, weights=self.sizes[side.words], minlength=len(side.counts)).astype(np.int64)
        return _letter_counts(letters, lengths)

    def bound(self, rows: slice) -> np.ndarray:
        counts, starts = self.own.counts[rows], self.own.starts[rows]
        words = self.own.words[ranges(starts, counts)]
        row = np.repeat(np.arange(len(counts)), counts)
        hits = self.first[words + 1] - self.first[words]
        cell = np.repeat(row, hits) * len(self.other.counts) + self.rows[ranges(self.first[words], hits)]
        shape = (len(counts), len(self.other.counts))
        many = np.bincount(cell, minlength=shape[0] * shape[1]).reshape(shape)
        weights = np.repeat(self.sizes[words], hits)
        shared = np.bincount(cell, weights=weights, minlength=shape[0] * shape[1]).astype(np.int64).reshape(shape)
        left_a, left_b = counts[:, None] - many, self.other.counts[None, :] - many
        gaps_a, gaps_b = np.maximum(left_a - 1, 0), np.maximum(left_b - 1, 0)
        common = _letters_in_common(self.count_a[rows], self.count_b) - shared + np.minimum(gaps_a, gaps_b)
        len_a = self.letters_a[rows, None] - shared + gaps_a
        len_b = self.letters_b[None, :] - shared + gaps_b
        known = (counts[:, None] > 0) & (self.other.counts[None, :] > 0)
        return np.where(known, best_ratio(common, many, shared, len_a, len_b), 0.0)

    def score(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return pair_scores(self.own, i, self.other, j)


SCORERS = {"ratio": Ratio, "token_sort": SortedTokens, "token_set": TokenSet}


def first_best(bound: np.ndarray, score: Callable, cutoff: float) -> tuple[np.ndarray, np.ndarray, int]:
    """For each row of an upper bound the column with the highest score from ``cutoff`` up, the first one of equals and -1 if
    there is none; its score; and how many scores were computed.

    Columns are scored by falling bound, twice as many in each round, until the next bound is below the best score.
    """
    order = np.argsort(-bound, axis=1, kind="stable")
    rows, width = bound.shape
    top, best, scored = np.full(rows, -1), np.full(rows, float(cutoff)), 0
    live, at, step = np.arange(rows), 0, 2
    while len(live) and at < width:
        live = live[bound[live, order[live, at]] >= best[live]]
        columns = order[live, at : at + step]
        limit, now = bound[live[:, None], columns], best[live, None]
        sooner = (top[live, None] < 0) | (columns < top[live, None])
        i, k = np.nonzero((limit > now) | ((limit == now) & sooner))
        if len(i):
            found = score(live[i], columns[i, k])
            scored += len(i)
            grid = np.full(columns.shape, -np.inf)
            grid[i, k] = found
            most = grid.max(axis=1)
            column = np.where(grid == most[:, None], columns, width).min(axis=1)
            wins = (most > best[live]) | ((most == best[live]) & ((top[live] < 0) | (column < top[live])))
            top[live[wins]], best[live[wins]] = column[wins], most[wins]
        at, step = at + step, step * 2
    return top, best, scored


def best_in_block(
    left: DataFrame, right: DataFrame, block: str, scorer: str, cutoff: float = 0.0, counters: Mapping | None = None
) -> DataFrame:
    """``(left_value, right_value, score)``: highest score, then the alphabetically first right value.

    A left value whose best score is below ``cutoff`` has no row.

    Both inputs have ``block`` and ``value``, distinct. A tile scores only candidates whose bound reaches the best score so far
    and returns one row per left value; these are reduced by an ordinary aggregate. ``counters`` are accumulators for the
    ``pairs`` that meet in tiles and those ``scored``.
    """
    make = SCORERS[scorer]

    def compare(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        own, texts = x["value"].to_numpy(object), np.sort(y["value"].to_numpy(object))
        pairs, found = make(own, texts), []
        for start in range(0, len(own), _STEP):
            rows = slice(start, min(start + _STEP, len(own)))
            top, best, scored = first_best(
                pairs.bound(rows), lambda i, j, start=start: pairs.score(i + start, j), cutoff
            )
            kept = top >= 0
            found.append(
                pd.DataFrame({"left_value": own[rows][kept], "right_value": texts[top[kept]], "score": best[kept]})
            )
            if counters:
                counters["pairs"].add(len(top) * len(texts))
                counters["scored"].add(scored)
        return pd.concat(found)

    tops = compare_tiles(
        left.select(block, "value"),
        right.select(block, "value"),
        [block],
        "value",
        "value",
        compare,
        "left_value string, right_value string, score double",
        _TILE_ROWS,
    )
    first = F.min(F.struct((-F.col("score")).alias("loss"), F.col("right_value").alias("value")))
    return (
        tops.groupBy("left_value")
        .agg(first.alias("best"))
        .select("left_value", F.col("best.value").alias("right_value"), (-F.col("best.loss")).alias("score"))
    )
