"""Mixing sources to target weights: temperature by bisection, realised as budgeted block permutations.

A source's weight is its share of tokens to the power of an exponent between 0 (all alike) and 1 (as they are), normalised.
The exponent is bisected: the greatest one whose weights reach a target entropy, but no smaller than one under which no
document is repeated more often than a limit. The budget of a source is its weight of the whole budget. A source is gone
through in blocks, each a keyed permutation of all its documents, as long as the budget lasts; of the last block only the
beginning is taken. Without a given budget it is the least under which every document is taken once.

Only per-source numbers reach the driver. Texts are never moved: where a source's last block ends is found from token
counts by ranges of a keyed hash, and one exact look into the range in which it falls.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinlink.storage import materialize

#: Ranges of the keyed hash whose tokens are summed for each source.
RANGES = 4096


@dataclass
class Mixture:
    exponent: float
    weights: np.ndarray
    repeats: np.ndarray  # budget of each source over its tokens


def weights_at(tokens: np.ndarray, exponent: float) -> np.ndarray:
    shares = tokens / tokens.sum()
    raised = np.exp(exponent * (np.log(shares) - np.log(shares).max()))
    return raised / raised.sum()


def entropy(weights: np.ndarray) -> float:
    held = weights[weights > 0]
    return float(-(held * np.log(held)).sum())


def bisected(holds, low: float = 0.0, high: float = 1.0) -> float:
    """The greatest exponent for which ``holds``, which is true at ``low`` and turns false at most once."""
    if holds(high):
        return high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if holds(middle) else (low, middle)
    return low


def temper(tokens: np.ndarray, target: float | None = 0.95, most_repeats: float | None = 2.0, budget: float | None = None) -> Mixture:
    """Exponent, weights and repeats of sources with so many tokens (all positive).

    ``target`` is a share of the greatest possible entropy; ``most_repeats`` limits a source's budget over its tokens. The
    limit comes before the target.
    """
    tokens = np.asarray(tokens, float)
    if not len(tokens):
        return Mixture(1.0, tokens, tokens)

    def repeats(exponent: float) -> np.ndarray:
        ratio = weights_at(tokens, exponent) * (tokens.sum() if budget is None else budget) / tokens
        return ratio / ratio.min() if budget is None else ratio

    exponent = 1.0
    if target is not None and len(tokens) > 1:
        exponent = bisected(lambda x: entropy(weights_at(tokens, x)) >= target * np.log(len(tokens)))
    if most_repeats is not None and repeats(exponent).max() > most_repeats:
        exponent = 1 - bisected(lambda x: repeats(1 - x).max() <= most_repeats + 1e-12, 0.0, 1 - exponent)
        if repeats(1.0).max() > most_repeats + 1e-9:
            raise ValueError("the budget cannot be met within the limit of repeats")
    return Mixture(exponent, weights_at(tokens, exponent), repeats(exponent))


def word_count(text: str = "text") -> Column:
    """Number of words: runs of anything but white space. Null is 0."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mixed_sources(docs: DataFrame, key: int = 1, target: float | None = 0.95, most_repeats: float | None = 2.0, budget: float | None = None, source: str = "source", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` as often as the mixture takes them, with ``mix_epoch`` (from 0) and ``mix_place``.

    ``mix_place`` orders the rows of a source and epoch. Null sources are one source. Rows without words weigh nothing and
    are taken once. Equal rows share a place and are taken alike. An empty table gives no rows. Columns named as those
    added are replaced.
    """
    spark = docs.sparkSession
    rows = docs.drop("mix_epoch", "mix_place")
    place = F.shiftrightunsigned(F.xxhash64(F.lit(key), F.col(f"`{doc_id}`"), F.col(f"`{text}`")), 1)
    rows = rows.withColumns({"_tokens": word_count(text), "_place": place, "_range": F.shiftright(place, 51).cast("int")})
    narrow = rows.select(F.col(f"`{source}`").cast("string").alias("s"), "_tokens", "_place", "_range").where("_tokens > 0")
    narrow = materialize(narrow, "mix-places")  # a few bytes a row; texts are read once more, for the rows themselves
    sums = narrow.groupBy("s", "_range").agg(F.sum("_tokens").alias("tokens"))
    by_source = sums.groupBy("s").agg(F.sum("tokens").alias("tokens"))
    stored = sorted(by_source.collect(), key=lambda r: (r["s"] is not None, r["s"]))  # one row for each source
    plan = temper(np.array([r["tokens"] for r in stored], float), target, most_repeats, budget)
    whole = np.floor(plan.repeats + 1e-9).astype(int) if stored else []
    left = [float(max(0.0, (x - n) * r["tokens"])) for x, n, r in zip(plan.repeats, whole, stored)]
    first = spark.createDataFrame(
        [(r["s"], int(n), rest if rest >= 1 else 0.0) for r, n, rest in zip(stored, whole, left)], "of string, whole int, rest double"
    )
    # in which range of the hash the last block's budget ends, and what is left of it there
    before = Window.partitionBy("s").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    running = sums.withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    same = F.col("s").eqNullSafe(F.col("of"))
    last = running.join(F.broadcast(first), same).where("rest > 0 and before < rest").groupBy("of").agg(
        F.max("_range").alias("edge"), F.max("before").alias("edge_before"), F.first("rest").alias("rest")
    )
    inside = narrow.join(F.broadcast(last), same & (F.col("_range") == F.col("edge")))
    before = Window.partitionBy("s").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("before", F.col("edge_before") + F.coalesce(F.sum("_tokens").over(before), F.lit(0)))
    ends = inside.where("before < rest").groupBy("s").agg(F.max("_place").alias("ends")).collect()  # one row for each source
    upto = {r["s"]: r["ends"] for r in ends}
    final = spark.createDataFrame([(r["s"], int(n), upto.get(r["s"], -1)) for r, n in zip(stored, whole)], "_of string, _whole int, _ends long")
    joined = rows.join(F.broadcast(final), F.col(f"`{source}`").cast("string").eqNullSafe(F.col("_of")), "left")
    times = F.when(F.col("_tokens") == 0, 1).otherwise(F.col("_whole") + (F.col("_place") <= F.col("_ends")).cast("int"))
    taken = joined.withColumn("mix_epoch", F.explode(F.filter(F.sequence(F.lit(0), F.greatest(times, F.lit(1)) - 1), lambda i: i < times)))
    order = F.when(F.col("mix_epoch") == F.col("_whole"), F.col("_place")).otherwise(F.xxhash64("mix_epoch", "_place"))
    return taken.withColumn("mix_place", order).drop("_tokens", "_place", "_range", "_of", "_whole", "_ends")
