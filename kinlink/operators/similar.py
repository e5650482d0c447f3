"""Similarity join of text values: all pairs at or above a score, without comparing every value with every other."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.functions.edits import indel_scores
from kinlink.functions.similarity import indel_ratio_once, may_reach
from kinlink.operators.tiles import compare_tiles

_BUCKETS = 4096
_EDGE = "\u0002"
#: The signature is lossless from this threshold up.
LEAST_SIGNED = 70
_TILE_ROWS, _STEP = 2048, 64


def gram_size(threshold: float) -> int:
    """Longer grams are rarer; shorter ones survive more edits."""
    return 4 if threshold >= 93 else 3 if threshold >= 87 else 2


def lost_gram_share(threshold: float, q: int) -> float:
    """Grams per character that a text may lose against any partner at or above ``threshold``.

    One deletion destroys at most q grams, one insertion at most q - 1. For a text of length n and a partner of
    length m the score leaves n - c deletions and m - c insertions with c >= t (n + m) / 2. That count is linear
    in m, so its maximum lies at the shortest or the longest partner the score admits.
    """
    t = threshold / 100.0
    per_own, per_other = q - (2 * q - 1) * t / 2, (q - 1) - (2 * q - 1) * t / 2
    return max(per_own + per_other * m for m in (t / (2 - t), (2 - t) / t))


def _grams(q: int) -> str:
    """Hashes of the distinct grams of a text. Two grams of one hash count as one, which can only bring texts together."""
    edge = f"repeat('{_EDGE}', {q - 1})"
    padded = f"concat({edge}, value, {edge})"
    return f"array_distinct(transform(sequence(1, length(value) + {q - 1}), i -> xxhash64(substring({padded}, i, {q}))))"


def _bucket(gram: str) -> str:
    return f"CAST(pmod({gram}, {_BUCKETS}L) AS INT)"


def _bucket_sizes(values: DataFrame, q: int) -> str:
    """How often each of 4,096 hash buckets of grams occurs, as one array literal: rare grams select best.

    The order of grams decides only how many candidates are looked at, never which pairs are found.
    """
    grams = values.selectExpr(f"explode({_grams(q)}) AS gram")
    rows = grams.groupBy(F.expr(_bucket("gram")).alias("bucket")).count().collect()
    sizes = [0] * _BUCKETS
    for row in rows:
        sizes[row["bucket"]] = row["count"]
    return f"CAST(split('{','.join(map(str, sizes))}', ',') AS ARRAY<BIGINT>)"


def _bands(threshold: float) -> tuple[str, str]:
    """The band of lengths that a left value lies in, and those that hold the partners of a right value.

    Texts at or above a threshold t differ in length by (2 - t) / t at most. A band is three such steps wide, so most right
    values have one or two.
    """
    t = threshold / 100.0
    step = math.log((2 - t) / t) * (1 + 1e-9) + 1e-9
    own = "ln(greatest(length(value), 1))"
    ends = (f"CAST(floor(({own} {sign} {step!r}D) / {3 * step!r}D) AS INT)" for sign in "-+")
    return f"CAST(floor({own} / {3 * step!r}D) AS INT)", f"explode(sequence({', '.join(ends)}))"


def _with_signature(values: DataFrame, threshold: float, q: int, sizes: str, band: str, side: str) -> DataFrame:
    """One row per signature gram: the rarest grams, one more than a partner can lack; ``bits`` sketches all grams.

    A row knows its gram's place in the signature and the grams before it. The order is the same for all texts.
    """
    keep = f"CAST(floor(length(value) * {lost_gram_share(threshold, q)!r}D + 1e-9D) AS INT) + 1"
    ranked = f"transform(grams, g -> struct(get({sizes}, {_bucket('g')}) AS n, g AS gram))"
    signature = f"transform(slice(array_sort({ranked}), 1, {keep}), s -> s.gram)"
    bits = "aggregate(grams, 0L, (b, g) -> b | shiftleft(1L, CAST(pmod(g, 64L) AS INT)))"
    block = [c for c in values.columns if c != "value"]
    signed = values.withColumn("grams", F.expr(_grams(q))).selectExpr(
        *(f"`{c}`" for c in block), f"value AS {side}_value", f"{bits} AS {side}_bits", f"{signature} AS signature", f"{band} AS band"
    )
    placed = signed.select("*", F.posexplode("signature").alias(f"{side}_at", "gram"))
    return placed.withColumn(f"{side}_before", F.expr(f"slice(signature, 1, {side}_at)")).drop("signature")


def _common(n: str, m: str, threshold: float) -> str:
    """The least number of characters that texts of these lengths have in common at the threshold."""
    return f"CAST(ceil(({n} + {m}) * {threshold / 200.0!r}D - 1e-9D) AS INT)"


def _first_meeting(threshold: float, q: int) -> str:
    """Whether a pair that meets at a gram meets there first, and not too late to reach the threshold.

    The first gram that two texts share in the common order is in both signatures. What stands before it in one text's
    order the other text lacks, and a text of n characters can lack only so many grams of a partner of m.
    """
    n, m = "length(left_value)", "length(right_value)"
    common = _common(n, m, threshold)
    places = [
        f"{side}_at <= {q} * ({own} - {common}) + {q - 1} * ({other} - {common})"
        for side, own, other in (("left", n, m), ("right", m, n))
    ]
    return " AND ".join([*places, "NOT arrays_overlap(left_before, right_before)"])


def _may_share(a: str, b: str, threshold: float, q: int) -> str:
    """Lossless SQL test on the sketches: neither text may lack more of the other's grams than its edits destroy."""
    n, m = f"length({a}_value)", f"length({b}_value)"
    common = _common(n, m, threshold)
    tests = []
    for x, y, len_x, len_y in ((a, b, n, m), (b, a, m, n)):
        lost = f"{q} * ({len_x} - {common}) + {q - 1} * ({len_y} - {common})"
        tests.append(f"bit_count({x}_bits & ~{y}_bits) <= {lost}")
    return " AND ".join(tests)


def _in_tiles(left: DataFrame, right: DataFrame, threshold: float, block: list[str]) -> DataFrame:
    """All distinct values at or above a low threshold, for which no signature is lossless: compared in bounded tiles.

    Only pairs that reach the threshold leave a tile.
    """
    keys = [*block, "_one"]
    known = F.col("value").isNotNull()
    a, b = (df.where(known).select(*block, "value", F.lit(1).alias("_one")).distinct() for df in (left, right))
    kinds = {f.name: f.dataType.simpleString() for f in a.schema}

    def compare(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        found = []
        other = y["value"].to_numpy(object)
        for start in range(0, len(x), _STEP):
            own = x["value"].to_numpy(object)[start : start + _STEP]
            scores = indel_scores(np.repeat(own, len(other)), np.tile(other, len(own))).reshape(len(own), -1)
            i, j = np.nonzero(scores >= threshold)
            part = pd.DataFrame({"left_value": own[i], "right_value": other[j], "score": scores[i, j]})
            found.append(part.assign(**{k: x[k].iloc[0] for k in block}))
        return pd.concat(found)[[*block, "left_value", "right_value", "score"]]

    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in block), "left_value string, right_value string, score double"])
    return compare_tiles(a, b, keys, "value", "value", compare, schema, _TILE_ROWS)


def meetings(left: DataFrame, right: DataFrame, threshold: float, block: list[str]) -> DataFrame:
    """Pairs of distinct values that may reach ``threshold``, each once: where their signatures first meet."""
    q = gram_size(threshold)
    columns = [*block, "value"]
    known = F.col("value").isNotNull()
    a, b = left.select(columns).where(known), right.select(columns).where(known)
    sizes = _bucket_sizes(a.select("value").union(b.select("value")), q)
    own, partners = _bands(threshold)
    a = _with_signature(a.distinct(), threshold, q, sizes, own, "left")
    b = _with_signature(b.distinct(), threshold, q, sizes, partners, "right")
    return a.join(b, [*block, "gram", "band"]).where(_first_meeting(threshold, q))


def similar_values(left: DataFrame, right: DataFrame, threshold: float, block: list[str] | None = None) -> DataFrame:
    """``(*block, left_value, right_value, score)`` for all distinct values at or above ``threshold``.

    Both inputs have the block columns and ``value``. Values meet on (block, signature gram, band of lengths), so the
    shuffle key is far finer than the block. A pair is looked at once, at the first gram that both signatures share, and
    dropped there if that place is too late, if gram sketches, lengths or a bounded Levenshtein distance rule it out; what
    is left reaches the exact score.
    """
    block = block or []
    if threshold < LEAST_SIGNED:
        return _in_tiles(left, right, threshold, block)
    near = f"{_may_share('left', 'right', threshold, gram_size(threshold))} AND {may_reach('left_value', 'right_value', threshold)}"
    pairs = meetings(left, right, threshold, block).where(near).select(*block, "left_value", "right_value")
    return pairs.withColumn("score", indel_ratio_once(F.col("left_value"), F.col("right_value"))).where(
        F.col("score") >= threshold
    )
