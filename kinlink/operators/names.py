"""Name sets matched by sound."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.functions.similarity import soundex
from kinlink.functions.text import preprocess
from kinlink.operators.best import best_in_block


def sound_groups(names: DataFrame) -> DataFrame:
    """``(code, value)`` of distinct names."""
    return names.select(soundex(F.col("value")).alias("code"), "value").distinct()


def name_maps(left: DataFrame, right: DataFrame, counters: Mapping | None = None) -> DataFrame:
    """``(left_name, right_name, score, tier)`` for one-column tables of names.

    Names on both sides are left out. Each left name takes the best word-set ratio among right names with its
    sound code; a right name goes to the alphabetically first left name that chose it, even if that score is below
    every tier. Tiers: high from 90, med from 80, low from 75. ``counters`` are those of ``best_in_block``.
    """
    a = left.select(F.col(left.columns[0]).alias("raw")).distinct()
    b = right.select(F.col(right.columns[0]).alias("raw")).distinct()
    own = a.join(b, "raw", "left_anti").select(preprocess(F.col("raw")).alias("value")).distinct()
    other = b.join(a, "raw", "left_anti").select(preprocess(F.col("raw")).alias("value")).distinct()
    options = sound_groups(other.where(F.col("value") != ""))
    best = best_in_block(sound_groups(own), options, "code", "token_set", counters=counters)
    claimed = best.groupBy("right_value").agg(F.min(F.struct("left_value", "score")).alias("claim"))
    score = F.col("claim.score")
    tier = F.when(score >= 90, "high").when(score >= 80, "med").when(score >= 75, "low")
    return claimed.select(
        F.col("claim.left_value").alias("left_name"),
        F.col("right_value").alias("right_name"),
        score.alias("score"),
        tier.alias("tier"),
    ).where(F.col("tier").isNotNull())
