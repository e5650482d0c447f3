"""Counts about a run: per block, per phase, and match rates."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinlink.operators.blocking import block_counts, with_known_block


def match_rate(before: Column, after: Column) -> Column:
    return F.when(before > 0, after / before * 100).otherwise(F.lit(0.0))


def method_column(method: str) -> str:
    return method.replace(" ", "") + "_Matched_Records"


def block_stats(
    left: DataFrame, right: DataFrame, matches: DataFrame, key: str, other: str, methods: list[str], name: str
) -> DataFrame:
    """Totals and matches per block that has rows on both sides.

    A method that no longer had rows on both sides when its turn came did not run and is null.
    """
    totals = block_counts(with_known_block(left, key, other), with_known_block(right, key, other), key)
    per_method = matches.groupBy(F.col("block").alias(key)).pivot("method", methods).agg(F.count("left_id"))
    joined = totals.join(per_method, key, "left").fillna(0, methods)
    columns, done, ran = [], F.lit(0), F.lit(True)
    for method in methods:
        ran = ran & (F.col("count_left") > done) & (F.col("count_right") > done)
        columns.append(F.when(ran, F.col(method)).alias(method_column(method)))
        done = done + F.col(method)
    return joined.select(
        F.col(key).alias(name),
        F.col("count_left").alias("Total_PCRB_Records"),
        F.col("count_right").alias("Total_DNB_Records"),
        done.alias("Total_Matched_Records"),
        *columns,
        match_rate(F.col("count_left"), done).alias("Match_Percentage"),
    )


def phase_counts(left: DataFrame, matches: DataFrame, phases: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """One row per phase, those of ``phases`` and any other in ``matches``: rows before it, matched in it, unmatched after it."""
    total = left.agg(F.count("*").alias("total"))
    found = matches.groupBy("phase").agg(F.count("*").alias("matched"))
    listed = left.sparkSession.createDataFrame([(p,) for p in phases], "phase int")
    every = listed.unionByName(found.select(F.col("phase").cast("int"))).distinct().join(found, "phase", "left")
    earlier = Window.orderBy("phase").rowsBetween(Window.unboundedPreceding, -1)  # a row for each phase
    rows = every.select(
        "phase",
        F.coalesce(F.sum("matched").over(earlier), F.lit(0)).alias("earlier"),
        F.coalesce("matched", F.lit(0)).alias("matched"),
    ).join(F.broadcast(total))
    before = F.col("total") - F.col("earlier")
    return rows.select(
        "phase",
        before.alias("rows_before"),
        "matched",
        (before - F.col("matched")).alias("unmatched"),
    )
