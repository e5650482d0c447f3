"""The whole job: two raw tables in, matches, leftovers, statistics and metrics out."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.operators.blocking import add_match_keys
from kinlink.operators.matching import match_output, remaining, unmatched
from kinlink.operators.ordering import add_record_ids, by_shuffle, number_rows
from kinlink.operators.stats import block_stats, phase_counts
from kinlink.plans.cleaning import reference_cities, standardize_left, standardize_right, survivors
from kinlink.plans.phases import run_phase
from kinlink.plans.settings import Settings
from kinlink.plans.stages import StageDone, Stages, once
from kinlink.sources.digest import fingerprint

ORDER = "match_order"


@dataclass(frozen=True)
class Linkage:
    """``matches`` hold ids and scores, ``output`` both sides' full rows."""

    left: DataFrame
    right: DataFrame
    matches: DataFrame
    output: DataFrame
    unmatched_left: DataFrame
    unmatched_right: DataFrame
    stats: dict[int, DataFrame]
    metrics: DataFrame
    phases: DataFrame
    stages: tuple[StageDone, ...] = ()


def prepare(
    left: DataFrame, right: DataFrame, settings: Settings, left_order: list, right_order: list, stages: Stages | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cleaned tables with match keys, and the row counts of survivorship.

    Survivors take part in the order of tax id, then record id: the order in which grouping leaves them.
    """
    stages = stages or Stages(left.sparkSession)
    cleaning = settings.cleaning()
    numbered = once(lambda: add_record_ids(left, right, "record_id", left_order, right_order))
    cleaned = stages.run_all(
        ("right", lambda: standardize_right(numbered()[1], settings), cleaning),
        ("left", lambda: standardize_left(numbered()[0], reference_cities(numbered()[1]), settings), cleaning),
    )
    right, standardized = cleaned
    coded, kept = survivors(standardized, settings)
    kept = stages.run("survivors", lambda: number_rows(kept, ["PrimaryFEIN", "record_id"], ORDER), settings.survivorship())

    def count(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias(name))

    def metric(text: str, before: DataFrame, after: DataFrame) -> DataFrame:
        both = count(before, "rows_before").join(F.broadcast(count(after, "rows_after")))
        return both.select(F.lit(text).alias("description"), "rows_before", "rows_after")

    metrics = stages.run(
        "cleaning-metrics",
        lambda: metric("Apply Hierarchy Method", standardized, coded).unionByName(metric("Drop Duplicates", coded, kept)),
    )
    return *add_match_keys(kept, right), metrics


def link(
    left: DataFrame,
    right: DataFrame,
    left_order: list,
    right_order: list,
    settings: Settings = Settings(),
    store: str | None = None,
    version: str | None = None,
) -> Linkage:
    """Clean, block, match and report. ``*_order`` are columns that order each raw table uniquely.

    With ``store``, a folder that outlives the application, the cleaned tables, the survivors and the matches of each phase
    are kept there, and a run with the same inputs and settings goes on behind the last stage that was completed: after a
    lost driver, or with rules of a later phase changed. Tables that do not come from files need a ``version``.
    """
    stages = Stages(left.sparkSession, store, lambda: fingerprint(left, right, left_order, right_order, version=version))
    left, right, metrics = prepare(left, right, settings, left_order, right_order, stages)
    ids = left.select(F.col(ORDER).alias("left_id"), F.col("record_id").alias("_record"))
    now_left, now_right, placed = left, right, []
    for phase in settings.phases:
        found = stages.run(
            f"phase-{phase.number}",
            lambda: run_phase(now_left, now_right, phase, settings, ORDER),
            [phase, settings.matching()],
        )
        placed.append(found)
        now_left = remaining(now_left, found, ORDER, "left_id")
        now_right = remaining(now_right, found, "record_id", "right_id")
    placed = reduce(DataFrame.unionByName, placed)
    matches = placed.join(by_shuffle(ids), "left_id").withColumn("left_id", F.col("_record")).drop("_record")
    matches = stages.run("matches", lambda: matches)

    stats, now_left, now_right = {}, left, right
    for phase in settings.phases:
        found = matches.where(F.col("phase") == phase.number)
        name = "Zipcode" if phase.key.startswith("Zip") else "City"
        methods = [r.method for r in phase.rules]
        stats[phase.number] = block_stats(now_left, now_right, found, phase.key, phase.other, methods, name)
        now_left = remaining(now_left, found, "record_id", "left_id")
        now_right = remaining(now_right, found, "record_id", "right_id")

    totals = left.agg(F.count("*").alias("rows_before")).join(
        F.broadcast(matches.agg(F.count("*").alias("rows_after")))
    )
    rolled = [
        totals.select(F.lit("Number of matched rows").alias("description"), "rows_before", "rows_after"),
        totals.select(
            F.lit("Number of unmatched rows").alias("description"),
            "rows_before",
            (F.col("rows_before") - F.col("rows_after")).alias("rows_after"),
        ),
    ]
    return Linkage(
        left=left,
        right=right,
        matches=matches,
        output=match_output(matches, left.drop(ORDER), right),
        unmatched_left=unmatched(left.drop(ORDER), matches, "record_id", "left_id"),
        unmatched_right=unmatched(right, matches, "record_id", "right_id"),
        stats=stats,
        metrics=reduce(DataFrame.unionByName, [metrics, *rolled]),
        phases=phase_counts(left, matches, [p.number for p in settings.phases]),
        stages=tuple(stages.done),
    )
