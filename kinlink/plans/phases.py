"""The match phases: blocks, rules and what each phase leaves for the next."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlink.operators.blocking import with_known_block
from kinlink.operators.matching import fuzzy_match, remaining, vector_match
from kinlink.plans.settings import Phase, Settings

FILLER = "Missing"


def phase_inputs(
    left: DataFrame, right: DataFrame, phase: Phase, settings: Settings, left_id: str, right_id: str
) -> tuple[DataFrame, DataFrame]:
    """Narrow tables for matching: row id, block and texts."""

    def text(column: str) -> Column:
        c = F.col(column)
        return F.coalesce(c, F.lit(FILLER)) if phase.vectors and settings.fill_missing else c

    def narrow(df: DataFrame, row_id: str, name: str, *more: Column) -> DataFrame:
        return with_known_block(df, phase.key, phase.other).select(
            F.col(row_id).alias(name),
            F.col(phase.key).alias("block"),
            text("Street_UPDATED").alias("street"),
            text("BusinessName_UPDATED").alias("name"),
            *more,
        )

    parent = F.col("GlobalName_UPDATED").alias("parent")
    return narrow(left, left_id, "left_id"), narrow(right, right_id, "right_id", parent)


def run_phase(
    left: DataFrame,
    right: DataFrame,
    phase: Phase,
    settings: Settings = Settings(),
    left_id: str = "record_id",
    right_id: str = "record_id",
) -> DataFrame:
    """Matches of one phase. Ids are unique BIGINTs; left rows choose in the order of theirs."""
    a, b = phase_inputs(left, right, phase, settings, left_id, right_id)
    rules = list(phase.rules)
    found = vector_match(a, b, rules, settings.make_encoder) if phase.vectors else fuzzy_match(a, b, rules)
    return found.withColumn("phase", F.lit(phase.number))


def run_phases(
    left: DataFrame,
    right: DataFrame,
    settings: Settings = Settings(),
    left_id: str = "record_id",
    right_id: str = "record_id",
) -> DataFrame:
    """Matches of all phases, each on the rows the earlier ones left over."""
    found = []
    for phase in settings.phases:
        matches = run_phase(left, right, phase, settings, left_id, right_id)
        found.append(matches)
        left = remaining(left, matches, left_id, "left_id")
        right = remaining(right, matches, right_id, "right_id")
    return reduce(DataFrame.unionByName, found)
