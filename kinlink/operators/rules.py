"""Threshold rules of the match cascade."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A pair passes when the street reaches its threshold and the name, or else the parent name, its own."""

    method: str
    street: float
    name: float
    parent: float


# The published rule table (street, name, parent name).
M1 = Rule("Method 1", 95, 80, 80)
M2 = Rule("Method 2", 80, 95, 90)
M3 = Rule("Method 3", 0.90, 0.80, 0.90)
M4 = Rule("Method 4", 0.60, 0.80, 0.80)
M5 = Rule("Method 5", 0.98, 0.50, 0.80)
STRING_DEFAULT = Rule("Method 1", 90, 90, 90)
VECTOR_DEFAULT = Rule("Method 3", 0.90, 0.90, 0.90)


def passing(scored: DataFrame, rule: Rule) -> DataFrame:
    """Class pairs that pass ``rule``. The parent's score counts only where the own name misses, and replaces it."""
    own = F.col("name_score") >= rule.name
    through_parent = F.col("parent").isNotNull() & (F.col("parent_score") >= rule.parent)
    return scored.where((F.col("street_score") >= rule.street) & (own | through_parent)).select(
        "block",
        "left_class",
        "right_class",
        "street_score",
        F.when(own, F.col("name_score")).otherwise(F.col("parent_score")).alias("name_score"),
        (~own).alias("used_global"),
    )
