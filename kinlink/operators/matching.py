"""Blocked fuzzy and vector joins and the cascade of rules over them.

Input tables have ``left_id``/``right_id`` (unique BIGINT), ``block``, ``street``, ``name`` and, on the right,
``parent``. Rows with equal block and texts form one class; all scoring is done once per pair of classes.
"""

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinlink.functions.encode import encode_distinct
from kinlink.functions.edits import indel_scores
from kinlink.functions.similarity import may_reach
from kinlink.operators.assign import assign
from kinlink.operators.ordering import by_shuffle
from kinlink.operators.rules import Rule, passing
from kinlink.operators.similar import similar_values
from kinlink.operators.vectors import vector_pairs
from kinlink.storage import materialize, materialize_all

PAIRS_PER_VALUE_PAIR = 100_000

_TEXTS = ["left_street", "left_name", "street", "name", "parent"]
Candidates = Callable[[DataFrame, DataFrame, list[Rule]], DataFrame]


def left_classes(left: DataFrame) -> DataFrame:
    usable = left.where(F.col("block").isNotNull() & F.col("street").isNotNull() & F.col("name").isNotNull())
    return usable.groupBy("block", F.col("street").alias("left_street"), F.col("name").alias("left_name")).agg(
        F.min("left_id").alias("left_class")
    )


def right_classes(right: DataFrame) -> DataFrame:
    named = F.col("name").isNotNull() | F.col("parent").isNotNull()
    usable = right.where(F.col("block").isNotNull() & F.col("street").isNotNull() & named)
    return usable.groupBy("block", "street", "name", "parent").agg(F.min("right_id").alias("right_class"))


def _members(rows: DataFrame, classes: DataFrame, row_id: str, class_id: str, texts: dict[str, str]) -> DataFrame:
    keys = classes.select(class_id, F.col("block").alias("_block"), *[F.col(c).alias(f"_{c}") for c in texts.values()])
    same = F.col("block") == F.col("_block")
    for own, other in texts.items():
        same = same & F.col(own).eqNullSafe(F.col(f"_{other}"))
    return rows.join(by_shuffle(keys), same).select(class_id, row_id)


def left_members(left: DataFrame, classes: DataFrame) -> DataFrame:
    return _members(left, classes, "left_id", "left_class", {"street": "left_street", "name": "left_name"})


def right_members(right: DataFrame, classes: DataFrame) -> DataFrame:
    return _members(right, classes, "right_id", "right_class", {c: c for c in ("street", "name", "parent")})


def _as_values(classes: DataFrame, keys: list[str], column: str) -> DataFrame:
    return classes.select(*keys, F.col(column).alias("value"))


def _value_pairs(lefts: DataFrame, rights: DataFrame, threshold: float, keys: list[str], limit: int) -> DataFrame:
    """Similar values of both sides and whether they stand for more than ``limit`` class pairs.

    Inputs: classes with ``left_value`` and ``right_value``, one row per class and text.
    """
    a, b = _as_values(lefts, keys, "left_value"), _as_values(rights, keys, "right_value")
    left_n = lefts.groupBy(*keys, "left_value").agg(F.count("*").alias("left_n"))
    right_n = rights.groupBy(*keys, "right_value").agg(F.count("*").alias("right_n"))
    alike = similar_values(a, b, threshold, keys)
    weighed = alike.join(by_shuffle(left_n), [*keys, "left_value"]).join(by_shuffle(right_n), [*keys, "right_value"])
    heavy = F.col("left_n").cast("double") * F.col("right_n") > limit
    return weighed.select(*keys, "left_value", "right_value", heavy.alias("heavy"))


def _meet(pairs: DataFrame, lefts: DataFrame, rights: DataFrame, keys: list[str]) -> DataFrame:
    met = pairs.join(lefts, [*keys, "left_value"]).join(rights, [*keys, "right_value"])
    return met.select("block", "left_class", "right_class", *_TEXTS)


def _with_texts(classes: DataFrame, columns: list[str], name: str) -> DataFrame:
    """One row per class and text of ``columns``; a class whose texts are equal appears once."""
    if len(columns) == 1:
        return classes.withColumn(name, F.col(columns[0])).where(F.col(name).isNotNull())
    texts = F.array_compact(F.array_distinct(F.array(*columns)))
    return classes.withColumn(name, F.explode(texts))


def _class_pairs(
    weighed: DataFrame, lefts: DataFrame, rights: DataFrame, others: tuple[list[str], list[str]], least: float
) -> DataFrame:
    """Class pairs under similar values. Where a value pair stands for very many of them (a filler street, a mall),
    the classes under it meet only through their other texts, which must reach ``least``.
    """
    light = _meet(weighed.where(~F.col("heavy")), lefts, rights, ["block"])
    heavy = weighed.where("heavy").select(
        "block", F.col("left_value").alias("first_left"), F.col("right_value").alias("first_right")
    )
    if heavy.isEmpty():
        return light
    finer = ["block", "first_left", "first_right"]
    few_left = lefts.withColumnRenamed("left_value", "first_left").join(heavy, ["block", "first_left"])
    few_right = rights.withColumnRenamed("right_value", "first_right").join(heavy, ["block", "first_right"])
    few_left, few_right = _with_texts(few_left, others[0], "left_value"), _with_texts(few_right, others[1], "right_value")
    inner = similar_values(
        _as_values(few_left, finer, "left_value"), _as_values(few_right, finer, "right_value"), least, finer
    )
    return light.unionByName(_meet(inner, few_left, few_right, finer))


_SCORES = T.StructType([T.StructField(f"{c}_score", T.DoubleType()) for c in ("street", "name", "parent")])


@F.pandas_udf(_SCORES)
def _score_udf(
    left_street: pd.Series, left_name: pd.Series, street: pd.Series, name: pd.Series, parent: pd.Series
) -> pd.DataFrame:
    left_name = left_name.to_numpy(object)
    return pd.DataFrame(
        {
            "street_score": indel_scores(left_street.to_numpy(object), street.to_numpy(object)),
            "name_score": indel_scores(left_name, name.to_numpy(object)),
            "parent_score": indel_scores(left_name, parent.to_numpy(object)),
        }
    )


def _any_rule_may_pass(rules: list[Rule]) -> str:
    def test(r: Rule) -> str:
        own = may_reach("left_name", "name", r.name)
        other = may_reach("left_name", "parent", r.parent)
        return f"({may_reach('left_street', 'street', r.street)} AND (coalesce({own}, false) OR coalesce({other}, false)))"

    return " OR ".join(map(test, rules))


def fuzzy_candidates(
    lefts: DataFrame, rights: DataFrame, rules: list[Rule], limit: int = PAIRS_PER_VALUE_PAIR
) -> DataFrame:
    """Scored class pairs that can pass some rule, found through the text on which the rule is strictest."""
    both = lefts.select("block").distinct().join(rights.select("block").distinct(), "block")
    lefts, rights = (df.join(both, "block", "left_semi") for df in (lefts, rights))
    street, names = (["left_street"], ["street"]), (["left_name"], ["name", "parent"])
    strict_street = [r for r in rules if r.street >= max(r.name, r.parent)]
    strict_name = [r for r in rules if r not in strict_street]
    ways = []
    if strict_street:
        first = min(r.street for r in strict_street)
        ways.append((street, first, names, min(min(r.name, r.parent) for r in strict_street)))
    if strict_name:
        first = min(min(r.name, r.parent) for r in strict_name)
        ways.append((names, first, street, min(r.street for r in strict_name)))
    sides = [
        (_with_texts(lefts, texts[0], "left_value"), _with_texts(rights, texts[1], "right_value"))
        for texts, _, _, _ in ways
    ]
    weighed = materialize_all(
        *[
            (_value_pairs(a, b, first, ["block"], limit), "value-pairs")
            for (a, b), (_, first, _, _) in zip(sides, ways)
        ]
    )
    found = [
        _class_pairs(pairs, a, b, others, least)
        for pairs, (a, b), (_, _, others, least) in zip(weighed, sides, ways)
    ]
    pairs = reduce(DataFrame.unionByName, found).where(_any_rule_may_pass(rules))
    pairs = pairs.dropDuplicates(["left_class", "right_class"])
    scored = pairs.withColumn("scores", _score_udf(*[F.col(c) for c in _TEXTS]))
    return scored.select("block", "left_class", "right_class", "parent", "scores.*")


def text_vectors(texts: list[tuple[DataFrame, str]], make_encoder=None) -> DataFrame:
    """``(text, vector)`` of all distinct texts in the given columns, stored."""
    every = reduce(DataFrame.union, [df.select(F.col(c).alias("text")) for df, c in texts])
    return materialize(encode_distinct(every, "text", make_encoder), "vectors")


def vector_candidates(
    lefts: DataFrame, rights: DataFrame, rules: list[Rule], make_encoder=None, counters: dict | None = None
) -> DataFrame:
    """Scored class pairs that pass some rule on cosine similarity of their text vectors.

    Vectors are computed once per distinct text; ``vector_pairs`` compares them, streets first.
    """
    # a block on one side only has no pairs, so its texts need no vectors
    both = lefts.select("block").distinct().join(rights.select("block").distinct(), "block")
    lefts, rights = (df.join(both, "block", "left_semi") for df in (lefts, rights))
    texts = [(lefts, c) for c in ("left_street", "left_name")] + [(rights, c) for c in ("street", "name", "parent")]
    vectors = text_vectors(texts, make_encoder)
    a = lefts.select("block", "left_class", F.col("left_street").alias("ts"), F.col("left_name").alias("tn"))
    b = rights.select("block", "right_class", "parent", F.col("street").alias("ts"), F.col("name").alias("tn"), F.col("parent").alias("tp"))
    a, b = (attach_vectors(df, vectors, {"ts": "vs"}) for df in (a, b))
    return vector_pairs(a, b, rules, counters=counters, vectors=vectors)


def attach_vectors(df: DataFrame, vectors: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds the vector of each text column; null where the text is."""
    for text, name in columns.items():
        one = vectors.select(F.col("text").alias("_text"), F.col("vector").alias(name))
        df = df.join(by_shuffle(one), F.col(text) == F.col("_text"), "left").drop("_text")
    return df


def _open_classes(classes: DataFrame, used: DataFrame, free: DataFrame, class_id: str) -> DataFrame:
    """Classes without those in ``used`` of which no row is left in ``free``."""
    gone = used.select(class_id).join(by_shuffle(free.select(class_id).distinct()), class_id, "left_anti")
    return classes.join(by_shuffle(gone), class_id, "left_anti")


def cascade(left: DataFrame, right: DataFrame, rules: list[Rule], candidates: Candidates, apart: bool = False) -> DataFrame:
    """Matches of all rules in turn, each on the rows its predecessors left over; ``method`` names the rule.

    With ``apart`` each rule has candidates of its own, among the classes that still have rows when its turn comes.
    """
    lefts, rights = materialize_all((left_classes(left), "left-classes"), (right_classes(right), "right-classes"))
    found = []
    for step in [[r] for r in rules] if apart else [rules]:
        scored = materialize(candidates(lefts, rights, step), "scored")
        used_left = lefts.join(by_shuffle(scored.select("left_class").distinct()), "left_class", "left_semi")
        used_right = rights.join(by_shuffle(scored.select("right_class").distinct()), "right_class", "left_semi")
        left_rows, right_rows = left_members(left, used_left), right_members(right, used_right)
        for won in found:
            left_rows = left_rows.join(by_shuffle(won), "left_id", "left_anti")
            right_rows = right_rows.join(by_shuffle(won), "right_id", "left_anti")
        free_left, free_right = materialize_all((left_rows, "left-members"), (right_rows, "right-members"))
        for rule in step:
            won = assign(passing(scored, rule), free_left, free_right)
            won = materialize(won.withColumn("method", F.lit(rule.method)), "matches")
            found.append(won)
            if len(found) < len(rules):  # stored, as the next rule reads them several times
                free_left, free_right = materialize_all(
                    (free_left.join(by_shuffle(won), "left_id", "left_anti"), "left-members"),
                    (free_right.join(by_shuffle(won), "right_id", "left_anti"), "right-members"),
                )
        if len(found) < len(rules):
            lefts = _open_classes(lefts, used_left, free_left, "left_class")
            rights = _open_classes(rights, used_right, free_right, "right_class")
            lefts, rights = materialize_all((lefts, "left-classes"), (rights, "right-classes"))
    return reduce(DataFrame.unionByName, found)


def fuzzy_match(left: DataFrame, right: DataFrame, rules: list[Rule]) -> DataFrame:
    return cascade(left, right, rules, fuzzy_candidates, apart=True)


def vector_match(left: DataFrame, right: DataFrame, rules: list[Rule], make_encoder=None) -> DataFrame:
    return cascade(left, right, rules, lambda a, b, r: vector_candidates(a, b, r, make_encoder))


def remaining(df: DataFrame, matches: DataFrame, row_id: str, match_id: str) -> DataFrame:
    """Rows of a table that no match uses."""
    return df.join(by_shuffle(matches.select(F.col(match_id).alias(row_id))), row_id, "left_anti").select(df.columns)


def unmatched(df: DataFrame, matches: DataFrame, row_id: str, match_id: str) -> DataFrame:
    return remaining(df, matches, row_id, match_id).withColumn("matched", F.lit(False))


def match_output(
    matches: DataFrame, left: DataFrame, right: DataFrame, row_id: str = "record_id", prefixes=("pcrb_", "dnb_")
) -> DataFrame:
    """Both sides' rows next to each other, prefixed, with scores and method."""
    ours, theirs = (
        df.select([F.col(c).alias(prefix + c) for c in df.columns]) for df, prefix in zip((left, right), prefixes)
    )
    details = matches.select(
        F.col("left_id").alias(prefixes[0] + row_id),
        F.col("right_id").alias(prefixes[1] + row_id),
        F.col("name_score").alias("Similarity_Score"),
        F.col("used_global").alias("Used_Global"),
        F.col("street_score").alias("Street_Similarity"),
        F.col("name_score").alias("BusinessName_Similarity"),
        F.col("method").alias("matched_method"),
        F.lit(True).alias("matched"),
        *[c for c in matches.columns if c == "phase"],
    )
    joined = details.join(by_shuffle(ours), prefixes[0] + row_id).join(by_shuffle(theirs), prefixes[1] + row_id)
    return joined.select(*ours.columns, *theirs.columns, *[c for c in details.columns[2:]])


def with_match_vectors(output: DataFrame, make_encoder=None, prefixes=("pcrb_", "dnb_")) -> DataFrame:
    """Output rows of the vector phase with the vectors they were compared by."""
    left, right = prefixes
    columns = {
        f"{left}Street_UPDATED": f"{left}Embedding_Street",
        f"{left}BusinessName_UPDATED": f"{left}Embedding_BusinessName",
        f"{right}Street_UPDATED": f"{right}Embedding_Street",
        f"{right}BusinessName_UPDATED": f"{right}Embedding_BusinessName",
        f"{right}GlobalName_UPDATED": f"{right}Embedding_GlobalName",
    }
    return attach_vectors(output, text_vectors([(output, c) for c in columns], make_encoder), columns)
