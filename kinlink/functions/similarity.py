"""String and vector similarity. Scores of strings run from 0 to 100."""

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinlink.functions.edits import indel_scores
from kinlink.functions.wordsets import token_set_scores


@F.pandas_udf(T.DoubleType())
def _indel_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(indel_scores(a.to_numpy(object), b.to_numpy(object)))


@F.pandas_udf(T.DoubleType())
def _token_set_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(token_set_scores(a.fillna("").to_numpy(object), b.fillna("").to_numpy(object)))


def indel_ratio(a: Column, b: Column) -> Column:
    return _indel_udf(a, b)


def indel_ratio_once(a: Column, b: Column) -> Column:
    """The same score for a column that is filtered next.

    Marked so that the optimizer does not copy the filter below an aggregate and compute the score twice.
    """
    return F.pandas_udf(_indel_udf.func, T.DoubleType()).asNondeterministic()(a, b)


def sorted_tokens(c: Column) -> Column:
    words = F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def token_sort_ratio(a: Column, b: Column) -> Column:
    return _indel_udf(sorted_tokens(a), sorted_tokens(b))


def token_set_ratio(a: Column, b: Column) -> Column:
    return _token_set_udf(a, b)


def indel_ratio_native(a: Column, b: Column) -> Column:
    """The same score from built-in functions only, for small inputs and as a second opinion."""
    letters = F.filter(F.split(b, ""), lambda ch: ch != "")

    def advance(row: Column, ch: Column) -> Column:
        def cell(done: Column, j: Column) -> Column:
            same = F.when(F.substring(a, j, 1) == ch, 1).otherwise(0)
            best = F.greatest(F.element_at(done, -1), F.element_at(row, j + 1), F.element_at(row, j) + same)
            return F.array_append(done, best)

        places = F.filter(F.sequence(F.lit(0), F.length(a)), lambda j: j > 0)
        return F.aggregate(places, F.array(F.lit(0)), cell)

    start = F.array_repeat(F.lit(0), F.length(a) + 1)
    lcs = F.element_at(F.aggregate(letters, start, advance), -1)
    total = F.length(a) + F.length(b)
    distance = (total - 2 * lcs).cast("double")
    score = F.when(total == 0, 100.0).otherwise(100.0 * (1.0 - distance / F.greatest(total, F.lit(1))))
    return F.coalesce(score, F.lit(0.0))


def may_reach(a: str, b: str, threshold: float) -> str:
    """Lossless SQL test of two columns in generated code: false or null only for pairs below ``threshold``.

    A pair may need at most ``limit`` insertions and deletions. That number is at least the length difference and
    at least the Levenshtein distance.
    """
    limit = f"CAST(floor({1.0 - threshold / 100.0!r}D * (length({a}) + length({b})) + 1e-9D) AS INT)"
    return f"(abs(length({a}) - length({b})) <= {limit} AND levenshtein({a}, {b}, {limit}) >= 0)"


def soundex(c: Column) -> Column:
    """Four-character code; a first character outside A-Z is kept and the rest is coded after it."""
    c = F.upper(c)
    other = F.concat(F.substring(c, 1, 1), F.substring(F.soundex(F.concat(F.lit("A"), F.substring(c, 2, 2**30))), 2, 3))
    return F.when((c == "") | c.rlike("^[A-Z]"), F.soundex(c)).otherwise(other)


def cosine(a: Column, b: Column) -> Column:
    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda s, v: s + v)

    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, dot(a, b) / F.nullif(size, F.lit(0.0))).otherwise(F.when(size.isNotNull(), 0.0))
