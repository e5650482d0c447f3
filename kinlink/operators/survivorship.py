"""Which rows of a group survive. Groups are reduced by aggregates, so a huge group costs no more than its rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.operators.ordering import by_shuffle

PREFERRED_CODE = 2
_LAST = 2**62


def keep_best_codes(
    df: DataFrame,
    group: str = "PrimaryFEIN",
    code: str = "AddressTypeCode",
    order: str = "record_id",
    missing_ids: str = "group",
    keep_uncoded: bool = False,
) -> DataFrame:
    """Per group all rows with code 2, or else the first row with the smallest code.

    A group that has only null codes yields nothing unless ``keep_uncoded``. Rows without a tax id, or with one that
    could not be read (null), all share id 0 and are one group; ``missing_ids='pass'`` keeps all of them. ``order``
    must be unique.
    """
    identity = F.coalesce(F.col(group), F.lit(0))
    known, passed = df, None
    if missing_ids == "pass":
        known, passed = df.where(identity != 0), df.where(identity == 0)
    preferred = known.where(F.col(code) == PREFERRED_CODE)
    rank = F.coalesce(F.col(code), F.lit(_LAST)) if keep_uncoded else F.col(code)
    best = F.min(F.when(rank.isNotNull(), F.struct(rank.alias("rank"), F.col(order).alias("row"))))
    has_preferred = F.coalesce(F.max(F.col(code) == PREFERRED_CODE), F.lit(False))
    chosen = known.groupBy(identity).agg(best.alias("best"), has_preferred.alias("skip"))
    ids = chosen.where(~F.col("skip") & F.col("best").isNotNull()).select(F.col("best.row").alias(order))
    others = known.where(F.col(code).isNull() | (F.col(code) != PREFERRED_CODE)).join(by_shuffle(ids), order, "left_semi")
    out = preferred.unionByName(others.select(df.columns))
    return out.unionByName(passed) if passed is not None else out


def keep_first(df: DataFrame, keys: list[str], order: str = "record_id") -> DataFrame:
    """First row per key in the given order; ``order`` must be unique."""
    first = df.groupBy(*keys).agg(F.min(order).alias(order)).select(order)
    return df.join(by_shuffle(first), order, "left_semi").select(df.columns)
