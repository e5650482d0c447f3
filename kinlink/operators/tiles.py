"""Compare the rows of two tables inside blocks of any size, in tiles that fit one task.

A block larger than a tile is cut on both sides and each piece meets each piece of the other side. Only what the
comparison keeps leaves a tile: never its pairs.
"""

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.operators.ordering import by_shuffle


def _tile_counts(df: DataFrame, block: list[str], cell: list[str], side: str, rows: int) -> DataFrame:
    sizes = df.groupBy(*block, *cell).agg(F.ceil(F.count("*") / rows).cast("int").alias(f"_{side}t"))
    return sizes.withColumnsRenamed({c: f"{side}_{c}" for c in cell})


def _cut(df: DataFrame, sizes: DataFrame, block: list[str], cell: list[str], key: str, side: str, other: str) -> DataFrame:
    """Each row once for every tile of the other side that its own tile meets."""
    own, theirs = f"_{side}t", f"_{other}t"
    spread = df.withColumnsRenamed({c: f"{side}_{c}" for c in cell}).join(sizes, [*block, *(f"{side}_{c}" for c in cell)])
    mine = F.pmod(F.xxhash64(key), F.col(own)).cast("int")
    spread = spread.withColumn(own, mine).withColumn(theirs, F.explode(F.sequence(F.lit(0), F.col(theirs) - 1)))
    cells = [f"{s}_{c}" for s in "lr" for c in cell]
    return spread.select([F.col(c).alias(c) for c in [*(c for c in df.columns if c not in cell), *cells, "_lt", "_rt"]])


def compare_tiles(
    left: DataFrame,
    right: DataFrame,
    block: list[str],
    left_key: str,
    right_key: str,
    compare: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
    rows: int = 2048,
    cell: Sequence[str] = (),
    meet: str | None = None,
    known: tuple[DataFrame, dict[str, list[str]]] | None = None,
) -> DataFrame:
    """Apply ``compare`` to every pair of tiles; keys must be unique within a block so that tiles stay even.

    ``cell`` are columns of both sides that part a block further; only cells for which the SQL condition ``meet`` holds, on
    the columns ``l_<cell>`` and ``r_<cell>``, are compared.

    ``known`` is a table ``(text, vector)`` and the columns of texts of ``left`` and ``right``: each tile also gets the vectors
    of its distinct texts, once, as the third argument of ``compare``.
    """
    cell = list(cell)
    sizes = _tile_counts(left, block, cell, "l", rows).join(_tile_counts(right, block, cell, "r", rows), block)
    sizes = sizes.where(meet) if meet else sizes
    a = _cut(left, sizes, block, cell, left_key, "l", "r")
    b = _cut(right, sizes, block, cell, right_key, "r", "l")
    names = [f.split()[0].strip("`") for f in schema.split(",")]

    def run(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if x.empty or y.empty:
            return pd.DataFrame({n: [] for n in names}, dtype=object)
        return compare(x, y)

    keys = [*block, *(f"{s}_{c}" for s in "lr" for c in cell), "_lt", "_rt"]
    if known is None:
        return a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInPandas(run, schema)
    vectors, texts = known
    columns = {"left": [c for c in a.columns if c not in keys], "right": [c for c in b.columns if c not in keys]}
    rows = [df.withColumnsRenamed({c: f"{side}__{c}" for c in columns[side]}) for side, df in (("left", a), ("right", b))]
    both = rows[0].withColumn("_own", F.lit(True)).unionByName(rows[1].withColumn("_own", F.lit(False)), allowMissingColumns=True)
    named = F.explode(F.array_compact(F.array(*(F.col(f"{side}__{c}") for side in texts for c in texts[side])))).alias("text")
    wanted = both.select(*(F.col(k).alias(k) for k in keys), named).distinct().join(by_shuffle(vectors), "text")

    def sides(mixed: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        tell = mixed["_own"].to_numpy(bool)
        parts = []
        for side, here in (("left", tell), ("right", ~tell)):
            part = mixed.loc[here, [*keys, *(f"{side}__{c}" for c in columns[side])]]
            parts.append(part.rename(columns={f"{side}__{c}": c for c in columns[side]}).reset_index(drop=True))
        if any(part.empty for part in parts):
            return pd.DataFrame({n: [] for n in names}, dtype=object)
        return compare(*parts, vectors)

    return both.groupBy(*keys).cogroup(wanted.groupBy(*keys)).applyInPandas(sides, schema)
