"""Row numbers and running totals over a whole table without a single-task sort."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinlink.storage import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition number above this many bits


def by_shuffle(side: DataFrame) -> DataFrame:
    """A side of a join that grows with the input: its rows are shuffled and never collected for a broadcast."""
    return side.hint("merge")


def ranged(df: DataFrame, order_by: list[Column | str], label: str) -> DataFrame:
    """``df`` globally sorted by ``order_by`` and written once, with its place as ``_part`` and ``_row``."""
    position = F.monotonically_increasing_id()
    placed = materialize(df.orderBy(*order_by).withColumn("_pos", position), label)
    part = F.shiftright("_pos", _ROW_BITS)
    return placed.withColumns({"_part": part, "_row": F.col("_pos") - F.shiftleft(part, _ROW_BITS)}).drop("_pos")


def _offsets(df: DataFrame, amount: Column) -> DataFrame:
    """What all earlier partitions add up to. One row per partition of a sort, so safe to broadcast."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy("_part").agg(amount.alias("_amount"))
    before = F.coalesce(F.sum("_amount").over(earlier), F.lit(0))
    return F.broadcast(totals.select("_part", before.alias("_before")))


def number_rows(df: DataFrame, order_by: list[Column | str], name: str) -> DataFrame:
    """Dense 1..n in the given order, which must be unique for the numbers to be repeatable."""
    placed = ranged(df, order_by, "numbered")
    with_offset = placed.join(_offsets(placed, F.count("*")), "_part")
    return with_offset.withColumn(name, F.col("_before") + F.col("_row") + 1).drop("_part", "_row", "_before")


def running_total(df: DataFrame, order_by: list[Column | str], value: str, name: str) -> DataFrame:
    """Adds the running sum of ``value`` and the row number ``_rank`` in the given order."""
    placed = ranged(df, order_by, "totals")
    within = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumn("_sum", F.sum(value).over(within))
    rows = _offsets(placed, F.count("*")).withColumnRenamed("_before", "_rows_before")
    out = summed.join(_offsets(placed, F.sum(value)), "_part").join(rows, "_part")
    out = out.withColumns({name: F.col("_before") + F.col("_sum"), "_rank": F.col("_rows_before") + F.col("_row") + 1})
    return out.drop("_part", "_row", "_before", "_rows_before", "_sum")


def rank_in_group(df: DataFrame, group: list[str], order: str, name: str, width: int = 1_000_000) -> DataFrame:
    """Row number by the integer ``order`` inside each group; a group of any size is split by ``order``."""
    stretch = F.expr(f"{order} div {width}")
    cut = df.withColumn("_stretch", stretch)
    counts = cut.groupBy(*group, "_stretch").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, "_stretch", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy(*group, "_stretch").orderBy(order))
    ranked = cut.withColumn("_local", local).join(by_shuffle(offsets), [*group, "_stretch"])
    return ranked.withColumn(name, F.col("_before") + F.col("_local")).drop("_stretch", "_local", "_before")


def add_record_ids(left: DataFrame, right: DataFrame, name: str, left_order: list, right_order: list):
    """Dense 1..n ids on both tables; refuses empty tables and tables that already have the column."""
    for side, df in (("left", left), ("right", right)):
        if name in df.columns:
            raise ValueError(f"{side} table already has a column {name!r}")
        if df.isEmpty():
            raise ValueError(f"{side} table is empty")
    return number_rows(left, left_order, name), number_rows(right, right_order, name)
