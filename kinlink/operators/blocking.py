"""Blocks: match keys, value mappings between ZIP and city, block sizes and work batches."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.functions.cast import match_key
from kinlink.operators.ordering import running_total
from kinlink.storage import materialize

LEFT_KEYS = {
    "City_UPDATED": "standardized_city",
    "Street_UPDATED": "standardized_street_only",
    "BusinessName_UPDATED": "standardized_business_name_with_spaces",
}
RIGHT_KEYS = {
    "City_UPDATED": "physical_city",
    "Street_UPDATED": "standardized_street_only",
    "BusinessName_UPDATED": "standardized_business_name_with_spaces",
    "GlobalName_UPDATED": "standardized_global_ultimate_name_with_spaces",
}


def add_match_keys(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Upper-case, trimmed keys; the ZIP code is taken over as it is."""

    def keyed(df: DataFrame, keys: dict[str, str], zipcode: str) -> DataFrame:
        columns = {new: match_key(F.col(old)) for new, old in keys.items()}
        return df.withColumns({**columns, "Zip_UPDATED": F.col(zipcode)})

    return keyed(left, LEFT_KEYS, "Zipcode"), keyed(right, RIGHT_KEYS, "physical_zip")


def value_links(df: DataFrame, key: str, value: str) -> DataFrame:
    """Distinct ``(key, value)`` rows without nulls: a mapping in its long, evenly spread form."""
    return df.select(key, value).where(F.col(key).isNotNull() & F.col(value).isNotNull()).distinct()


def merge_links(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


def as_mapping(links: DataFrame, name: str) -> DataFrame:
    """One row per key with the sorted array of its values."""
    key, value = links.columns
    return links.groupBy(key).agg(F.array_sort(F.collect_set(value)).alias(name))


def zip_to_cities(df: DataFrame, zipcode: str = "Zip_UPDATED", city: str = "City_UPDATED") -> DataFrame:
    return as_mapping(value_links(df, zipcode, city), "cities")


def city_to_zips(df: DataFrame, city: str = "City_UPDATED", zipcode: str = "Zip_UPDATED") -> DataFrame:
    return as_mapping(value_links(df, city, zipcode), "zips")


def with_known_block(df: DataFrame, key: str, other: str) -> DataFrame:
    """Rows that take part in blocking by ``key``.

    A row takes part when its other locality value belongs to its key's merged mapping. The mapping is built from
    the same rows, so this is the same as both being present.
    """
    return df.where(F.col(key).isNotNull() & F.col(other).isNotNull())


def in_mapping(df: DataFrame, links: DataFrame) -> DataFrame:
    """Rows whose (key, value) is in a long-form mapping: the explicit membership test."""
    return df.join(links, links.columns, "left_semi").select(df.columns)


def block_counts(left: DataFrame, right: DataFrame, key: str, keep_zero: bool = False) -> DataFrame:
    """Rows per key on both sides and the comparisons they imply; keys without comparisons only on request."""
    a = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("count_left"))
    b = right.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("count_right"))
    both = a.join(b, key, "full_outer").fillna(0, ["count_left", "count_right"])
    counts = both.withColumn("total_comparisons", F.col("count_left") * F.col("count_right"))
    return counts if keep_zero else counts.where(F.col("total_comparisons") > 0)


def by_work(counts: DataFrame) -> DataFrame:
    """Budget report: keys with comparisons, least work first."""
    key = counts.columns[0]
    return counts.where(F.col("total_comparisons") > 0).orderBy("total_comparisons", key)


_BINS = 8192


def _batch_ends(placed: DataFrame, total: int, budget: int) -> list[int]:
    """Running totals at which batches close: the first at or past a budget's end, and so on from there.

    One pass cuts the totals into bins of equal width and keeps the first and the last total of each. An end that
    falls between a bin's first and last total is looked up; there are no more ends than parts, and one on the edge
    of a bin, as with few keys or large ones, costs no look-up.
    """
    width = max(total // _BINS, 1)
    bins = placed.groupBy(F.expr(f"_done div {width}").alias("bin")).agg(F.min("_done").alias("first"), F.max("_done").alias("last"))
    known = [(r["bin"], r["first"], r["last"]) for r in bins.orderBy("bin").collect()]
    ends, at, start = [], 0, 0
    while True:
        aim = start + budget
        while at < len(known) and known[at][2] < aim:
            at += 1
        if at == len(known):
            return ends
        number, first, last = known[at]
        if first >= aim:
            end = first
        elif last == aim or width == 1:
            end = last
        else:
            inside = (F.expr(f"_done div {width}") == number) & (F.col("_done") >= aim)
            end = placed.where(inside).agg(F.min("_done")).first()[0]
        ends.append(end)
        start = end


def batches(counts: DataFrame, parts: int) -> DataFrame:
    """Batch number per key: keys by ascending work, a batch closes once its work reaches total // parts."""
    key = counts.columns[0]
    placed = materialize(running_total(counts, ["total_comparisons", key], "total_comparisons", "_done"), "work")
    total = placed.agg(F.max("_done")).first()[0] or 0
    budget = total // parts
    if budget == 0:
        return placed.select(key, "total_comparisons", F.col("_rank").alias("batch"))
    ends = _batch_ends(placed, total, budget)
    closed = F.size(F.filter(F.lit(ends).cast("array<bigint>"), lambda end: F.col("_done") > end)) if ends else F.lit(0)
    return placed.select(key, "total_comparisons", (closed + 1).cast("bigint").alias("batch"))
