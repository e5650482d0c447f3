"""Document fingerprints: bottom-k sketches of shingle hashes, with built-in functions only.

A sketch is the ascending array of the k least distinct hashes of a text's word shingles. Sketches of parts merge into the
sketch of the whole. Two sketches estimate the resemblance and the containment of their shingle sets, and one sketch the
number of distinct shingles. A sketch of fewer than k hashes is the whole set, and its estimates are exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 128
WIDTH = 5
_BLANK = r"[\x20\x09-\x0D]+"


def _with(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sketch(text: Column, k: int = K, width: int = WIDTH) -> Column:
    """The k least hashes of the shingles of ``width`` words. Words are split at white space and lower-cased.

    A text with fewer words has its whole sequence as the one shingle; null, empty and blank texts have none.
    """
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _BLANK), lambda w: w != "")

    def least(hashes: Column) -> Column:
        starts = F.slice(hashes, 1, F.greatest(F.size(hashes) - (width - 1), F.lit(1)))
        shingles = F.transform(starts, lambda h, i: F.xxhash64(h, *(F.get(hashes, i + j) for j in range(1, width))))
        return F.slice(F.sort_array(F.array_distinct(shingles)), 1, k)

    return _with(F.transform(words, lambda w: F.xxhash64(w)), least)


def merged(left: Column, right: Column, k: int = K) -> Column:
    """The sketch of two parts taken together."""
    return F.slice(F.sort_array(F.array_union(left, right)), 1, k)


def resemblance(left: Column, right: Column, k: int = K) -> Column:
    """Estimated intersection over union: the share of the merged sketch that both hold. Two empty sets are alike (1)."""

    def share(both: Column) -> Column:
        shared = F.size(F.array_intersect(both, F.array_intersect(left, right)))
        return F.when(F.size(both) == 0, 1.0).otherwise(shared / F.greatest(F.size(both), F.lit(1)))

    return _with(merged(left, right, k), share)


def distinct_count(one: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else (k - 1) over the k-th hash's share of the range."""
    reach = (F.element_at(one, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(one) < k, F.size(one).cast("double")).otherwise((k - 1) / reach)


def containment(left: Column, right: Column, k: int = K) -> Column:
    """Estimated share of the left set that the right one holds. An empty left set is held by all (1)."""
    union = distinct_count(merged(left, right, k), k)
    inside = resemblance(left, right, k) * union / F.greatest(distinct_count(left, k), F.lit(1.0))
    return F.when(F.size(left) == 0, 1.0).otherwise(F.least(inside, F.lit(1.0)))


def merge_sketches(df: DataFrame, by: list[str], column: str, k: int = K) -> DataFrame:
    """One sketch for each group: the k least distinct hashes of all its parts, null and empty parts adding none.

    Equal hashes of a group fall together before they are moved, and each of 256 ranges of hashes is cut to its k least
    first, so the parts of a hot group are never gathered in one place.
    """
    hashes = df.select(*by, F.explode(column).alias("_hash")).distinct().withColumn("_slot", F.shiftright("_hash", 56))
    order = Window.partitionBy(*by, "_slot").orderBy("_hash")
    few = hashes.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)
    return few.groupBy(*by).agg(F.slice(F.sort_array(F.collect_list("_hash")), 1, k).alias(column))


def as_text(one: Column) -> Column:
    """A sketch as fixed-width hexadecimal numbers in order."""
    return F.array_join(F.transform(one, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


#: Stretches of ids: at most this many by this many.
_COARSE = _FINE = 160


def _stretch(ids: DataFrame, rows: int) -> Column:
    """The number of an id's stretch, from 1 up; stretches hold about ``rows`` rows each. Null ids are in stretch 0.

    The driver sees the cuts only, at most 25,600 of them. A row is placed by the coarse cuts and then by the fine ones.
    """
    parts = max(1, min(_COARSE * _FINE, -(-ids.count() // rows)))
    shares = [i / parts for i in range(1, parts)]
    cuts = sorted({int(x) for x in ids.where("doc_id is not null").approxQuantile("doc_id", shares, 0.1 / parts)} if shares else ())
    coarse = cuts[_FINE - 1 :: _FINE]
    groups = [cuts[i : i + _FINE - 1] for i in range(0, max(len(cuts), 1), _FINE)]
    count = lambda of: F.size(F.filter(of, lambda c: c <= F.col("doc_id")))
    longs = "array<bigint>"
    group = count(F.lit(coarse).cast(longs)) if coarse else F.lit(0)
    fine = F.get(F.array(*(F.lit(g).cast(longs) if g else F.array().cast(longs) for g in groups)), group)
    return F.when(F.col("doc_id").isNull(), 0).otherwise(group * _FINE + count(fine) + 1)


def with_following(docs: DataFrame, rows: int = 4_000) -> DataFrame:
    """Rows (doc_id, text, sketch) with next_text and next_sketch, those of the next row in descending doc_id.

    The last row is followed by the first. Ids are cut into stretches of even size. The greatest row of a stretch goes also
    to the stretch above it, whose least row it follows, so one shuffle by stretch and a window inside each suffice and no
    task holds more than a stretch. Null ids come last; rows with equal ids are ordered by the hashes of their texts.
    """
    part = _stretch(docs.select("doc_id"), rows)
    keyed = docs.select("doc_id", "text", part.alias("part"), F.xxhash64("text").alias("tie"))
    tops = keyed.groupBy("part").agg(F.max(F.struct("doc_id", "tie")).alias("top")).collect()  # a row for each stretch
    tops = sorted(((t["part"], t["top"]["doc_id"], t["top"]["tie"]) for t in tops), key=lambda t: t[0])
    above = [(*t, tops[(i + 1) % len(tops)][0]) for i, t in enumerate(tops)]
    schema = "top_part int, top_id long, top_tie long, also int"
    guests = F.broadcast(docs.sparkSession.createDataFrame(above, schema))  # as few
    match = (F.col("part") == F.col("top_part")) & F.col("doc_id").eqNullSafe(F.col("top_id")) & (F.col("tie") == F.col("top_tie"))
    own = F.struct(F.col("part").alias("in_part"), F.lit(0).alias("guest"))
    guest = F.struct(F.col("also").alias("in_part"), F.lit(1).alias("guest"))
    places = F.when(F.col("also").isNull(), F.array(own)).otherwise(F.array(own, guest))
    dealt = keyed.join(guests, match, "left").select("doc_id", "text", "tie", F.inline(places))
    dealt = dealt.repartition("in_part").withColumn("sketch", sketch(F.col("text")))
    order = Window.partitionBy("in_part").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.col("tie").desc())
    following = [F.lead(c).over(order).alias(f"next_{c}") for c in ("text", "sketch")]
    return dealt.select("doc_id", "text", "sketch", "guest", *following).where("guest = 0").drop("guest")


def fingerprints(docs: DataFrame, rows: int = 4_000) -> DataFrame:
    """Every text's fingerprint beside that of its edited text, whose last half is the next text's beginning.

    The edited text has the last floor(n / 2) code points replaced by the first as many, or all, of the next row's text.
    Null texts are empty. Columns: doc_id, text, edited, sketch, edited_sketch, next_sketch.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    pairs = with_following(source, rows)
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", 1, F.char_length("text") - half), F.substring("next_text", F.lit(1), half))
    edited = pairs.select("doc_id", "text", edited.alias("edited"), "sketch", "next_sketch")
    return edited.withColumn("edited_sketch", sketch(F.col("edited")))
