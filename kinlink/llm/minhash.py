"""Near duplicates by fast similarity sketching, banding and exact verification.

A sketch has ``T`` coordinates. In a round every shingle falls into one bin by a hash of its own; the first T rounds choose
the bin at random, the next T rounds fill bin after bin, so that after 2 T rounds at the latest every coordinate holds a
value, and large sets are through after one or two rounds. A coordinate is equal in two sketches with the probability of
the sets' resemblance, and the number of equal ones is concentrated.

Texts with equal sets are one class. Classes that share a band of the sketch meet in a bucket. A bucket of any size costs a
pair for each member: all are verified against the least member. Buckets whose members are then still in several components
are compared in tiles of bounded size: pairs that agree in enough coordinates are looked at, and a tile gives the links that
join components. All links are confirmed on full sets made from the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinlink.llm.common import HashedWords, mixed, pieces, slices
from kinlink.llm.components import components
from kinlink.storage import materialize

COORDINATES = 128
#: Coordinates of a band. At a resemblance of 0.8 all 32 bands differ in one of 19 million pairs.
ROWS = 4
#: Equal coordinates below which a pair of a tile is no candidate: five and a half standard deviations under 0.8.
AGREEING = 78
#: Rows of a side of a tile, and rows of the tiles that a task looks at together.
TILE, TOGETHER = 512, 4_000
SIGNED = T.StructType([
    T.StructField("n", T.LongType()),
    T.StructField("cls", T.LongType()),
    T.StructField("bands", T.ArrayType(T.LongType())),
    T.StructField("short", T.BinaryType()),
])


def shingle_sets(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and where each text's begin (with the end as last)."""
    words = HashedWords(texts)
    own, n = words.hashes(), len(texts)
    bounds = np.searchsorted(words.text, np.arange(n + 1))
    count = np.diff(bounds)
    rolled = np.zeros(len(own), np.uint64)
    rng = np.random.default_rng(width).integers(1, 2**62, max(width, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    with np.errstate(over="ignore"):
        for j in range(min(width, len(own))):
            rolled[: len(own) - j] += own[j:] * rng[j]
    rolled = mixed(rolled, 1)
    sets = []
    for i in range(n):
        a, b = bounds[i], bounds[i + 1]
        if count[i] >= width:
            sets.append(np.unique(rolled[a : b - width + 1]))
        elif count[i]:  # fewer words: the whole sequence is the one shingle
            with np.errstate(over="ignore"):
                whole = (own[a:b] * rng[: b - a]).sum(dtype=np.uint64)
            sets.append(mixed(np.array([whole], np.uint64), 2))
        else:
            sets.append(np.zeros(0, np.uint64))
    ends = np.cumsum([0, *map(len, sets)])
    return np.concatenate([*sets, np.zeros(0, np.uint64)]), ends


def sketches(values: np.ndarray, ends: np.ndarray, size: int = COORDINATES) -> np.ndarray:
    """A sketch of ``size`` coordinates for each set; a set without elements has the greatest value everywhere."""
    n = len(ends) - 1
    cells = np.full(n * size, np.uint64(2**64 - 1))
    filled = np.zeros(n * size, bool)
    owner = np.repeat(np.arange(n), np.diff(ends))
    for turn in range(2 * size):
        if not len(values):
            break
        hashed = mixed(values, 1_000 + turn)
        bins = (hashed >> np.uint64(40)).astype(np.int64) % size if turn < size else turn - size
        cell = owner * size + bins
        free = ~filled[cell]
        np.minimum.at(cells, cell[free], hashed[free])
        filled[cell[free]] = True
        open_still = ~filled.reshape(n, size).all(1)
        keep = open_still[owner]
        if not keep.all():
            values, owner = values[keep], owner[keep]
    return cells.reshape(n, size)


def signatures(texts: list[str], width: int) -> tuple[np.ndarray, ...]:
    """Size, class, band keys and shortened coordinates of each text's set; the class of equal sets is equal."""
    values, ends = shingle_sets(texts, width)
    counts = np.diff(ends)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(values, 7), dtype=np.uint64)])
        cls = mixed((sums[ends[1:]] - sums[ends[:-1]]) ^ counts.astype(np.uint64), 8)
        full = sketches(values, ends)
        bands = full.reshape(len(texts), -1, ROWS)
        factors = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
        keys = mixed((bands * factors).sum(2, dtype=np.uint64) + np.arange(bands.shape[1], dtype=np.uint64), 9)
    return counts, cls.view(np.int64), keys.view(np.int64), (full & np.uint64(0xFFFF)).astype("<u2")


def signed(text: str | Column, width: int) -> Column:
    """Size, class, bands and short sketch of each text; the class of a null or empty set is null."""

    @F.arrow_udf(SIGNED)
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = []
            for run in slices((t or "" for t in pieces(batch)), 1_000_000):
                n, cls, keys, short = signatures(run, width)
                ends = pa.array(np.arange(len(run) + 1, dtype=np.int32) * keys.shape[1])
                parts.append(
                    pa.StructArray.from_arrays(
                        [
                            pa.array(n.astype(np.int64)),
                            pa.array(cls, mask=n == 0),
                            pa.ListArray.from_arrays(ends, pa.array(keys.ravel())),
                            pa.array([row.tobytes() for row in short], pa.binary()),
                        ],
                        [f.name for f in SIGNED],
                    )
                )
            kind = pa.struct([("n", pa.int64()), ("cls", pa.int64()), ("bands", pa.list_(pa.int64())), ("short", pa.binary())])
            yield pa.concat_arrays([p.cast(kind) for p in parts]) if parts else pa.array([], kind)

    return sign(text)


def class_of(text: str | Column, width: int) -> Column:
    @F.arrow_udf(T.LongType())
    def classes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [np.zeros(0, np.int64)]
            for run in slices((t or "" for t in pieces(batch)), 1_000_000):
                values, ends = shingle_sets(run, width)
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(values, 7), dtype=np.uint64)])
                with np.errstate(over="ignore"):
                    sums = sums[ends[1:]] - sums[ends[:-1]]
                found.append(mixed(sums ^ np.diff(ends).astype(np.uint64), 8).view(np.int64))
            yield pa.array(np.concatenate(found))

    return classes(text)


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union holds for two ascending sets, neither of them empty."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or 100 * len(a) < percent * len(b):
        return False
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    common = int((b[at] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def set_list(texts: list[str], width: int) -> list[np.ndarray]:
    out = []
    for run in slices(texts, 1_000_000):
        values, ends = shingle_sets(run, width)
        out += [values[a:b] for a, b in zip(ends[:-1], ends[1:])]
    return out


def resembling(left: str, right: str, width: int, percent: int) -> Column:
    """Whether the full shingle sets of two texts resemble each other enough."""

    @F.arrow_udf(T.BooleanType())
    def check(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in batches:
            out = []
            for start in range(0, len(a), 500):
                x, y = a.slice(start, 500).to_pylist(), b.slice(start, 500).to_pylist()
                texts = list({*x, *y})
                sets = dict(zip(texts, set_list(texts, width)))
                out += [alike(sets[s], sets[t], percent) for s, t in zip(x, y)]
            yield pa.array(out, pa.bool_())

    return check(left, right)


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets resemble each other enough."""
    first = texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(first, "a").join(second, "b").where(resembling("text_a", "text_b", width, percent)).select("a", "b")


def _tile_links(rows: pd.DataFrame, width: int, percent: int) -> list[tuple[int, int]]:
    """Links of one tile that join components: pairs that agree enough are confirmed on full sets, the likeliest first.

    A pair whose ends are joined already is passed over, so a tile gives fewer links than it has rows.
    """
    left, right = rows[rows["side"] == 0], rows[rows["side"] == 1]
    if not len(left) or not len(right):
        return []
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := above.get(x, x)) != x:
            above[x] = x = above.get(up, up)
        return x

    short = np.stack([np.frombuffer(x, "<u2") for x in right["short"]])
    bands = np.stack([np.asarray(x, np.int64) for x in right["bands"]])
    cls, comp, rest = (right[c].to_numpy() for c in ("cls", "comp", "rest"))
    texts, key = right["text"].to_numpy(), int(rows["k"].iloc[0])
    sets: dict[int, np.ndarray] = {}

    def full(one: int, text: str) -> np.ndarray:
        if one not in sets:
            sets[one] = set_list([text], width)[0]
        return sets[one]

    links = []
    for one, own, mine, own_comp, text in zip(*(left[c] for c in ("cls", "short", "bands", "comp", "text"))):
        agreeing = (short == np.frombuffer(own, "<u2")).sum(1)
        at = np.flatnonzero((comp != own_comp) & (~rest | (cls > one)) & (agreeing >= AGREEING))
        if not len(at):
            continue
        mine = np.asarray(mine, np.int64)
        at = at[mine[(bands[at] == mine).argmax(1)] == key]  # the pair's first common bucket looks at it
        for i in at[np.argsort(-agreeing[at], kind="stable")].tolist():
            a, b = root(int(own_comp)), root(int(comp[i]))
            if a != b and alike(full(int(one), text), full(int(cls[i]), texts[i]), percent):
                above[a] = b
                links.append((int(one), int(cls[i])))
    return links


def unsettled_links(members: DataFrame, labels: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) within buckets whose members still lie in several components.

    All members are held against those outside the component of the bucket's least member, in tiles of ``TILE`` by ``TILE``
    rows; a row is copied once for each tile of the other side. Many tiles share a task, a few thousand rows at a time.
    """
    known = labels.select(F.col("node").alias("cls"), F.col("component").alias("comp"))
    placed = members.join(known, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    hub = placed.where("cls = hub").select("k", F.col("comp").alias("hub_comp"))
    placed = materialize(placed.join(hub, "k").withColumn("rest", F.col("comp") != F.col("hub_comp")), "placed")
    sizes = placed.groupBy("k").agg(F.count("*").alias("all"), F.sum(F.col("rest").cast("long")).alias("others"))
    tiles = lambda name: F.ceil(F.col(name) / TILE).cast("int")
    sizes = sizes.where("others > 0").withColumns({"wide": tiles("all"), "high": tiles("others")})
    copies = sizes.agg(F.sum(F.expr("`all` * high + others * wide"))).first()[0] or 0
    groups = -(-copies // TOGETHER) or 1
    rows = placed.join(sizes.select("k", "wide", "high"), "k")
    own = lambda n: F.pmod(F.xxhash64("cls", "k"), F.col(n)).cast("int")
    down = rows.where("rest").withColumns({"i": own("high"), "j": F.explode(F.sequence(F.lit(0), F.col("wide") - 1))})
    across = rows.withColumns({"j": own("wide"), "i": F.explode(F.sequence(F.lit(0), F.col("high") - 1))})
    columns = ["k", "i", "j", "cls", "comp", "rest"]
    both = down.select(*columns, F.lit(0).alias("side")).unionByName(across.select(*columns, F.lit(1).alias("side")))
    both = both.join(classes.select("cls", "bands", "short"), "cls").join(texts, "cls")
    both = both.withColumn("together", F.pmod(F.xxhash64("k", "i", "j"), F.lit(groups)))

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [x for _, tile in pdf.groupby(["k", "i", "j"], sort=False) for x in _tile_links(tile, width, percent)]
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return both.groupBy("together").applyInPandas(links, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept, a row for each row of ``docs``.

    Words are runs of bytes other than white space, A-Z lower-cased; a set is the distinct shingles of ``width`` words, or
    the whole sequence of a shorter text. Sets with 100 * intersection >= percent * union are linked, and a component is all
    that links reach, named by its least doc_id. Null and blank texts are linked with nothing. Rows with a null doc_id take
    part; a component without any id has the id null and its rows are kept. Repeated rows are one class, all of them kept
    if their id is the least. Intended for ``percent`` of 80 and more (lower ones need more bands).
    """
    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    all_rows = materialize(source.withColumn("s", signed("text", width)).select("doc_id", "s.*"), "signed")
    some = all_rows.where("cls is not null")
    classes = materialize(some.dropDuplicates(["cls"]).select("cls", "bands", "short"), "classes")
    placed = classes.select("cls", F.explode("bands").alias("k"))
    hubs = placed.groupBy("k").agg(F.min("cls").alias("hub"), F.max("cls").alias("top")).where("hub < top").drop("top")
    members = materialize(placed.join(hubs, "k").select("k", "hub", "cls"), "members")
    least = some.groupBy("cls").agg(F.min("doc_id").alias("least"))
    needed = least.join(members.select("cls").distinct(), "cls", "left_semi").select(F.col("least").alias("wanted")).distinct()
    found = source.join(needed, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
    texts = materialize(found.select(class_of("text", width).alias("cls"), "text").dropDuplicates(["cls"]), "texts")
    pairs = members.where("cls <> hub").select(F.col("hub").alias("a"), F.col("cls").alias("b")).distinct()
    links = materialize(verified(pairs, texts, width, percent), "star_links")
    labels = components(links)
    more = unsettled_links(members, labels, classes, texts, width, percent)
    labels = components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    of_class = least.join(labels.select(F.col("node").alias("cls"), "component"), "cls", "left")
    of_class = of_class.withColumn("component", F.coalesce("component", "cls"))
    # stored, so that a component of very many classes can be split in the join
    names = materialize(of_class.groupBy("component").agg(F.min("least").alias("component_id")), "names")
    named = materialize(of_class.join(names, "component").select("cls", "component_id"), "components")
    out = some.join(named, "cls").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = all_rows.where("cls is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return out.unionByName(alone).withColumn("kept", kept)
