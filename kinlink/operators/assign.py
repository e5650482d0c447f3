"""One-to-one assignment of scored pairs.

Left rows choose in ascending id; each takes the best right row still free by name score, street score, then
smallest right id. Pairs arrive between *classes* of equal rows, so a group of copies is one pair.

What one row takes matters only to rows that are linked to it by pairs. Blocks whose class pairs and rows fit a budget are
settled together, as many in a task as fit. A larger block falls apart into the connected components of its pairs:

* In a *star*, whose pairs share their left or their right class (a chain of shops, a filler name), nobody's wish
  differs from his neighbour's: the first left row takes the first place, the second the next. Ranks on both sides and a
  join on them settle a star of any size.
* Other components within the budget are settled like small blocks.
* Any larger component takes turns. Its left rows are cut, in their order, into turns whose lists fit the budget; the turns
  arrive in a task one after the other, sorted by Spark, and the task keeps only the places and who has them. One job
  settles all turns of all components, a task each.

Copies cost no pairs: a left class walks down its list of right classes once, however many rows it has, and the rows of a
right class are taken in the order of their ids.

More class pairs than ``PACKED_FROM`` are read once and packed into lists (``operators/lists.py``). Blocks and components are
weighed and told apart by the lists' heads, so that what a join or a sort moves is a row for each list. A task unpacks a list
when a left row comes to it.
"""

from collections.abc import Iterator
from functools import reduce
from heapq import heapify, heappop, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinlink.operators.components import components
from kinlink.operators.lists import LIST, MEETS, ints, packed, rights_of, spread, starts_of, unpacked
from kinlink.operators.ordering import by_shuffle, rank_in_group, running_total
from kinlink.storage import materialize

#: Class pairs and rows that a task holds at once, some 50 bytes each.
PAIRS_PER_TURN = 2_000_000
#: Class pairs from which on they are packed into lists.
PACKED_FROM = 2_000_000

_TIER = ["name_score", "street_score"]
_MATCH = ["block", "left_id", "right_id", "street_score", "name_score", "used_global"]
_SCHEMA = "block string, left_id bigint, right_id bigint, street_score double, name_score double, used_global boolean"
_LEFT, _SEAT, _PAIR = 0, 1, 2
_BINS = 64
_MOST_TASKS = 1_000
_NONE = np.iinfo(np.int64).max


class Seats:
    """The rows of right classes in the order of their ids, and which of them are taken."""

    def __init__(self, units: np.ndarray, classes: np.ndarray, ids: np.ndarray):
        self._units, self._classes = np.unique(units), np.unique(classes)
        key = self._key(units, classes)
        order = np.lexsort((ids, key))
        starts = starts_of(key[order])
        self._keys = key[order][starts[:-1]]
        self.ids, self.next, self.end = ids[order].tolist(), starts[:-1].tolist(), starts[1:].tolist()
        self.taken: set[int] = set()
        self._least = ids[order][starts[:-1]]  # at each place the least id that may be free

    def _key(self, units: np.ndarray, classes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self._units, units) * len(self._classes) + np.searchsorted(self._classes, classes)

    def places(self, units: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """The numbers of right classes, which must be known."""
        return np.searchsorted(self._keys, self._key(units, classes))

    def first_free(self, place: int) -> int | None:
        at, end = self.next[place], self.end[place]
        while at < end and self.ids[at] in self.taken:
            at += 1
        self.next[place] = at
        return self.ids[at] if at < end else None

    def least_free(self, classes: np.ndarray) -> int | None:
        """The least id that is free in some right classes, which must be known, of the only unit."""
        places = np.searchsorted(self._classes, classes)
        while True:
            ids = self._least[places]
            at = ids.argmin()
            free = self.first_free(places[at])
            if free == ids[at] or (free is None and ids[at] == _NONE):
                return free
            self._least[places[at]] = _NONE if free is None else free


class _Lists:
    """Each left class's right classes by falling scores. A class has a heap of the first free ids of its best tier; ids
    only grow, so an entry is renewed when it comes to the top."""

    def __init__(self, seats: Seats, owner: np.ndarray, place: np.ndarray, name: np.ndarray, street: np.ndarray):
        self.seats, self.order = seats, np.lexsort((-street, -name, owner))
        self.place, owner, self.name, self.street = (c[self.order] for c in (place, owner, name, street))
        self.tiers = starts_of(owner, self.name, self.street)
        firsts = np.searchsorted(owner[self.tiers[:-1]], np.arange(owner.max(initial=-1) + 2)).tolist()
        self.tier, self.last = firsts[:-1], firsts[1:]
        self.heaps: dict[int, list] = {}

    def best(self, owner: int) -> tuple[int, int, int] | None:
        """``(right id, place, pair)`` of the best row that is free."""
        seats = self.seats
        heap = self.heaps.get(owner, [])
        while True:
            while heap:
                top = heap[0]
                free = seats.first_free(top[1])
                if free is None:
                    heappop(heap)
                elif free != top[0]:
                    heapreplace(heap, (free, *top[1:]))
                else:
                    return top
            tier = self.tier[owner]
            if tier == self.last[owner]:
                return None
            self.tier[owner] = tier + 1
            start, end = self.tiers[tier], self.tiers[tier + 1]
            heap = [(seats.ids[seats.next[p]], p, start + k) for k, p in enumerate(self.place[start:end].tolist()) if seats.next[p] < seats.end[p]]
            heapify(heap)
            self.heaps[owner] = heap


def _dense(units: np.ndarray, classes: np.ndarray) -> np.ndarray:
    order = np.lexsort((classes, units))
    out = np.empty(len(order), np.int64)
    starts = starts_of(units[order], classes[order])
    out[order] = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    return out


def _choose(rows: pa.Table, seats: Seats) -> pa.Table:
    """The choice in order of the left rows in ``rows``, by the pairs there; ``seats`` keeps what they take."""
    kind = ints(rows, "kind")
    lefts, pairs = np.flatnonzero(kind == _LEFT), np.flatnonzero(kind == _PAIR)
    unit, a, b = (ints(rows, c) for c in ("unit", "a", "b"))
    own = _dense(np.append(unit[lefts], unit[pairs]), np.append(a[lefts], a[pairs]))
    scores = (rows[c].to_numpy()[pairs] for c in _TIER)
    lists = _Lists(seats, own[len(lefts) :], seats.places(unit[pairs], b[pairs]), *scores)
    lefts, own = lefts[order := np.lexsort((b[lefts], unit[lefts]))], own[: len(lefts)][order].tolist()
    turns = starts_of(unit[lefts], b[lefts]).tolist()  # a row id that is there more than once chooses once
    ids, units = b[lefts].tolist(), unit[lefts].tolist()
    now, known, found = None, len(lists.tier), []
    for start, end in zip(turns, turns[1:]):
        if units[start] != now:
            if now is not None:
                seats.taken.clear()  # the ids of one unit mean nothing to another
            now = units[start]
        options = [o for o in map(lists.best, {c for c in own[start:end] if c < known}) if o]
        if options:
            best = options[0]
            if len(options) > 1:
                best = min(options, key=lambda o: (-lists.name[o[2]], -lists.street[o[2]], o[0]))
            seats.taken.add(best[0])
            found.append((ids[start], best[0], best[2]))
    left_id, right_id, pair = (np.array(c, np.int64) for c in (zip(*found) if found else ([], [], [])))
    won = rows.take(pa.array(pairs[lists.order[pair]]))
    columns = {"block": won["block"], "left_id": left_id, "right_id": right_id, **{c: won[c] for c in ("street_score", "name_score", "used_global")}}
    return pa.table(columns)


def _settle(rows: pa.Table) -> pa.Table:
    """Whole units, all at once."""
    at = np.flatnonzero(ints(rows, "kind") == _SEAT)
    return _choose(rows, Seats(*(ints(rows, c)[at] for c in ("unit", "a", "b"))))


def _settle_lists(rows: pa.Table) -> pa.Table:
    """``_settle`` for lists in place of pairs."""
    kind = ints(rows, "kind")
    lists, others = (rows.take(pa.array(np.flatnonzero(at))) for at in (kind == _PAIR, kind != _PAIR))
    pairs = spread(lists.drop_columns(["b"]), "b")
    return _settle(pa.concat_tables([pairs, others.select(pairs.column_names)]))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each turn of each unit."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        starts = starts_of(ints(table, "unit"), ints(table, "turn"))
        for start, end in zip(starts, starts[1:]):
            piece = table.slice(start, end - start)
            if held and any(piece[c][0] != held[0][c][0] for c in ("unit", "turn")):
                yield pa.concat_tables(held)
                held = []
            held.append(piece)
    if held:
        yield pa.concat_tables(held)


def _settle_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units whose seats and then turns arrive one after the other."""
    seats = None
    for piece in _pieces(batches):
        if piece["turn"][0].as_py() < 0:
            seats = Seats(*(ints(piece, c) for c in ("unit", "a", "b")))
        else:
            yield from _choose(piece, seats).to_batches()


def _choose_listed(rows: pa.Table, seats: Seats) -> pa.Table:
    """``_choose`` for lists of one unit, each unpacked only if a left row comes to it."""
    kind, a, b, n, first = (ints(rows, c) for c in ("kind", "a", "b", "n", "first"))
    falling = [np.nan_to_num(-rows[c].to_numpy(), nan=np.inf) for c in _TIER]
    tiers: dict[int, dict] = {}
    for at in np.flatnonzero(kind == _PAIR).tolist():
        tiers.setdefault(a[at], {}).setdefault((falling[0][at], falling[1][at]), []).append(at)
    open_tiers = {c: sorted(found.items(), reverse=True) for c, found in tiers.items()}
    held: dict[int, np.ndarray] = {}

    def best(owner: int) -> tuple | None:
        """The best tier with a free row, the row's id and its list."""
        left = open_tiers.get(owner, [])
        while left:
            scores, lists = left[-1]
            options = []
            for at in lists:
                if at not in held:
                    held[at] = rights_of(n[at], first[at], rows["rights"][at].as_py())
                free = seats.least_free(held[at])
                if free is not None:
                    options.append((scores, free, at))
            if options:
                return min(options)
            left.pop()  # what is taken stays taken
        return None

    classes: dict[int, set] = {}  # a row id that is there more than once chooses once
    for at in np.flatnonzero(kind == _LEFT).tolist():
        classes.setdefault(b[at], set()).add(a[at])
    found = []
    for left_id in sorted(classes):
        options = [o for o in map(best, classes[left_id]) if o]
        if options:
            _, right_id, at = min(options)
            seats.taken.add(right_id)
            found.append((left_id, right_id, at))
    left_id, right_id, at = (np.array(c, np.int64) for c in (zip(*found) if found else ([], [], [])))
    won = rows.take(pa.array(at))
    return pa.table({"block": won["block"], "left_id": left_id, "right_id": right_id, **{c: won[c] for c in ("street_score", "name_score", "used_global")}})


def _settle_listed_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_settle_turns`` for lists in place of pairs."""
    seats = None
    for piece in _pieces(batches):
        if piece["turn"][0].as_py() < 0:
            seats = Seats(*(ints(piece, c) for c in ("unit", "a", "b")))
        else:
            yield from _choose_listed(piece, seats).combine_chunks().to_batches()


def _listed(pairs: DataFrame, left_rows: DataFrame, seats: DataFrame, keys: list[str | Column]) -> DataFrame:
    """Left rows, seats and pairs or lists of units as rows of one table."""
    none = [F.lit("").alias("block"), F.lit(0.0).alias("name_score"), F.lit(0.0).alias("street_score"), F.lit(False).alias("used_global")]
    scored = ["block", *_TIER, "used_global"]
    if "rights" in pairs.columns:
        none += [F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("first"), F.lit(b"").alias("rights")]
        scored += ["n", "first", "rights"]

    def part(df: DataFrame, kind: int, a: str, b: str, more: list) -> DataFrame:
        return df.select(*keys, F.lit(kind).cast("tinyint").alias("kind"), F.col(a).alias("a"), F.col(b).alias("b"), *more)

    both = part(left_rows, _LEFT, "left_class", "left_id", none).unionByName(part(seats, _SEAT, "right_class", "right_id", none))
    return both.unionByName(part(pairs, _PAIR, "left_class", "first" if "rights" in pairs.columns else "right_class", scored))


def _rows_of(units: DataFrame, members: DataFrame, side: str, keys: list[str]) -> DataFrame:
    return members.join(by_shuffle(units.select(*keys, f"{side}_class").distinct()), f"{side}_class")


def _weigh(pairs: DataFrame, left_members: DataFrame, right_members: DataFrame, key: str) -> DataFrame:
    """``(key, weight)``: class pairs and rows of each block or component."""
    return _weigh_sides(pairs.groupBy(key).agg(F.count("*").alias("n")), pairs, pairs, left_members, right_members, key)


def _weigh_sides(
    sizes: DataFrame, lefts: DataFrame, rights: DataFrame, left_members: DataFrame, right_members: DataFrame, key: str
) -> DataFrame:
    """``_weigh`` of counted pairs, by the classes of either side."""
    parts = [sizes]
    for side, source, members in (("left", lefts, left_members), ("right", rights, right_members)):
        counts = members.groupBy(f"{side}_class").agg(F.count("*").alias("_n"))
        classes = source.select(key, f"{side}_class").distinct().join(by_shuffle(counts), f"{side}_class")
        parts.append(classes.groupBy(key).agg(F.sum("_n").alias("n")))
    return parts[0].union(parts[1]).union(parts[2]).groupBy(key).agg(F.sum("n").alias("weight"))


def _weights(pairs: DataFrame, right_members: DataFrame, budget: int) -> DataFrame:
    """``(block, left_class, weight)``: a left row weighs as many pairs as its class has with places, within the budget."""
    listed = pairs.join(by_shuffle(right_members.select("right_class").distinct()), "right_class", "left_semi")
    weight = F.least(F.count("*"), F.lit(max(budget, 1))).cast("bigint")
    return listed.groupBy("block", "left_class").agg(weight.alias("weight"))


def _in_bins(
    units: DataFrame, left_members: DataFrame, right_members: DataFrame, total: int, budget: int, rights: DataFrame | None = None
) -> DataFrame:
    """Matches of units within the budget; ``units`` has pairs with their unit and its weight, or lists, and then
    ``rights`` has the right classes. Small ones share a task."""
    bins = max(_BINS, 4 * total // max(budget, 1))
    alone = F.when(F.col("weight") > budget // 4, F.col("unit"))
    keys = ["unit", "bin", "alone"]
    placed, seated = (
        x.withColumns({"alone": alone, "bin": F.pmod(F.xxhash64("unit"), F.lit(bins))}) for x in (units, units if rights is None else rights)
    )
    rows = _listed(placed, _rows_of(placed, left_members, "left", keys), _rows_of(seated, right_members, "right", keys), keys)
    return rows.groupBy("bin", "alone").applyInArrow(_settle if rights is None else _settle_lists, _SCHEMA)


def _seats(right_members: DataFrame, classes: DataFrame) -> DataFrame:
    wanted = right_members.join(by_shuffle(classes.select("right_class").distinct()), "right_class", "left_semi")
    return rank_in_group(wanted, ["right_class"], "right_id", "seat")


def _with_units(pairs: DataFrame) -> DataFrame:
    """Pairs with their component and whether it is a star: ``left`` or ``right`` by the side that has one class only."""
    ends = pairs.selectExpr("left_class * 2 AS node", "right_class * 2 + 1 AS other")
    unit = components(ends).where("node % 2 = 0").select(F.expr("node div 2").alias("left_class"), F.col("component").alias("unit"))
    placed = pairs.join(by_shuffle(unit), "left_class")
    spans = placed.groupBy("unit").agg(
        F.min("left_class").alias("a"), F.max("left_class").alias("b"), F.min("right_class").alias("c"), F.max("right_class").alias("d")
    )
    star = F.when(F.col("a") == F.col("b"), "left").when(F.col("c") == F.col("d"), "right")
    return materialize(placed.join(by_shuffle(spans.select("unit", star.alias("star"))), "unit"), "units")


def _left_stars(pairs: DataFrame, left_members: DataFrame, right_members: DataFrame) -> DataFrame:
    """Components with one left class: its rows by id take the places by score, then id."""
    tiers = pairs.join(by_shuffle(right_members.groupBy("right_class").agg(F.count("*").alias("n"))), "right_class")
    tiers = tiers.groupBy("unit", *_TIER).agg(F.sum("n").alias("n"))
    better = Window.partitionBy("unit").orderBy(*(F.desc(c) for c in _TIER)).rowsBetween(Window.unboundedPreceding, -1)
    tiers = tiers.withColumn("before", F.coalesce(F.sum("n").over(better), F.lit(0))).drop("n")
    places = rank_in_group(pairs.join(by_shuffle(right_members), "right_class"), ["unit", *_TIER], "right_id", "within")
    places = places.join(by_shuffle(tiers), ["unit", *_TIER]).withColumn("place", F.col("before") + F.col("within"))
    asking = rank_in_group(left_members.join(by_shuffle(pairs.select("left_class").distinct()), "left_class", "left_semi"), ["left_class"], "left_id", "place")
    return places.join(by_shuffle(asking), ["left_class", "place"]).select(_MATCH)


def _right_stars(pairs: DataFrame, left_members: DataFrame, right_members: DataFrame) -> DataFrame:
    """Components with one right class: their left rows by id take its rows by id."""
    asking = left_members.join(by_shuffle(pairs.select("unit", "left_class", "right_class")), "left_class")
    asking = rank_in_group(asking, ["unit"], "left_id", "seat")
    chosen = asking.join(by_shuffle(_seats(right_members, pairs)), ["right_class", "seat"])
    return chosen.join(by_shuffle(pairs), ["unit", "left_class", "right_class"]).select(_MATCH)


def _turns(pairs: DataFrame, left_members: DataFrame, weights: DataFrame, budget: int) -> DataFrame:
    """``(unit, left_class, left_id, turn)``: when each left row of the units chooses."""
    units = pairs.select("unit", "left_class").distinct().join(by_shuffle(weights.select("left_class", "weight")), "left_class")
    placed = materialize(running_total(left_members.join(by_shuffle(units), "left_class"), ["unit", "left_id"], "weight", "_upto"), "asking")
    first = placed.groupBy("unit").agg(F.min(F.col("_upto") - F.col("weight")).alias("_start"))
    turn = F.expr(f"cast((_upto - weight - _start) div {max(budget, 1)} as int)")
    timed = placed.join(first, "unit").select("unit", "left_class", "left_id", turn.alias("turn"))
    # a row id of several classes chooses once
    return materialize(timed.withColumn("turn", F.min("turn").over(Window.partitionBy("unit", "left_id"))), "turns")


def _in_turns(pairs: DataFrame, left_members: DataFrame, right_members: DataFrame, weights: DataFrame, budget: int) -> DataFrame:
    """Matches of units beyond the budget, all turns in one job; a task holds a unit's places and one turn."""
    pairs = materialize(pairs, "turn-pairs")
    seats = materialize(_rows_of(pairs, right_members, "right", ["unit"]), "seats").withColumn("turn", F.lit(-1))
    timed = _turns(pairs, left_members, weights, budget)
    lists = pairs.join(by_shuffle(timed.select("unit", "left_class", "turn").distinct()), ["unit", "left_class"])
    rows = _listed(lists, timed, seats, ["unit", "turn"])
    return rows.repartition("unit").sortWithinPartitions("unit", "turn").mapInArrow(_settle_turns, _SCHEMA)


def _sides(lists: DataFrame, meets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(left_class, unit, star)`` and ``(right_class, unit, star)`` by the components of lists, as ``_with_units`` has them."""
    node = lambda c, odd: F.expr(f"{c} * 2 + {odd}")
    ends = lists.select(node("left_class", 0).alias("node"), node("first", 1).alias("other"))
    ends = ends.union(meets.select(node("anchor", 1), node("right_class", 1)))
    nodes = components(ends).select(F.shiftright("node", 1).alias("class"), F.expr("node & 1 = 1").alias("right"), F.col("component").alias("unit"))
    star = F.when(F.count_if(~F.col("right")) == 1, "left").when(F.count_if("right") == 1, "right")
    placed = materialize(nodes.join(by_shuffle(nodes.groupBy("unit").agg(star.alias("star"))), "unit"), "nodes")
    lefts, rights = (placed.where(on).withColumnRenamed("class", name) for on, name in ((~F.col("right"), "left_class"), (F.col("right"), "right_class")))
    return lefts.drop("right"), rights.drop("right")


def _in_listed_turns(
    lists: DataFrame, rights: DataFrame, left_members: DataFrame, right_members: DataFrame, weights: DataFrame, units: int, budget: int
) -> DataFrame:
    """``_in_turns`` for lists in place of pairs; each of the units gets a task."""
    seats = _rows_of(rights, right_members, "right", ["unit"]).withColumn("turn", F.lit(-1))
    timed = _turns(weights, left_members, weights, budget)
    lists = lists.join(by_shuffle(timed.select("unit", "left_class", "turn").distinct()), ["unit", "left_class"])
    rows = _listed(lists, timed, seats, ["unit", "turn"])
    tasks = min(4 * units, _MOST_TASKS)
    return rows.repartition(tasks, "unit").sortWithinPartitions("unit", "turn").mapInArrow(_settle_listed_turns, _SCHEMA)


def _lists(pairs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lists of pairs, their sizes ``(block, left_class, first, n)``, and meets ``(block, anchor, right_class)``."""
    stored = materialize(packed(pairs), "lists")
    lists, meets = stored.where(F.col("kind") == LIST).drop("kind"), stored.where(F.col("kind") == MEETS)
    counted = lists.groupBy("block", "left_class", "first").agg(F.sum("n").alias("n"))
    meets = unpacked(meets.withColumnRenamed("left_class", "anchor"), "block", "anchor").distinct()
    return lists, materialize(counted, "list-sizes"), materialize(meets, "meets")


def _assign_lists(pairs: DataFrame, left_members: DataFrame, right_members: DataFrame, budget: int) -> DataFrame:
    """``assign`` for pairs that are too many to be moved one by one."""
    lists, counted, meets = _lists(pairs)
    gone = False
    for side, source, members in (("left", counted, left_members), ("right", meets, right_members)):
        known = by_shuffle(members.select(f"{side}_class").distinct())
        if not source.join(known, f"{side}_class", "left_anti").isEmpty():
            pairs, gone = pairs.join(known, f"{side}_class", "left_semi"), True
    if gone:
        lists, counted, meets = _lists(pairs)
    sizes = counted.groupBy("block").agg(F.sum("n").alias("n"))
    sizes = materialize(_weigh_sides(sizes, counted, meets, left_members, right_members, "block"), "block-sizes")
    heavy = F.col("weight") > budget
    light = F.sum(F.when(~heavy, F.col("weight")))
    total, largest = sizes.agg(light, F.max("weight")).first()
    small, rights = (x.join(sizes.where(~heavy), "block").withColumn("unit", F.xxhash64("block")) for x in (lists, meets))
    found = [_in_bins(small, left_members, right_members, total or 0, budget, rights)] if total else []
    if (largest or 0) > budget:
        lists, meets, counted = (x.join(sizes.where(heavy), "block", "left_semi") for x in (lists, meets, counted))
        lefts, rights = _sides(counted, meets)
        counts = counted.groupBy("left_class").agg(F.sum("n").alias("n")).join(by_shuffle(lefts), "left_class")
        weighed = _weigh_sides(counts.groupBy("unit").agg(F.sum("n").alias("n")), lefts, rights, left_members, right_members, "unit")
        weighed = materialize(weighed, "unit-sizes")
        lefts, rights = (materialize(x.join(by_shuffle(weighed), "unit"), "sides") for x in (counts, rights))
        # joined once: stars, units within the budget and others are parts of one stored table
        lists = materialize(lists.join(by_shuffle(lefts.drop("n")), "left_class"), "units")
        kinds = {r[0] for r in lefts.select("star").distinct().collect()}
        for side, settle in (("left", _left_stars), ("right", _right_stars)):
            if side in kinds:
                pairs = unpacked(lists.where(F.col("star") == side), "unit", "block", "left_class", *_TIER, "used_global")
                found.append(settle(pairs, left_members, right_members))
        lists, lefts, rights = (x.where("star IS NULL") for x in (lists, lefts, rights))
        total, units = lefts.select("unit", "weight").distinct().agg(light, F.count_if(heavy)).first()
        if total:
            found.append(_in_bins(lists.where(~heavy), left_members, right_members, total, budget, rights.where(~heavy)))
        if units:
            weights = lefts.where(heavy).select("unit", "left_class", F.least("n", F.lit(max(budget, 1))).cast("bigint").alias("weight"))
            found.append(_in_listed_turns(lists.where(heavy).drop("weight"), rights.where(heavy), left_members, right_members, weights, units, budget))
    return reduce(DataFrame.unionByName, (won.select(_MATCH) for won in found)) if found else pairs.sparkSession.createDataFrame([], _SCHEMA)


def assign(
    pairs: DataFrame, left_members: DataFrame, right_members: DataFrame, pairs_per_turn: int = PAIRS_PER_TURN
) -> DataFrame:
    """Matches ``(block, left_id, right_id, street_score, name_score, used_global)``.

    ``pairs``: block, left_class, right_class and scores, one row per class pair; members: class and row id.
    """
    left_members, right_members = left_members.where("left_id IS NOT NULL"), right_members.where("right_id IS NOT NULL")
    if pairs.count() > PACKED_FROM:
        return _assign_lists(pairs, left_members, right_members, pairs_per_turn)
    # classes whose rows are all taken by earlier rules have nothing to choose
    for side, members in (("left", left_members), ("right", right_members)):
        pairs = pairs.join(by_shuffle(members.select(f"{side}_class").distinct()), f"{side}_class", "left_semi")
    pairs = materialize(pairs, "open-pairs")
    sizes = materialize(_weigh(pairs, left_members, right_members, "block"), "block-sizes")
    heavy = F.col("weight") > pairs_per_turn
    total, largest = sizes.agg(F.sum(F.when(~heavy, F.col("weight"))), F.max("weight")).first()
    small = pairs.join(sizes.where(~heavy), "block").withColumn("unit", F.xxhash64("block"))
    found = [_in_bins(small, left_members, right_members, total or 0, pairs_per_turn)]
    if (largest or 0) > pairs_per_turn:
        units = _with_units(pairs.join(sizes.where(heavy), "block", "left_semi"))
        kinds = {r[0] for r in units.select("star").distinct().collect()}
        if "left" in kinds:
            found.append(_left_stars(units.where("star = 'left'"), left_members, right_members))
        if "right" in kinds:
            found.append(_right_stars(units.where("star = 'right'"), left_members, right_members))
        units = units.where("star IS NULL")
        weighed = materialize(_weigh(units, left_members, right_members, "unit"), "unit-sizes")
        total, largest = weighed.agg(F.sum(F.when(~heavy, F.col("weight"))), F.max("weight")).first()
        if total:
            found.append(_in_bins(units.join(by_shuffle(weighed.where(~heavy)), "unit"), left_members, right_members, total, pairs_per_turn))
        if (largest or 0) > pairs_per_turn:
            rest = units.join(weighed.where(heavy), "unit", "left_semi")
            found.append(_in_turns(rest, left_members, right_members, _weights(rest, right_members, pairs_per_turn), pairs_per_turn))
    out = found[0].select(_MATCH)
    for won in found[1:]:
        out = out.unionByName(won.select(_MATCH))
    return out
