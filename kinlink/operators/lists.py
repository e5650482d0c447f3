"""Scored class pairs packed into lists.

A list has the right classes that a left class meets at one score, as the differences of their sorted ids in as few bytes as
these need. It is one row for Spark, however long it is, and a byte or two for a pair. Beside the lists there are *meets*:
the right classes whose left classes all have the same least right class. They connect what the pairs connect and are far
fewer, as left classes of one component mostly share their least right class.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame

from kinlink.storage import stored_files

LIST, MEETS = 0, 1
#: Pairs that are packed or unpacked at once.
PAIRS_AT_ONCE = 500_000

_SCORED = ["block", "left_class", "name_score", "street_score", "used_global"]
_LISTS = "kind tinyint, block string, left_class bigint, name_score double, street_score double, used_global boolean, n bigint, first bigint, rights binary"


def ints(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy().astype(np.int64, copy=False)


def starts_of(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where a new combination of values begins in sorted columns, and their end."""
    n = len(sorted_columns[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in sorted_columns])
    return np.append(np.flatnonzero(new), n)


def _codes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """The number of each value, by first appearance, and the values."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    coded = column.dictionary_encode(null_encoding="encode")
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _mixed(*columns: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, int]:
    """The number of each combination of values, and how many there are."""
    codes, values = _codes(columns[0])
    for column in columns[1:]:
        more, found = _codes(column)
        codes, values = _codes(pa.array(codes * len(found) + more))
    return codes, len(values)


def _order(codes: np.ndarray, known: int) -> np.ndarray:
    return np.argsort(codes.astype(np.uint16) if known <= 1 << 16 else codes, kind="stable")


def _binary(ids: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Runs of ascending ids as the differences to their predecessors; the first of a run is 0."""
    steps = np.zeros(len(ids), np.uint64)
    steps[1:] = (ids[1:] - ids[:-1]).view(np.uint64)
    steps[starts[:-1]] = 0
    kind = np.min_scalar_type(steps.max(initial=0))
    offsets = pa.py_buffer((starts * kind.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, offsets, pa.py_buffer(steps.astype(kind))])


def rights_of(n: int, first: int, steps: bytes) -> np.ndarray:
    """The ids of one list."""
    return np.cumsum(np.frombuffer(steps, f"u{len(steps) // n}"), dtype=np.int64) + first


def rights(lists: pa.Table) -> np.ndarray:
    """The ids of all lists, one after the other."""
    n, first = ints(lists, "n"), ints(lists, "first")
    steps = lists["rights"].combine_chunks()
    width = pc.binary_length(steps).to_numpy(zero_copy_only=False) // np.maximum(n, 1)
    out, begin = np.empty(n.sum(), np.int64), np.cumsum(n) - n
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        m = n[at]
        own = np.cumsum(m) - m
        upto = np.cumsum(np.frombuffer(b"".join(steps.take(pa.array(at)).to_pylist()), f"u{w}"), dtype=np.int64)
        out[np.repeat(begin[at] - own, m) + np.arange(m.sum())] = upto + np.repeat(first[at] - upto[own], m)
    return out


def _pack(pairs: pa.Table) -> pa.Table:
    left, lefts = _mixed(pairs["block"], pairs["left_class"])
    tier, tiers = _mixed(pairs["name_score"], pairs["street_score"], pairs["used_global"])
    code, known = _codes(pairs["right_class"])
    ids = np.sort(known.to_numpy())
    place = np.searchsorted(ids, known.to_numpy())[code]
    group = left * tiers + tier
    order = _order(place, len(ids))
    order = order[_order(group[order], lefts * tiers)]
    right, starts = ids[place[order]], starts_of(group[order])
    heads = order[starts[:-1]]
    lists = {c: pairs[c].take(pa.array(heads)) for c in _SCORED} | {"n": np.diff(starts), "first": right[starts[:-1]], "rights": _binary(right, starts)}

    # left classes are numbered from 0 and each has a list, so this is the least right class by their numbers
    own = starts_of(left[heads])[:-1]
    least, block = np.minimum.reduceat(lists["first"], own), lists["block"].take(pa.array(own))
    anchor, anchors = _mixed(block, pa.array(least))
    met = anchor[left] * len(ids) + place
    if anchors * len(ids) <= 8 * len(met):
        seen = np.zeros(anchors * len(ids), bool)
        seen[met] = True
        met = np.flatnonzero(seen)
    else:
        met = np.unique(met)
    starts, right = starts_of(met // len(ids)), ids[met % len(ids)]
    at = np.unique(anchor, return_index=True)[1]  # anchors are numbered from 0, too
    none = {"name_score": np.zeros(anchors), "street_score": np.zeros(anchors), "used_global": np.zeros(anchors, bool)}
    meets = {"block": block.take(pa.array(at)), "left_class": least[at], **none, "n": np.diff(starts), "first": right[starts[:-1]], "rights": _binary(right, starts)}
    both = [pa.table({"kind": pa.array(np.full(len(x["n"]), kind, np.int8)), **x}) for kind, x in ((LIST, lists), (MEETS, meets))]
    return pa.concat_tables(both)


def _pairs(files: Iterator[pa.RecordBatch], at_once: int) -> Iterator[pa.Table]:
    """The pairs in Parquet files; those of a class or block that is null are none."""
    known = ("block", "left_class", "right_class")
    for batch in files:
        for content in batch["content"]:
            with pq.ParquetFile(pa.BufferReader(content.as_buffer())) as file:
                for rows in file.iter_batches(at_once, columns=[*_SCORED, "right_class"]):
                    rows = pa.Table.from_batches([rows])
                    for c in known:
                        rows = rows.filter(rows[c].is_valid()) if rows[c].null_count else rows
                    yield rows


def _packed(files: Iterator[pa.RecordBatch], at_once: int) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for rows in _pairs(files, at_once):
        held.append(rows)
        n += rows.num_rows
        if n >= at_once:
            table = pa.concat_tables(held)
            cut = starts_of(ints(table, "left_class"))[-2] or n  # the last left class may go on
            yield from _pack(table.slice(0, cut)).combine_chunks().to_batches()
            held, n = [table.slice(cut)], n - cut
    if n:
        yield from _pack(pa.concat_tables(held)).combine_chunks().to_batches()


def packed(pairs: DataFrame) -> DataFrame:
    """``(kind, block, left_class, name_score, street_score, used_global, n, first, rights)``: lists of the pairs and meets,
    which have the least right class in place of the left one. A left class has several lists of a score where its pairs lie
    apart."""
    at_once = PAIRS_AT_ONCE
    return stored_files(pairs, "pairs").mapInArrow(lambda files: _packed(files, at_once), _LISTS)


def spread(lists: pa.Table, name: str) -> pa.Table:
    """A row for each right class of each list, as column ``name``; rows with ``n`` 0 vanish."""
    each = pa.array(np.repeat(np.arange(lists.num_rows), ints(lists, "n")))
    return lists.drop_columns(["n", "first", "rights"]).take(each).append_column(name, pa.array(rights(lists)))


def unpacked(lists: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and ``right_class``, one row for each right class of each list."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            parts = starts_of(np.cumsum(ints(table, "n")) // PAIRS_AT_ONCE)
            for start, end in zip(parts, parts[1:]):
                yield from spread(table.slice(start, end - start), "right_class").combine_chunks().to_batches()

    chosen = lists.select(*keep, "n", "first", "rights")
    schema = ", ".join(f"{c} {kind}" for c, kind in chosen.dtypes if c in keep)
    return chosen.mapInArrow(rows, f"{schema}, right_class bigint")
