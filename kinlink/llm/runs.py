"""Periodic runs of words, found by a dictionary of basic factors.

A run is a stretch of words with smallest period q, at least ``LEAST_REPEATS`` periods and ``LEAST_WORDS`` words long, that
cannot be made longer on either side.

The dictionary names, for each power of two, the factors of that many words: equal factors of a text have equal names, and
a factor of 2m words is named by the names of its halves. Within a window of twice their length the occurrences of a
factor form an arithmetic progression, and its difference is a period of what it covers. So for each length m the distance
of every factor to its successor, if that is at most m, proposes a period, and neighbouring places with the same distance
are one stretch. A period q in (m / 2, m] is proposed at length m: a factor that covers a whole period cannot come back
sooner, so every place of a run but the last q + m words proposes q and no multiple of it. Periods up to m / 2 have been
proposed at a smaller length; the few that are proposed again are dropped as duplicates.

Only factors that occur again in the same text are carried to the next length, so texts without repeats cost a few sorts.
Texts of a task are treated many at a time as one array of words; a text of any length is one of them, whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinlink.llm.common import pieces, slices

LEAST_WORDS, LEAST_REPEATS = 6, 4
_RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
_FOUND = T.StructType().add("n_words", T.LongType()).add("runs", T.ArrayType(_RUN)).add("collapsed", T.StringType())


def find_runs(names: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Runs as rows (start, length, period), ordered by start and period.

    ``names`` are the words of all texts as numbers, equal in two texts only by chance or not at all; ``ends`` is for each
    word the end of its own text, so that no factor reaches into the next one.
    """
    n = len(names)
    at = np.arange(n)
    key = names.astype(np.int64)
    found = [np.zeros((0, 3), np.int64)]
    m = 1
    while len(at):
        order = np.argsort(key, kind="stable")
        place, sorted_key = at[order], key[order]
        again = np.zeros(len(at) + 1, bool)
        again[1:-1] = sorted_key[1:] == sorted_key[:-1]
        step = np.diff(place)
        near = again[1:-1] & (step <= m) & (2 * step > m)
        found.append(_stretches(place[:-1][near], step[near], m, ends))
        kept = again[1:] | again[:-1]  # factors that occur more than once
        number = np.cumsum(~again[:-1])
        dense = np.full(n, -1, np.int64)
        dense[place[kept]] = number[kept]
        at = np.flatnonzero(dense >= 0)
        at = at[at + 2 * m <= ends[at]]
        at = at[dense[at + m] >= 0]
        key = dense[at] * (n + 1) + dense[at + m]
        m *= 2
    return np.unique(np.concatenate(found), axis=0)[:, [0, 2, 1]]


def _stretches(place: np.ndarray, step: np.ndarray, m: int, ends: np.ndarray) -> np.ndarray:
    """(start, period, length) of the stretches that neighbouring places with one distance make up."""
    order = np.lexsort((place, step))
    place, step = place[order], step[order]
    text = ends[place]
    first = np.ones(len(place), bool)
    first[1:] = (place[1:] != place[:-1] + 1) | (step[1:] != step[:-1]) | (text[1:] != text[:-1])
    starts = np.flatnonzero(first)
    places = np.diff(starts, append=len(place))
    start, period = place[starts], step[starts]
    length = places - 1 + period + m  # the last factor and its successor belong to the stretch
    long = length >= np.maximum(LEAST_WORDS, LEAST_REPEATS * period)
    return np.column_stack([start, period, length])[long]


def _numbered(texts: list[str]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, their numbers (never the same in two texts), the first word's place and each word's end."""
    words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    numbers, used = np.zeros(int(sizes.sum()), np.int64), 0
    starts = np.concatenate([[0], np.cumsum(sizes)])
    for own, start in zip(words, starts.tolist()):
        known: dict[bytes, int] = {}
        numbers[start : start + len(own)] = [known.setdefault(w, len(known)) for w in own]
        numbers[start : start + len(own)] += used
        used += len(known)
    return words, numbers, starts, np.repeat(starts[1:], sizes)


def runs_of(texts: list[str]) -> list[tuple[int, np.ndarray, bytes]]:
    """Of each text the number of words, its runs and its words without repeats, joined by one blank."""
    words, numbers, starts, ends = _numbered(texts)
    found = find_runs(numbers, ends)
    owner = np.searchsorted(starts, found[:, 0], side="right") - 1
    found[:, 0] -= starts[owner]
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for i, own in enumerate(words):
        mine = found[cuts[i] : cuts[i + 1]]
        kept = own
        if len(mine):
            depth = np.zeros(len(own) + 1, np.int64)
            np.add.at(depth, mine[:, 0] + mine[:, 2], 1)
            np.add.at(depth, mine[:, 0] + mine[:, 1], -1)
            kept = [own[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]
        out.append((len(own), mine, b" ".join(kept)))
    return out


@F.arrow_udf(_FOUND)
def _found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        done = [x for run in slices((t or "" for t in pieces(batch)), 2_000_000) for x in runs_of(run)]
        counts, runs, texts = zip(*done) if done else ((), (), ())
        flat = np.concatenate([*runs, np.zeros((0, 3), np.int64)])
        columns = [pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)]
        bounds = pa.array(np.cumsum([0, *map(len, runs)]).astype(np.int32))
        listed = pa.ListArray.from_arrays(bounds, pa.StructArray.from_arrays(columns, _RUN.names))
        collapsed = pa.array(texts, pa.binary()).cast(pa.string())
        yield pa.StructArray.from_arrays([pa.array(counts, pa.int64()), listed, collapsed], _FOUND.names)


def periodic_runs(docs: DataFrame, text: str | Column = "text", into: str = "found") -> DataFrame:
    """``docs`` with a struct column ``into``: ``n_words``, ``runs`` (start, length, period; by start, then period) and
    ``collapsed``, the words that no run contains after its first period, joined by one blank.

    Words are what ASCII white space separates. A null or empty text has no words, no runs and an empty collapsed text.
    Every row is treated for itself, so repeated rows and ids are no matter; all columns stay (one named ``into`` is
    replaced).
    """
    source = F.col(f"`{text}`") if isinstance(text, str) else text
    return docs.withColumn(into, _found(source))


def longest(runs: str) -> Column:
    """The run of greatest length, of several the one with smallest start, then period; null without runs."""
    better = "r.length > b.length"  # runs come by start, then period, so the first of equals stays
    return F.expr(f"aggregate({runs}, get({runs}, 0), (b, r) -> if({better}, r, b))")


def listed(runs: str) -> Column:
    """Every run as a line ``start,length,period``."""
    return F.expr(f"array_join(transform({runs}, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")


@F.arrow_udf(T.StringType())
def _planted(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, checks in batches:
        out = []
        for text, h in zip(pieces(texts), pieces(checks)):
            if text and h is not None and h % 10 == 0 and (words := text.encode("utf-8", "surrogatepass").split()):
                n, g = len(words), h // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                words[a:] = [words[a + i % p] for i in range(n - a)]
                text = b" ".join(words).decode("utf-8", "surrogatepass")
            out.append(text)
        yield pa.array(out, pa.string())


def with_planted_period(text: str = "text", doc_id: str = "doc_id") -> Column:
    """The text, for one document in ten with its words made periodic from a place on that its id decides.

    With h the CRC-32 of the id in decimal and g = h div 10, where h is divisible by 10 and there are n words, each word
    i >= a becomes word a + (i - a) mod p, where a = g mod n and p = 1 + (n - a) div (3 + g mod 8). A text without an id
    stays as it is.
    """
    return _planted(F.col(f"`{text}`"), F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")))
