"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Characters of text that a task turns into arrays at once.
SLICE_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces(column: pa.Array) -> Iterator[str | None]:
    """The values of an Arrow column, a thousand at a time as Python objects."""
    for start in range(0, len(column), 1_000):
        yield from column.slice(start, 1_000).to_pylist()


def slices(texts: Iterable[str], most: int = SLICE_CHARS, rows: int = 4_000) -> Iterator[list[str]]:
    """Runs of at most ``rows`` texts of about ``most`` characters; a longer text comes alone and whole."""
    run, size = [], 0
    for text in texts:
        if run and (size + len(text) > most or len(run) >= rows):
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: spreads every bit of ``values`` over all bits."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_RANDOM = np.random.default_rng(20240607)
_LETTER = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15 | 1
#: Bytes between words: white space only, or all of ASCII but letters and digits.
BLANKS = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
NOT_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


class HashedWords:
    """64-bit hashes of the words of a run of texts, A-Z lower-cased, and the text that each word belongs to.

    The hash of a word is a polynomial in a random value for each byte, so equal words have equal hashes whatever stands
    around them, and the hashes of all words (or of their first letters) come from a few array operations.
    """

    def __init__(self, texts: list[str], between: np.ndarray = BLANKS):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        sizes = np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw))
        letters = np.frombuffer(b" ".join(raw) + b" ", np.uint8) if raw else np.zeros(0, np.uint8)
        inside = ~between[letters]
        where = np.flatnonzero(inside)
        first = np.ones(len(where), bool)
        first[1:] = where[1:] != where[:-1] + 1
        self.starts = np.flatnonzero(first)
        self.lengths = np.diff(self.starts, append=len(where))
        self.place = np.arange(len(where)) - np.repeat(self.starts, self.lengths)
        with np.errstate(over="ignore"):
            self.values = _LETTER[letters[where]] * _powers(int(self.lengths.max(initial=1)))[self.place]
        self.text = np.searchsorted(np.cumsum(sizes), where[self.starts], side="right")
        self.n_texts = len(texts)

    def hashes(self, first: int | None = None, seed: int = 0) -> np.ndarray:
        """Hashes of the words, or of their first ``first`` bytes."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        values = self.values if first is None else np.where(self.place < first, self.values, np.uint64(0))
        return mixed(np.add.reduceat(values, self.starts), seed)
