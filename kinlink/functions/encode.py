"""Text encoders: a text in, a vector of fixed length out."""

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Encoder = Callable[[list[str]], np.ndarray]

DIMENSIONS = 256
_CHARACTERS = 250_000  # of texts whose windows are laid out at once; a longer text comes alone
_TEXTS = 1024  # encoded at once


@lru_cache(maxsize=200_000)
def _slot(gram: str) -> int:
    return hashlib.md5(gram.encode("utf-8", "surrogatepass")).digest()[0]


def _trigram_counts(texts: list[str]) -> np.ndarray:
    """Counts by place. Each distinct trigram is hashed once; windows and counts are array operations."""
    padded = [f"  {text} " for text in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    lengths = np.fromiter(map(len, padded), np.int64, len(padded))
    rows = np.repeat(np.arange(len(padded)), lengths)
    inside = rows[:-2] == rows[2:]  # windows do not reach over the end of a text
    grams = ((codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:])[inside]
    distinct, which = np.unique(grams, return_inverse=True)
    letters = lambda g: chr(g >> 42) + chr(g >> 21 & 0x1FFFFF) + chr(g & 0x1FFFFF)
    slots = np.fromiter((_slot(letters(g)) for g in distinct.tolist()), np.int64, len(distinct))
    places = rows[:-2][inside] * DIMENSIONS + slots[which]
    return np.bincount(places, minlength=len(padded) * DIMENSIONS).reshape(len(padded), DIMENSIONS)


def hashed_trigrams(texts: list[str]) -> np.ndarray:
    """Counts of character trigrams, hashed to 256 places and scaled to length one; needs no model file."""
    out = np.zeros((len(texts), DIMENSIONS), dtype=np.float64)
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (end == start or size + len(texts[end]) <= _CHARACTERS):
            size += len(texts[end])
            end += 1
        out[start:end] = _trigram_counts(texts[start:end])
        start = end
    norms = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return (out / np.where(norms > 0, norms, 1.0)).astype(np.float32)


def encode_distinct(texts: DataFrame, column: str, make_encoder: Callable[[], Encoder] | None = None) -> DataFrame:
    """One vector per distinct non-null text: ``(column, vector)``.

    ``make_encoder`` runs once per task, so a model is loaded there; it is fed up to 1,024 texts at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make_encoder() if make_encoder else hashed_trigrams
        for batch in batches:
            for start in range(0, batch.num_rows, _TEXTS):
                some = batch.column(0).slice(start, _TEXTS)
                vectors = np.ascontiguousarray(encode(some.to_pylist()), dtype=np.float32)
                ends = pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1])
                lists = pa.ListArray.from_arrays(ends, pa.array(vectors.reshape(-1)))
                yield pa.RecordBatch.from_arrays([some, lists], names=[column, "vector"])

    distinct = texts.select(column).where(F.col(column).isNotNull()).distinct()
    return distinct.mapInArrow(run, f"`{column}` string, vector array<float>")
