"""Byte-level BPE: a contiguous array of adjacent ranks per short word, scanned for its minimum again and again.

A word is a row of a matrix of parts and a row of ranks of adjacent parts. Each step finds every row's least rank, fuses
those two parts, deletes the boundary between them by moving the rest of the row left, and looks up the two ranks beside
the new part. Words longer than ``SHORT`` bytes, for which scanning is quadratic, take a heap of the same ranks instead.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import cached_property
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinlink.llm.common import pieces, slices

#: Splits a text before the merges (fixed value of the public byte-level vocabularies).
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SHORT = 128
#: Words whose ids a task remembers; a full memory starts anew, which changes no result.
REMEMBERED = 150_000
ROWS_TOGETHER = 500  # rows whose ids leave a worker together
_NONE = np.int32(2**31 - 1)
DIGESTS = T.StructType([
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
])


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class Vocabulary:
    """Arrays made from a ``tokenizer.json``: small (a few MB), so it travels to the tasks as a broadcast."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"]
        if spec["normalizer"] or model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"]:
            raise ValueError("only byte-level BPE without normaliser and prefix space is supported")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take blanks or whole words are not supported")
        ids, symbols = model["vocab"], byte_symbols()
        byte_of = {s: b for b, s in enumerate(symbols)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*ids.values(), *self.special.values()]) + 1
        self.bytes = [b""] * size
        for token, i in ids.items():
            self.bytes[i] = bytes(map(byte_of.__getitem__, token))
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.first = np.array([ids[s] for s in symbols], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
        self.made = np.array([ids[a + b] for a, b in pairs], np.int32)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)

    @cached_property
    def known(self) -> dict[int, int]:
        return dict(zip(self.keys.tolist(), self.ranks.tolist()))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; ``_NONE`` where no merge exists or an id is negative."""
        wanted = left.astype(np.int64) << 32 | np.maximum(right, 0)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where((self.keys[at] == wanted) & (left >= 0) & (right >= 0), self.ranks[at], _NONE)

    def encode_rows(self, parts: np.ndarray) -> np.ndarray:
        """Merges each row of ids (filled up with -1) as far as it goes."""
        if parts.shape[1] < 2:
            return parts
        done, rows = parts.copy(), np.arange(len(parts))
        ranks, columns = self.rank(parts[:, :-1], parts[:, 1:]), np.arange(parts.shape[1] - 1)
        while len(rows):
            at = ranks.argmin(1)
            line = np.arange(len(rows))
            best = ranks[line, at]
            live = best != _NONE
            if not live.all():
                done[rows[~live], : parts.shape[1]] = parts[~live]
                done[rows[~live], parts.shape[1] :] = -1
                rows, parts, ranks, at, best = rows[live], parts[live], ranks[live], at[live], best[live]
                if not len(rows):
                    break
                line = np.arange(len(rows))
            parts[line, at] = self.made[best]
            if parts.shape[1] == 2:
                done[rows, 0], done[rows, 1:] = parts[:, 0], -1
                break
            columns = columns[:-1]
            later = columns[None, :] >= at[:, None]  # the boundary goes; what follows moves left
            parts = np.concatenate([parts[:, :1], np.where(later, parts[:, 2:], parts[:, 1:-1])], 1)
            ranks = np.where(later, ranks[:, 1:], ranks[:, :-1])
            here = at < ranks.shape[1]
            ranks[line[here], at[here]] = self.rank(parts[line[here], at[here]], parts[line[here], at[here] + 1])
            back = at > 0
            ranks[line[back], at[back] - 1] = self.rank(parts[line[back], at[back] - 1], parts[line[back], at[back]])
        return done

    def encode_long(self, word: bytes) -> np.ndarray:
        """The same merges for one long word in n log n steps: a heap of (rank, place) over linked parts."""
        ids = self.first[np.frombuffer(word, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        found = self.rank(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(r, i) for i, r in enumerate(found) if r != _NONE]
        heapq.heapify(heap)
        known = self.known
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else len(ids)
            if j >= len(ids) or known.get(ids[i] << 32 | ids[j]) != rank:
                continue  # one of the two has changed since
            ids[i], ids[j] = int(self.made[rank]), -1
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
                if (r := known.get(ids[i] << 32 | ids[after[i]])) is not None:
                    heapq.heappush(heap, (r, i))
            if (b := before[i]) >= 0 and (r := known.get(ids[b] << 32 | ids[i])) is not None:
                heapq.heappush(heap, (r, b))
        return np.array([i for i in ids if i >= 0], np.int32)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit integers. Words of like length share a matrix."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        out: list[bytes] = [b""] * len(raw)
        for i in np.flatnonzero(lengths > SHORT):
            out[i] = self.encode_long(raw[i]).tobytes()
        order = np.argsort(lengths, kind="stable")
        order = order[lengths[order] <= SHORT]
        start = 0
        while start < len(order):
            wide = int(lengths[order[start]])
            limit = wide if wide <= 16 else wide + 8
            end = int(np.searchsorted(lengths[order], limit, side="right"))
            end = min(end, start + max(1, 2_000_000 // max(limit, 1)))
            group = order[start:end]
            own = lengths[group]
            flat = self.first[np.frombuffer(b"".join([raw[i] for i in group]), np.uint8)]
            inside = np.arange(max(int(own.max()), 1))[None, :] < own[:, None]
            parts = np.full(inside.shape, -1, np.int32)
            parts[inside] = flat
            done = self.encode_rows(parts)
            kept = done >= 0
            packed, ends = done[kept].tobytes(), np.cumsum(kept.sum(1)) * 4
            begin = 0
            for i, stop in zip(group.tolist(), ends.tolist()):
                out[i] = packed[begin:stop]
                begin = stop
            start = end
        return out


class Encoder:
    """Encodes texts; remembers words within bounds."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.memory = vocabulary, {}
        self.split = regex.compile(WORDS).findall
        found = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, found)) + ")") if found else None

    def pieces(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return self.split(text)
        out = []
        for part in self.special.split(text):
            out += [part] if part in self.vocabulary.special else self.split(part)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        pieces = [self.pieces(t) for t in texts]
        wanted = set().union(*pieces)
        if len(self.memory) + len(wanted) > REMEMBERED:
            self.memory = {w: self.memory[w] for w in wanted if w in self.memory}
        special = self.vocabulary.special
        new = [w for w in wanted if w not in self.memory and w not in special]
        self.memory.update(zip(new, self.vocabulary.encode_words(new)))
        self.memory.update({w: np.int32(i).tobytes() for w, i in special.items() if w in wanted})
        get = self.memory.__getitem__
        return [b"".join(map(get, p)) for p in pieces]


def load(spark: SparkSession, path: str):
    """The vocabulary of the file ``path`` on the driver, as a broadcast (its size is the vocabulary's, not the data's)."""
    return spark.sparkContext.broadcast(Vocabulary(path))


def decoded(ids: str | Column, vocabulary) -> Column:
    """Texts of token ids, added tokens kept; null is empty; bytes that are no UTF-8 become U+FFFD. Unknown ids raise."""

    @F.arrow_udf(T.StringType())
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        get = vocabulary.value.bytes.__getitem__
        for batch in batches:
            out = []
            for one in batch:
                values = one.values.to_pylist() if one.is_valid else []
                if values and min(values) < 0:
                    raise ValueError("token ids are not negative")
                out.append(b"".join(map(get, values)).decode("utf-8", "replace"))
            yield pa.array(out, pa.string())

    return texts(ids)


def digests(text: str | Column, vocabulary) -> Column:
    """Struct of n_tokens, ids_sha256 and decoded_sha256: a text's ids and what they decode to, without moving either.

    One Python worker does both ways for a run of texts at a time; two functions in a row would hold two workers a task.
    """

    @F.arrow_udf(DIGESTS)
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(vocabulary.value)
        get = vocabulary.value.bytes.__getitem__
        for batch in batches:
            counts, of_ids, of_texts = [], [], []
            for run in slices((t or "" for t in pieces(batch)), 1_000_000):
                for packed in encoder.encode(run):
                    ids = np.frombuffer(packed, np.int32).tolist()
                    back = b"".join(map(get, ids)).decode("utf-8", "replace")
                    counts.append(len(ids))
                    of_ids.append(sha256(",".join(map(str, ids)).encode()).hexdigest())
                    of_texts.append(sha256(back.encode()).hexdigest())
            parts = [pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_texts, pa.string())]
            yield pa.StructArray.from_arrays(parts, DIGESTS.fieldNames())

    return digest(text)


def encode_table(
    df: DataFrame, vocabulary, text: str = "text", into: str = "token_ids", keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` of ``df`` (all by default) and the token ids of each whole text (replacing a column ``into``).

    Ids leave the worker a few hundred rows at a time, so that neither it nor the JVM holds those of a whole batch.
    """
    columns = [c for c in (df.columns if keep is None else keep) if c != into]
    source = df.select(F.col(f"`{text}`").alias("_text"), *(F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(columns)))
    fields = [T.StructField(f"_{i}", source.schema[f"_{i}"].dataType) for i in range(len(columns))]
    names = [f.name for f in fields]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary.value)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_TOGETHER):
                part = batch.slice(start, ROWS_TOGETHER)
                packed = [x for run in slices((t or "" for t in pieces(part.column(0))), 1_000_000) for x in encoder.encode(run)]
                ends = pa.array(np.cumsum([0, *(len(x) // 4 for x in packed)]).astype(np.int32))
                ids = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(packed), np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], ids], [*names, "ids"])

    out = source.mapInArrow(encode, T.StructType([*fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, columns)), F.col("ids").alias(into))
