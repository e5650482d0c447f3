"""Training order on disk: a keyed Feistel permutation gives every sequence a global slot, and shards hold slots in order.

Texts become tokens of fixed width, tokens are packed end to end into sequences of fixed length, and sequences are numbered
0 .. n - 1 in the order of the stored table. The permutation works on the next even power of two; numbers that leave the range walk on along
their cycle until they return, so it is a permutation of exactly 0 .. n - 1 that needs no table. Slots are cut into ranges,
and each range is one file of records of fixed stride, so slot s is found by arithmetic, and a reader resumes anywhere.

Files come from Spark's own text writer: a record is a sequence and a line end. A retried task writes the same file.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinlink.llm.common import mixed, pieces
from kinlink.storage import shared_dir

ROUNDS = 6


def permuted(numbers: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slots of ``numbers``, all below ``n``: a balanced Feistel network with cycle-walking."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    out = np.asarray(numbers).astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> half, x & mask
        for i in range(ROUNDS):
            left, right = right, left ^ (mixed(right, key * ROUNDS + i) & mask)
        x = left << half | right
        out[todo] = x
        todo = todo[x >= np.uint64(n)]
    return out.astype(np.int64)


def packed(ids: str | Column, width: int) -> Column:
    """Token ids as little-endian numbers of ``width`` bytes (1, 2 or 4). Null is empty; ids that don't fit raise."""
    kind = {1: np.uint8, 2: np.dtype("<u2"), 4: np.dtype("<u4")}[width]

    @F.arrow_udf(T.BinaryType())
    def pack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for row in pieces(batch):
                values = np.array(row or (), np.int64)
                if len(values) and (values.min() < 0 or values.max() > np.iinfo(kind).max):
                    raise ValueError(f"a token id does not fit into {width} bytes")
                out.append(values.astype(kind).tobytes())
            yield pa.array(out, pa.binary())

    return pack(ids)


def text_bytes(text: str = "text") -> Column:
    """A text's UTF-8 bytes: tokens of a vocabulary of 256, of width 1. Null is empty."""
    return F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b""))


@dataclass
class Shards:
    path: str
    n: int
    bytes: int  # of a sequence, without the line end
    rows: int  # slots of a shard
    index: DataFrame  # doc_id, piece, n_tokens, begin (bytes into the sequence), slot, shard, offset (of the record)


def _sequences(size: int):
    """Cuts a partition's payloads, end to end, into (part, number, record); the last record is filled up with zeros."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, rest, rows = TaskContext.get().partitionId(), 0, b"", 0

        def made(data: bytes) -> pa.RecordBatch:
            n = len(data) // size
            ends = pa.py_buffer(np.arange(0, (n + 1) * size, size, dtype=np.int32).tobytes())
            records = pa.Array.from_buffers(pa.binary(), n, [None, ends, pa.py_buffer(data)])
            numbers = pa.array(np.arange(number, number + n), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([part] * n, pa.int32()), numbers, records], ["part", "number", "record"])

        for batch in batches:
            rows += batch.num_rows
            for run in range(0, batch.num_rows, 1_000):
                data = b"".join([rest, *batch.column(0).slice(run, 1_000).to_pylist()])
                whole = len(data) // size * size
                rest = data[whole:]
                if whole:
                    yield made(data[:whole])
                    number += whole // size
        if rest or (rows and not number):
            yield made(rest.ljust(size, b"\x00"))

    return cut


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to (doc_id, held) the partition and where each row's bytes begin in its stream."""
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        held = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        starts = at + np.cumsum(held) - held
        at += int(held.sum())
        more = [pa.array([part] * batch.num_rows, pa.int32()), pa.array(starts, pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *more], ["doc_id", "held", "part", "start"])


def write_shards(docs: DataFrame, payload: Column, key: int, length: int = 512, width: int = 1, rows: int = 32_768, path: str | None = None, doc_id: str = "doc_id") -> Shards:
    """Packs the rows' tokens into sequences of ``length``, permutes all sequences and writes them and their index.

    Rows follow each other without gaps inside a partition of ``docs``, so only a partition's last sequence is filled up
    with zero bytes. ``docs`` is a stored table: its partitions and their order number the sequences, so they must be the
    same when read again. The index names, for each row, the sequences that hold it; a row without tokens has one entry of
    length 0. Nothing is dropped. An empty table gives an index without rows and no shard.
    """
    spark = docs.sparkSession
    size = length * width
    path = path or f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}"
    rows_of = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), payload.alias("payload"))
    held = F.octet_length("payload").cast("long")
    sums = rows_of.groupBy(F.spark_partition_id().alias("part")).agg(F.sum(held).alias("held"))
    sums = sums.select("part", F.greatest(F.ceil(F.col("held") / size), F.lit(1)).alias("sequences")).persist()
    n = sums.agg(F.sum("sequences")).first()[0] or 0
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each partition of the input: as few as its splits
    offsets = F.broadcast(sums.select("part", "sequences", F.coalesce(F.sum("sequences").over(earlier), F.lit(0)).alias("before")))

    @F.arrow_udf(T.LongType())
    def slot_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(permuted(batch.to_numpy(zero_copy_only=False), n, key))

    shard = F.expr(f"cast(slot div {rows} as int)")
    if n:
        cut = rows_of.select("payload").mapInArrow(_sequences(size), "part int, number long, record binary")
        placed = cut.join(offsets, "part").select(slot_of(F.col("before") + F.col("number")).alias("slot"), "record")
        records = placed.select(shard.alias("shard"), "slot", F.col("record").cast("string").alias("record"))
        parts = max(1, min(-(-n // rows), 100_000))
        dealt = records.repartition(parts, "shard").sortWithinPartitions("shard", "slot")
        dealt.select("shard", "record").write.partitionBy("shard").text(f"{path}/shards")
    kind = rows_of.schema["doc_id"].dataType.simpleString()
    streams = rows_of.select("doc_id", held.alias("held")).mapInArrow(_places, f"doc_id {kind}, held long, part int, start long")
    first = F.least(F.expr(f"start div {size}"), F.col("sequences") - 1)
    last = F.greatest(first, F.expr(f"(start + held - 1) div {size}"))
    pieces_of = streams.join(offsets, "part").select("*", F.posexplode(F.sequence(first, last)).alias("piece", "number"))
    begin = F.greatest(F.col("start") - F.col("number") * size, F.lit(0))
    end = F.least(F.col("start") + F.col("held") - F.col("number") * size, F.lit(size))
    index = pieces_of.select(
        "doc_id", "piece", ((end - begin) / width).cast("int").alias("n_tokens"),
        F.least(begin, F.lit(size)).cast("int").alias("begin"), slot_of(F.col("before") + F.col("number")).alias("slot"),
    )
    index.write.parquet(f"{path}/index")
    sums.unpersist()
    stored = spark.read.schema(index.schema).parquet(f"{path}/index")
    # shard and offset follow from the slot, so they take no room
    stored = stored.withColumns({"shard": shard, "offset": F.expr(f"slot % {rows}") * (size + 1)})
    return Shards(path, n, size, rows, stored)


def read_slots(spark: SparkSession, shards: Shards, first: int, count: int) -> DataFrame:
    """(slot, record) of ``count`` slots from ``first`` on, read from the shards that hold them."""
    last = min(first + count, shards.n) - 1
    if first > last:
        return spark.createDataFrame([], "slot long, record binary")
    wanted = [f"{shards.path}/shards/shard={k}" for k in range(first // shards.rows, last // shards.rows + 1)]
    files = spark.read.format("binaryFile").load(wanted)
    shard = F.regexp_extract("path", r"/shard=(\d+)/", 1).cast("long")
    start = F.greatest(shard * shards.rows, F.lit(first))
    stop = F.least((shard + 1) * shards.rows - 1, F.lit(last))
    at = lambda s: (s - shard * shards.rows).cast("int") * (shards.bytes + 1) + 1
    rows = F.transform(F.sequence(start, stop), lambda s: F.struct(s.alias("slot"), F.substring("content", at(s), F.lit(shards.bytes)).alias("record")))
    return files.select(F.inline(rows))
