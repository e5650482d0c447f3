import numpy as np
import pytest

from kinlink.llm import shards
from kinlink.storage import materialize


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation(n):
    out = shards.permuted(np.arange(n), n, key=5)
    assert sorted(out.tolist()) == list(range(n))
    if n > 100:
        assert (out != shards.permuted(np.arange(n), n, key=6)).mean() > 0.9
        assert abs(np.corrcoef(np.arange(n), out)[0, 1]) < 0.15


def stored(spark, documents, rows):
    return materialize(documents(rows), "test-documents")


def read_all(spark, done):
    return {r["slot"]: bytes(r["record"]) for r in shards.read_slots(spark, done, 0, done.n).collect()}


def back(index, held, width=1):
    """The bytes of each row, from the sequences that hold it."""
    out = {}
    for r in sorted(index, key=lambda r: r["piece"]):
        piece = held[r["slot"]][r["begin"] : r["begin"] + r["n_tokens"] * width]
        out[r["doc_id"]] = out.get(r["doc_id"], b"") + piece
    return out


def test_round_trip(spark, documents):
    rows = [(1, "abc\ndé日" * 40), (2, None), (3, ""), (4, "\n" * 99), (5, "y" * 64), (6, "z" * 20_000), (7, None), (None, "null id")]
    done = shards.write_shards(stored(spark, documents, rows), shards.text_bytes(), key=9, length=64, rows=50)
    index, held = done.index.collect(), read_all(spark, done)
    assert sorted(held) == list(range(done.n)) and {len(x) for x in held.values()} == {64}
    assert all(r["shard"] == r["slot"] // 50 and r["offset"] == r["slot"] % 50 * 65 for r in index)
    assert back(index, held) == {i: (t or "").encode() for i, t in rows}
    total = sum(len((t or "").encode()) for _, t in rows)
    assert total <= done.n * 64 < total + 64 * 9  # only a partition's last sequence is filled up


def test_repeated_rows_are_all_written(spark, documents):
    done = shards.write_shards(stored(spark, documents, [(1, "ab"), (1, "ab"), (1, None)]), shards.text_bytes(), key=9, length=4)
    held = read_all(spark, done)
    got = sorted(held[r["slot"]][r["begin"] : r["begin"] + r["n_tokens"]] for r in done.index.collect())
    assert got == [b"", b"ab", b"ab"]


def test_any_range_can_be_resumed(spark, documents):
    done = shards.write_shards(stored(spark, documents, [(i, f"text {i} " * 20) for i in range(60)]), shards.text_bytes(), key=1, length=16, rows=37)
    whole = read_all(spark, done)
    part = {r["slot"]: bytes(r["record"]) for r in shards.read_slots(spark, done, 30, 80).collect()}
    assert part == {s: whole[s] for s in range(30, 110)}
    assert shards.read_slots(spark, done, done.n, 5).count() == 0


def test_order_depends_on_the_key_only(spark, documents):
    table = stored(spark, documents, [(i, "t" * (i * 13 % 97)) for i in range(50)])
    slots = lambda key: sorted(map(tuple, shards.write_shards(table, shards.text_bytes(), key=key, length=16).index.select("doc_id", "piece", "slot").collect()))
    assert slots(3) == slots(3) != slots(4)


def test_wide_ids(spark):
    table = materialize(spark.createDataFrame([(1, [70_000, 2, 3]), (2, None)], "doc_id long, ids array<int>"), "test-ids")
    done = shards.write_shards(table, shards.packed("ids", 4), key=2, length=2, width=4)
    got = back(done.index.collect(), read_all(spark, done), 4)
    assert {i: np.frombuffer(x, "<u4").tolist() for i, x in got.items()} == {1: [70_000, 2, 3], 2: []}
    with pytest.raises(Exception, match="does not fit"):
        table.select(shards.packed("ids", 2)).collect()


def test_empty_table(spark, documents):
    done = shards.write_shards(stored(spark, documents, []), shards.text_bytes(), key=1)
    assert done.n == 0 and done.index.count() == 0 and shards.read_slots(spark, done, 0, 5).count() == 0
