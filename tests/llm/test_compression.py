import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinlink.llm import compression
from kinlink.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def text(rng, good):
    word = lambda: "".join(rng.choice(["ba", "de", "ki", "lo", "mu", "ne"]) for _ in range(rng.randint(1, 4)))
    return " ".join(word() + ("" if good else rng.choice(["!!", "$$"])) for _ in range(rng.randint(5, 400)))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    return [(i, text(rng, i % 3 > 0), int(i % 3 > 0)) for i in range(400)]


def tables(spark, rows):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").withColumns({n: F.lit("mine") for n in ("label", "pieces", "k")})
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int").withColumn("text", F.lit("mine"))
    return docs, labels


def test_held_out_accuracy_and_odd_texts(spark, rows):
    docs, labels = tables(spark, rows)
    classifier = compression.fit(docs, labels)
    odd = spark.createDataFrame([(1000, None), (1001, ""), (1002, "x"), (1003, "ba de " * 200_000), (None, "!!")], "doc_id long, text string")
    out = compression.scored(docs.unionByName(odd, allowMissingColumns=True).withColumn("score", F.lit("old")), classifier)
    got = {r["doc_id"]: r for r in out.withColumn("held", compression.held_out()).collect()}
    held = [(r[2], got[r[0]]["score"]) for r in rows if got[r[0]]["held"]]
    assert len(held) > 50 and np.mean([(s >= 0.5) == bool(y) for y, s in held]) >= 0.97
    assert all(r["held"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got.values())
    assert got[1000]["score"] == got[1001]["score"] == pytest.approx(classifier.share)
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[5]["k"] == "mine"


def test_held_out_labels_teach_nothing(spark, rows):
    turned = [(i, t, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, t, y in rows]
    first, second = (compression.fit(*tables(spark, r)) for r in (rows, turned))
    assert first.sizes.good == second.sizes.good and first.sizes.bad == second.sizes.bad
    assert first.weights.tolist() == second.weights.tolist() and first.bias == second.bias


def test_the_sample_is_bounded_for_repeated_rows_too(spark, rows):
    hot = [rows[1]] * 3000
    docs, labels = tables(spark, rows + hot)
    classifier = compression.fit(docs, labels.unionByName(labels), most_texts=20)
    again = compression.fit(*tables(spark, rows), most_texts=20)
    assert classifier.sizes.good == again.sizes.good and classifier.weights.tolist() == again.weights.tolist()


@pytest.mark.parametrize("kept,expected", [(lambda y: False, 0.5), (lambda y: y == 1, 1.0), (lambda y: y == 0, 0.0)])
def test_without_both_classes(spark, rows, kept, expected):
    docs, labels = tables(spark, rows[:30])
    known = labels.where(F.col("quality").isin([y for y in (0, 1) if kept(y)] or [7]))
    scores = {r["score"] for r in compression.scored(docs, compression.fit(docs, known)).collect()}
    assert len(scores) == 1 and scores.pop() == pytest.approx(expected, abs=1e-6)


def test_empty_tables_and_odd_labels(spark, rows):
    docs, labels = tables(spark, rows)
    assert compression.scored(docs.limit(0), compression.fit(docs.limit(0), labels)).count() == 0
    odd = spark.createDataFrame([(None, 1, "m"), (1, None, "m"), (2, 5, "m")], "doc_id long, quality int, text string")
    plain, with_odd = compression.fit(docs, labels), compression.fit(docs, labels.unionByName(odd))
    assert plain.weights.tolist() == with_odd.weights.tolist()


def test_sizes_are_of_the_whole_text():
    sizes = compression.Sizes(b"good words " * 50, b"BAD!! " * 50)
    whole = b"good words " * 400 + b"BAD!! " * 4000
    raw, good, bad = sizes.of(compression.cut(whole))
    assert raw == len(whole) and bad < good
    assert sizes.of(compression.cut(whole[:1000]))[1] < sizes.of(compression.cut(whole[:1000]))[2]


def test_query_on_the_given_tables(spark):
    out = QUERIES["op11_compression"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = out.join(labels, "doc_id", "left").collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    known = [r for r in rows if r["held_out"] and r["quality"] is not None]
    assert len(known) >= 50 and np.mean([r["predicted"] == r["quality"] for r in known]) >= 0.95
