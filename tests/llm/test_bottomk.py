import random

import pytest
from pyspark.sql import functions as F

from kinlink.llm import bottomk


def shingles(text, width=bottomk.WIDTH):
    w = (text or "").lower().split()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def alike(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    return [" ".join(rng.choice("abcdefghij") + str(rng.randint(0, 9)) for _ in range(rng.randint(0, 900))) for _ in range(60)]


def edited(rows):
    """(doc_id, text, edited text, next text) in the order of the contract."""
    order = sorted(rows, key=lambda r: -r[0])
    out = []
    for i, (key, text) in enumerate(order):
        following = order[(i + 1) % len(order)][1] or ""
        text, half = text or "", len(text or "") // 2
        out.append((key, text, text[: len(text) - half] + following[:half], following))
    return sorted(out)


@pytest.mark.parametrize("rows_of_a_stretch", [3, 1000])
def test_edited_texts_and_likeness(documents, texts, rows_of_a_stretch):
    rows = [(i * 7 - 100, t) for i, t in enumerate(texts)] + [(900, None), (901, ""), (902, "é日" * 9), (903, "one two")]
    df = bottomk.fingerprints(documents(rows), rows=rows_of_a_stretch)
    got = sorted(
        df.select("doc_id", "text", "edited", bottomk.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("e"), bottomk.resemblance(F.col("sketch"), F.col("next_sketch")).alias("n")).collect()
    )
    want = edited(rows)
    assert [tuple(g[:3]) for g in got] == [w[:3] for w in want]
    for g, (_, text, other, following) in zip(got, want):
        assert abs(g["e"] - alike(shingles(text), shingles(other))) < 0.2
        assert abs(g["n"] - alike(shingles(text), shingles(following))) < 0.2


def test_repeated_null_single_and_no_rows(documents):
    out = bottomk.fingerprints(documents([(1, "a b c"), (1, "a b c"), (None, "x y"), (None, None)]), rows=1).collect()
    assert len(out) == 4
    one = bottomk.fingerprints(documents([(5, "abcdef")])).collect()
    assert [(r["edited"], r["doc_id"]) for r in one] == [("abcabc", 5)]
    assert bottomk.fingerprints(documents([])).count() == 0


def test_estimates_are_exact_for_small_sets(spark):
    a, b = "a b c d e f g", "c d e f g h i j"
    df = spark.createDataFrame([(a, b)], "a string, b string").select(bottomk.sketch(F.col("a")).alias("x"), bottomk.sketch(F.col("b")).alias("y"))
    row = df.select(bottomk.resemblance(F.col("x"), F.col("y")), bottomk.containment(F.col("x"), F.col("y")), bottomk.distinct_count(F.col("x"))).first()
    s, t = shingles(a), shingles(b)
    assert row[0] == pytest.approx(alike(s, t)) and row[1] == pytest.approx(len(s & t) / len(s)) and row[2] == len(s)


def test_large_sets_are_estimated(spark):
    words = [f"w{i}" for i in range(20_000)]
    df = spark.createDataFrame([(" ".join(words), " ".join(words[:10_000]))], "a string, b string")
    df = df.select(bottomk.sketch(F.col("a")).alias("x"), bottomk.sketch(F.col("b")).alias("y"))
    row = df.select(bottomk.distinct_count(F.col("x")), bottomk.resemblance(F.col("x"), F.col("y")), bottomk.containment(F.col("y"), F.col("x"))).first()
    assert abs(row[0] / 19_996 - 1) < 0.3 and abs(row[1] - 0.5) < 0.2 and row[2] > 0.7


def test_parts_merge_to_the_whole(spark, texts):
    whole = " ".join(texts[:20])
    words = whole.split()
    parts = [" ".join(words[max(0, i - 4) : i + 50]) for i in range(0, len(words), 50)]
    df = spark.createDataFrame([(i % 2, p) for i, p in enumerate(parts)], "g int, text string").withColumn("s", bottomk.sketch(F.col("text")))
    merged = bottomk.merge_sketches(df.withColumn("all", F.lit(1)), ["all"], "s").first()["s"]
    want = spark.createDataFrame([(whole,)], "t string").select(bottomk.sketch(F.col("t"))).first()[0]
    assert merged == want
