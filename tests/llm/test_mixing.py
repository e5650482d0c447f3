from collections import Counter

import numpy as np
import pytest

from kinlink.llm import mixing


def test_temper_meets_its_targets():
    tokens = np.array([1000.0, 100.0, 10.0])
    plan = mixing.temper(tokens, target=0.8, most_repeats=None)
    assert mixing.entropy(plan.weights) == pytest.approx(0.8 * np.log(3), abs=1e-6)
    assert plan.repeats.min() == pytest.approx(1)
    plan = mixing.temper(tokens, target=0.95, most_repeats=3)
    assert plan.repeats.max() == pytest.approx(3, abs=1e-6)
    assert plan.weights == pytest.approx(tokens**plan.exponent / (tokens**plan.exponent).sum())
    assert mixing.temper(tokens, target=0.1, most_repeats=None).exponent == 1
    assert mixing.temper(np.array([5.0, 5.0])).exponent == 1
    with pytest.raises(ValueError):
        mixing.temper(tokens, most_repeats=1, budget=1e6)


def rows():
    out = [(i, " ".join(["w"] * (i % 17 + 1)), "big") for i in range(600)]
    out += [(1000 + i, " ".join(["v"] * (i % 5 + 1)), f"small{i % 3}") for i in range(120)]
    return out + [(2000 + i, "n n", None) for i in range(20)] + [(3000, None, "big"), (3001, "", "empty"), (3002, "long " * 3000, "small0")]


def taken(spark, table, **options):
    df = spark.createDataFrame(table, "doc_id long, text string, source string").selectExpr("*", "1 mix_epoch", "2 tokens", "3 before")
    return mixing.mixed_sources(df, **options).collect()


def brute(table, key_of, **options):
    """How often each row is taken, block by block in the order of the given places."""
    sizes = Counter()
    for _, text, source in table:
        sizes[source] += len((text or "").split())
    known = [s for s in sizes if sizes[s]]
    plan = mixing.temper(np.array([sizes[s] for s in known], float), **options)
    times = Counter()
    for s, repeats in zip(known, plan.repeats):
        own = sorted((r for r in table if r[2] == s and (r[1] or "").split()), key=lambda r: key_of[r[0]])
        whole = int(np.floor(repeats + 1e-9))
        left, before = (repeats - whole) * sizes[s], 0
        for r in own:
            times[r[0]] += whole
        for r in own:
            if left >= 1 and before < left:
                times[r[0]] += 1
            before += len(r[1].split())
    for r in table:
        if not (r[1] or "").split():
            times[r[0]] = 1
    return times


@pytest.mark.parametrize("options", [{}, {"target": 0.99, "most_repeats": 3.0}, {"target": None, "most_repeats": None, "budget": 4000}])
def test_equals_blocks_by_hand(spark, options):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows(), "doc_id long, text string, source string")
    place = F.shiftrightunsigned(F.xxhash64(F.lit(1), "doc_id", "text"), 1)
    key_of = {r[0]: r[1] for r in df.select("doc_id", place).collect()}
    got = Counter(r["doc_id"] for r in taken(spark, rows(), **options))
    assert +got == +brute(rows(), key_of, **options)
    if "budget" not in options:
        assert set(got) == {r[0] for r in rows()}  # every document is taken


def test_epochs_and_weights(spark):
    table = rows()[:-1]  # a text of thousands of words may overshoot a small source's budget by itself
    out = taken(spark, table, target=0.95, most_repeats=4.0)
    assert max(Counter((r["doc_id"], r["mix_epoch"]) for r in out).values()) == 1
    tokens = Counter()
    for r in out:
        tokens[r["source"]] += len((r["text"] or "").split())
    base = Counter()
    for _, t, s in table:
        base[s] += len((t or "").split())
    plan = mixing.temper(np.array([base[s] for s in sorted(base, key=str) if base[s]], float), 0.95, 4.0)
    want = dict(zip([s for s in sorted(base, key=str) if base[s]], plan.weights))
    total = sum(tokens.values())
    assert all(abs(tokens[s] / total - w) < 0.05 for s, w in want.items())


def test_empty_and_repeated_rows(spark):
    assert taken(spark, []) == []
    assert len(taken(spark, [(1, "a b", "s"), (1, "a b", "s")])) == 2
