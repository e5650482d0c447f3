import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from kinlink.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(docs, items, k):
    """(item_id, rank, doc_id, score) by the formula, document by document."""
    counted = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_all = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in counted:
            m = 10 + 90 * sum(c.values()) * n_docs // n_all
            score = 0
            for t in set(TERM.findall((text or "").translate(LOWER))) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, doc is not None, doc or 0, doc))
        found.sort(key=lambda f: f[:3])
        out += [(item, rank + 1, f[3], -f[0]) for rank, f in enumerate(found[:k])]
    return sorted(out, key=repr)


def searched(index, items, **options):
    return sorted((tuple(r) for r in lexical.search(index, items, **options).collect()), key=repr)


def texts(rng, n, longest, vocabulary=40):
    return [" ".join(f"w{min(int(rng.paretovariate(0.7)), vocabulary)}" for _ in range(rng.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("postings,terms", [(50, 20), (400, 10_000), (10**6, 10**6)])
def test_equals_brute_force_for_any_blocks_and_groups(spark, documents, postings, terms):
    rng = random.Random(postings)
    docs = [(i * 3 - 50, t) for i, t in enumerate(texts(rng, 150, 30))]
    docs += [(1000, None), (1001, ""), (1002, "--- !"), (None, "W1 w2"), (7, "w1 w39"), (7, "w1 w39"), (1003, "É é w5 Straße_w6")]
    items = list(enumerate(texts(rng, 25, 12))) + [(90, "straße É nowhere"), (91, None), (92, "..."), (93, "unknown"), (None, "w1")]
    index = lexical.build(documents(docs), block_postings=postings)
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS term", "1 AS rank")
    assert searched(index, table, k=6, query_terms=terms) == brute(docs, items, 6)


def test_ties_rank_by_id(spark, documents):
    index = lexical.build(documents([(i, "same words here") for i in range(40, 0, -1)] + [(99, "other")]), block_postings=12)
    got = searched(index, spark.createDataFrame([(1, "words")], "item_id long, text string"), k=10)
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == list(range(1, 11)) and len({r[3] for r in got}) == 1


def test_strata_beyond_the_bound_are_not_read():
    ms = np.repeat(np.arange(10, 1010), 5)
    ids = np.arange(5000)
    block = lexical.Block(ids, ms, [(np.arange(5000), np.ones(5000, int)), (np.arange(0, 5000, 7), np.ones(715, int))])
    places, scores = block.best(np.array([0, 1]), np.array([5, 9]), 3)
    every = 5 * lexical.impact(np.ones(5000, int), ms)
    every[::7] += 9 * lexical.impact(np.ones(715, int), ms[::7])
    best = np.sort(every)[::-1][:3]
    assert scores[:3].tolist() == best.tolist() and every[places].tolist() == scores.tolist()
    assert len(block.impacts) == 5715 and len(np.unique(block.impacts[:5000])) <= 1000


def test_no_rows(spark, documents):
    items = spark.createDataFrame([(1, "words")], "item_id long, text string")
    assert searched(lexical.build(documents([])), items) == []
    assert searched(lexical.build(documents([(1, None), (2, "!")])), items) == []
    assert searched(lexical.build(documents([(1, "words")])), items.limit(0)) == []


def test_a_long_document(spark, documents):
    docs = [(1, "a b " * 300_000), (2, "b c"), (3, "a")]
    index = lexical.build(documents(docs))
    items = [(1, "a c"), (2, "b")]
    assert searched(index, spark.createDataFrame(items, "item_id long, text string")) == brute(docs, items, 10)
