import random
import re
from itertools import combinations

import numpy as np

from kinlink.llm import minhash
from kinlink.llm.components import components


def words(text):
    lower = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def shingles(text, width):
    w = words(text or "")
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute(rows, width):
    sets = [(i, shingles(t, width)) for i, t in rows]
    above = {i: i for i, _ in sets}

    def find(x):
        while above[x] != x:
            x = above[x]
        return x

    for (i, a), (j, b) in combinations(sets, 2):
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            x, y = find(i), find(j)
            above[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets)


def families(rng, n):
    rows = []
    for _ in range(n):
        base = [rng.choice("abcdefgh") + str(rng.randint(0, 99)) for _ in range(rng.randint(1, 60))]
        for _ in range(rng.randint(1, 6)):
            own = [w if rng.random() > 0.03 else "new" + str(rng.randint(0, 999)) for w in base]
            rows.append((len(rows) + 10, rng.choice([" ", "\n", "  "]).join(own)))
    rng.shuffle(rows)
    return rows


def check(documents, rows, width):
    out = minhash.near_duplicates(documents(rows), width=width)
    got = out.collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute(rows, width)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_equals_brute_force(documents):
    edges = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE  two"), (8, "x " * 30_000)]
    rows = edges + families(random.Random(1), 30)
    check(documents, rows, 2)
    check(documents, rows, 5)


def test_chains_of_links_and_hot_buckets(documents):
    base = [f"w{i}" for i in range(200)]
    chain = [(i, " ".join(base[: 150 - 4 * i] + [f"c{i}"] * 0 + base[160:])) for i in range(12)]
    copies = [(100 + i, " ".join(base[:100])) for i in range(30)]
    near = [(200 + i, " ".join(base[:100] + [f"z{i}", f"y{i}"])) for i in range(40)]
    check(documents, chain + copies + near, 2)


def test_empty_table_and_null_ids(documents):
    assert minhash.near_duplicates(documents([])).count() == 0
    rows = minhash.near_duplicates(documents([(None, "a b c d e f"), (None, "a b c d e f"), (9, None), (9, "q r s")])).collect()
    assert len(rows) == 4
    assert all(r["kept"] for r in rows)


def test_tiles_find_what_stars_do_not(spark, documents, monkeypatch):
    """Texts alike to each other but not to the least member of their bucket."""
    monkeypatch.setattr(minhash, "TILE", 3)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for family in range(12):
        own = base[:60] + [f"f{family}-{i}" for i in range(20)]
        for _ in range(3):
            rows.append((len(rows), " ".join(w if rng.random() > 0.02 else f"n{rng.random()}" for w in own)))
    check(documents, rows, 2)


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 2**63, 4000).astype(np.uint64), rng.integers(0, 2**63, 1000).astype(np.uint64)
    sets = [a, np.concatenate([a[:3000], b]), a[:1], a[:7]]
    full = minhash.sketches(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    assert (full != np.uint64(2**64 - 1)).all()
    assert abs((full[0] == full[1]).mean() - 0.6) < 0.17
    assert (minhash.sketches(a[::-1], np.array([0, len(a)]))[0] == full[0]).all()


def test_components_of_paths_and_stars(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (301, 300), (300, 301)]
    rng.shuffle(links)
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {300: 300, 301: 300}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
