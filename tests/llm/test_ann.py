import numpy as np
import pytest
from pyspark.sql import functions as F

from kinlink.llm import ann


def brute(rows, k=5):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = []
    for i, q in good:
        if i % 50 == 0:
            s = [(-ann.exact_cosines(v[None], q)[0], j) for j, v in good if j != i and len(v) == len(q)]
            out += [(i, r + 1, j, -c) for r, (c, j) in enumerate(sorted(s)[:k])]
    return sorted(out)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.withColumns({n: F.lit(1) for n in ("id", "v", "dim", "block", "run", "rank", "score")})


def search(df):
    return sorted(map(tuple, ann.nearest(df, F.col("vec_id") % 50 == 0).collect()))


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((20, 16))
    points = centres[rng.integers(0, 20, 1500)] + 0.6 * rng.standard_normal((1500, 16))
    return [(i, p.astype(np.float32).tolist()) for i, p in enumerate(points)]


def test_recall_against_brute_force(spark, vectors, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 400)
    got, want = search(frame(spark, vectors)), brute(vectors)
    assert len(got) == len(want)
    hits = len({(a, c) for a, _, c, _ in got} & {(a, c) for a, _, c, _ in want})
    assert hits / len(want) >= 0.9
    exact = {(a, c): s for a, _, c, s in want}
    assert all(exact.get((a, c), s) == s for a, _, c, s in got)


def test_stopping_saves_verification_on_clusters(vectors):
    block = ann.Block(np.arange(1500), np.array([v for _, v in vectors], float), 5)
    seen = [block.nearest(i, np.array(vectors[i][1], float), 5, ann.chi_square_quantile(0.95))[1] for i in range(0, 1500, 100)]
    assert np.mean(seen) < 1200


def test_ties_copies_and_useless_vectors(spark):
    nan, inf = float("nan"), float("inf")
    same = [(i, [1.0, 2.0, 3.0]) for i in range(0, 60)]
    odd = [(100, None), (150, []), (200, [0.0, 0.0, 0.0]), (250, [nan, 1.0, 1.0]), (300, [inf, 0.0, 1.0]), (350, [None, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (400, [1.0, 2.0]), (450, [-1.0, 0.5, 0.0])]
    rows = same + odd
    assert search(frame(spark, rows)) == brute(rows)


def test_few_rows_and_none(spark):
    assert search(frame(spark, [])) == []
    assert search(frame(spark, [(0, [1.0, 0.0])])) == []
    assert search(frame(spark, [(0, [1.0, 0.0]), (7, [1.0, 1.0])])) == brute([(0, [1.0, 0.0]), (7, [1.0, 1.0])])


def test_chi_square_and_tree():
    assert abs(ann.chi_square(15.507) - 0.95) < 1e-4 and abs(ann.chi_square_quantile(0.95) - 15.507) < 1e-2
    points = np.random.default_rng(2).standard_normal((1000, 8))
    tree = ann.Tree(points)
    assert sorted(tree.order) == list(range(1000))
    leaves, far = tree.leaves_from(points[3])
    assert (np.diff(far) >= 0).all()
    for leaf, gap in zip(leaves, far):
        own = points[tree.order[tree.begin[leaf] : tree.end[leaf]]]
        assert ((own - points[3]) ** 2).sum(1).min() >= gap - 1e-9


def test_repeated_ids_count_as_rows(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 40)
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(4).tolist()) for i in range(1, 120) if i % 50]
    rows += [(7, [1.0, 0.1, 0.0, 0.0])] * 4 + [(7, [2.0, 0.2, 0.0, 0.0])] * 4  # one direction, near the query
    rows += [(9, [1.0, 0.0, 0.2, 0.0])] * 3
    query = [(50, [1.0, 0.0, 0.0, 0.0])]
    rows = [(i, np.float32(v).tolist()) for i, v in rows]
    want = brute(rows + query)
    assert [c for _, _, c, _ in want] == [7] * 5
    assert search(frame(spark, rows + query * 9)) == want
    few = [r for r in rows if r[0] == 9] + [(3, [0.0, 1.0, 0.0, 0.0]), (4, [1.0, 0.0, 0.0, 0.0])]
    assert search(frame(spark, few + query * 9)) == brute(few + query)
