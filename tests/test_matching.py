import random

import numpy as np
import pytest

from kinlink.functions.edits import indel_scores
from kinlink.functions.wordsets import token_set_scores
from kinlink.operators import best, lists, matching, names, vectors
from kinlink.operators import assign as assigning
from kinlink.operators import components as connected
from kinlink.operators.assign import assign
from kinlink.operators.components import components
from kinlink.operators.rules import M1, M2, Rule, passing
from kinlink.operators.similar import meetings, similar_values
from kinlink.operators.tiles import compare_tiles
from kinlink.operators.vectors import near_rows, vector_pairs
from suite import checks


def mutate(text, rng):
    chars = list(text)
    for _ in range(rng.randint(0, 4)):
        at = rng.randint(0, len(chars))
        if rng.random() < 0.5 and chars:
            chars.pop(min(at, len(chars) - 1))
        else:
            chars.insert(at, rng.choice("AB1 "))
    return "".join(chars)


@pytest.mark.parametrize("threshold", [70, 75, 80, 85, 90, 95])
def test_similarity_join_finds_every_pair(spark, threshold):
    rng = random.Random(threshold)
    bases = ["".join(rng.choices("ABCDE 12", k=rng.randint(0, 25))) for _ in range(25)] + ["AAAAAAAAAA", "", "A"]
    left = [(str(i % 2), mutate(rng.choice(bases), rng)) for i in range(150)]
    right = [(str(i % 2), mutate(rng.choice(bases), rng)) for i in range(150)]
    a, b = spark.createDataFrame(left, "block string, value string"), spark.createDataFrame(right, "block string, value string")
    got = {(r["block"], r["left_value"], r["right_value"]) for r in similar_values(a, b, threshold, ["block"]).collect()}
    pairs = [(k, x, y) for k, x in set(left) for m, y in set(right) if k == m]
    scores = indel_scores([p[1] for p in pairs], [p[2] for p in pairs])
    assert got == {p for p, s in zip(pairs, scores) if s >= threshold}


def test_a_pair_meets_once_and_most_pairs_never(spark):
    rng = random.Random(2)
    words = ["".join(rng.choices("ABCDEFGHIJKLMNOPRST", k=rng.randint(3, 8))) for _ in range(80)]
    names = [" ".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(240)]
    left, right = ({mutate(rng.choice(names), rng) for _ in range(300)} for _ in range(2))
    a, b = (spark.createDataFrame([(v,) for v in side], "value string") for side in (left, right))
    met = meetings(a, b, 80, []).select("left_value", "right_value").collect()
    assert len(met) == len(set(met)) < len(left) * len(right) / 2
    scores = indel_scores([x for x in left for _ in right], [y for _ in left for y in right])
    want = {p for p, s in zip(((x, y) for x in left for y in right), scores) if s >= 80}
    assert want and want <= {tuple(m) for m in met}


def test_a_pair_is_scored_once(spark):
    a = spark.createDataFrame([("ACME BAKERY",)], "value string")
    plan = similar_values(a, a, 90)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def in_turn(pairs):
    taken, out = set(), []
    for left in sorted({p[0] for p in pairs}):
        best = min((p for p in pairs if p[0] == left and p[1] not in taken), key=lambda p: (-p[3], -p[2], p[1]), default=None)
        if best:
            taken.add(best[1])
            out.append(best[:2])
    return sorted(out)


def test_equal_scores_need_one_turn(spark):
    pairs = [("1", i, 100 + j, 90.0, 90.0, False) for i in range(24) for j in range(24)]
    p = spark.createDataFrame(pairs, "block string, left_class long, right_class long, street_score double, name_score double, used_global boolean")
    lm = spark.range(24).selectExpr("id AS left_class", "id AS left_id")
    rm = spark.range(100, 124).selectExpr("id AS right_class", "id AS right_id")
    got = sorted((r["left_id"], r["right_id"]) for r in assign(p, lm, rm).collect())
    assert got == [(i, 100 + i) for i in range(24)]
    weights = assigning._weights(p, rm, 200_000)
    turns = assigning._turns(p.withColumn("unit", p["block"]), lm, weights, 200_000)
    assert turns.agg({"turn": "max"}).first()[0] == 0


def test_components(spark):
    rng = random.Random(8)
    chain = [(i, i + 1) for i in range(300, 420)]
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + chain + [(900, 500 + i) for i in range(200)] + [(7, 7)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    table = spark.createDataFrame(edges, "node long, other long")
    got = {r["node"]: r["component"] for r in components(table).collect()}
    assert got == {x: root(x) for x in parent} and components(table.limit(0)).count() == 0


def test_components_in_a_task_and_in_rounds(spark, monkeypatch):
    rng = random.Random(12)
    edges = [(rng.randrange(-150, 150), rng.randrange(-150, 150)) for _ in range(130)] + [(i, i + 1) for i in range(300, 340)] + [(5, 5)]
    table = spark.createDataFrame(edges, "node long, other long")
    found = []
    for most in (1_000, 10):
        monkeypatch.setattr(connected, "EDGES_AT_ONCE", most)
        found.append(sorted(map(tuple, components(table).collect())))
    assert found[0] == found[1] and len(found[0]) > 150


def test_turns_read_and_write_only_what_is_left(spark, monkeypatch):
    """One large component, many of one turn, and two stars, in one large block."""
    rng = random.Random(3)
    rows = [(i, 1000 + j) for i in range(60) for j in range(60) if rng.random() < 0.8]
    rows += [(100 + 3 * k + i, 2000 + 3 * k + j) for k in range(50) for i in range(2) for j in range(2)]
    pairs = [("b", a, b, float(rng.randint(1, 3)), float(rng.randint(1, 3)), False) for a, b in rows]
    members = [(a, a) for a in {a for a, _ in rows}], [(b, b) for b in {b for _, b in rows}]
    pairs += [("b", 400, 5000 + j, 1.0, float(j % 3), False) for j in range(5)] + [("b", 410 + j, 6000, 1.0, 1.0, False) for j in range(5)]
    members[0].extend([(400, 400 + i) for i in range(9)] + [(410 + j, 500 + 10 * i + j) for j in range(5) for i in range(3)])
    members[1].extend([(5000 + j, 5000 + j + 10 * i) for j in range(5) for i in range(2)] + [(6000, 6000 + i) for i in range(8)])
    p = spark.createDataFrame(pairs, "block string, left_class long, right_class long, street_score double, name_score double, used_global boolean")
    lm, rm = spark.createDataFrame(members[0], "left_class long, left_id long"), spark.createDataFrame(members[1], "right_class long, right_id long")
    written = []
    real = assigning.materialize

    def counting(df, label):
        done = real(df, label)
        written.append((label, done.count()))
        return done

    monkeypatch.setattr(assigning, "materialize", counting)
    got = sorted((r["left_id"], r["right_id"]) for r in assign(p, lm, rm, 400).collect())
    left_of, right_of = {}, {}
    for c, i in members[0]:
        left_of.setdefault(c, []).append(i)
    for c, i in members[1]:
        right_of.setdefault(c, []).append(i)
    assert got == in_turn([(i, j, s, n) for _, a, b, s, n, _ in pairs for i in left_of[a] for j in right_of[b]])
    sizes = dict(written)
    large = sum(1 for a, _ in rows if a < 100)
    assert sizes["turn-pairs"] == large and sizes["seats"] == 60  # pairs and places of the one component with more turns
    assert [label for label, _ in written].count("turn-pairs") == 1 and "free" not in sizes


def test_any_budget_of_assignment_equals_choosing_in_turn(spark):
    rng = random.Random(5)
    pairs, lefts, rights, rows = [], [], [], []
    for block in range(40):
        base = block * 1000
        left_ids, right_ids = list(range(base, base + rng.randint(1, 14))), list(range(base, base + rng.randint(1, 14)))
        a = {i: rng.randint(0, 3) for i in left_ids}
        b = {i: rng.randint(0, 3) for i in right_ids}
        first_a = {c: min(i for i in a if a[i] == c) for c in a.values()}
        first_b = {c: min(i for i in b if b[i] == c) for c in b.values()}
        lefts += [(first_a[c], i) for i, c in a.items()]
        rights += [(first_b[c], i) for i, c in b.items()]
        for c, p in first_a.items():
            for d, q in first_b.items():
                if rng.random() < 0.7:
                    street, name = float(rng.randint(1, 2)), float(rng.randint(1, 2))
                    pairs.append((str(block), p, q, street, name, False))
                    rows += [(i, j, street, name) for i in a if a[i] == c for j in b if b[j] == d]
    p = spark.createDataFrame(pairs, "block string, left_class long, right_class long, street_score double, name_score double, used_global boolean")
    lm, rm = spark.createDataFrame(lefts, "left_class long, left_id long"), spark.createDataFrame(rights, "right_class long, right_id long")
    want = in_turn(rows)
    for limit in (10**6, 60, 25):
        got = assign(p, lm, rm, limit).collect()
        assert sorted((r["left_id"], r["right_id"]) for r in got) == want
        assert {(r["left_id"], r["right_id"], r["street_score"], r["name_score"]) for r in got} <= set(rows)


_PAIR = "block string, left_class long, right_class long, street_score double, name_score double, used_global boolean"


def _assigned(spark, pairs, lefts, rights, *budget):
    p = spark.createDataFrame(pairs, _PAIR)
    lm, rm = spark.createDataFrame(lefts, "left_class long, left_id long"), spark.createDataFrame(rights, "right_class long, right_id long")
    return sorted((r["left_id"], r["right_id"]) for r in assign(p, lm, rm, *budget).collect())


def test_more_turns_need_no_more_jobs(spark):
    rng = random.Random(11)
    pairs = [("b", i, 1000 + j, float(rng.randint(1, 9)), 1.0, False) for i in range(60) for j in range(60)]
    lefts, rights = [(i, i) for i in range(60)], [(1000 + j, 1000 + j) for j in range(60)]
    want, jobs = in_turn([(a, b, s, n) for _, a, b, s, n, _ in pairs]), []
    try:
        for budget in (1800, 60):
            spark.sparkContext.setJobGroup(f"turns-{budget}", "")
            assert _assigned(spark, pairs, lefts, rights, budget) == want
            jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"turns-{budget}")))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs[1] < jobs[0] + 20  # two turns, and sixty


def test_copies_cost_no_pairs(spark, monkeypatch):
    """Two classes of many copies on either side are settled in one task, whose budget their row pairs exceed by far."""
    monkeypatch.delattr(assigning, "_in_turns")
    pairs = [("b", a, b, float(1 + (a + b) % 2), 1.0, False) for a in (0, 1) for b in (10_000, 10_001)]
    lefts = [(i % 2, i) for i in range(300)]
    rights = [(10_000 + i // 3 % 2, 10_000 + i) for i in range(200)]
    left_of, right_of = ({c: [i for k, i in rows if k == c] for c, _ in rows} for rows in (lefts, rights))
    want = in_turn([(i, j, s, n) for _, a, b, s, n, _ in pairs for i in left_of[a] for j in right_of[b]])
    assert _assigned(spark, pairs, lefts, rights, 600) == want


@pytest.mark.parametrize("budget", [10**6, 12, 1])
def test_a_row_of_several_classes_chooses_once(spark, budget):
    """Ids that repeat: a left row takes the best of all its classes, and a right row is taken once."""
    pairs = [("b", a, b, float(1 + (a * b) % 3), float(1 + (a + b) % 2), False) for a in range(1, 5) for b in range(101, 106)]
    lefts, rights = [(1, 1), (2, 1), (2, 2), (3, 3), (3, 3), (4, 2), (4, 9)], [(b, b - i) for b in range(101, 106) for i in (0, 1)]
    rows = [(i, j, s, n) for _, a, b, s, n, _ in pairs for c, i in lefts if c == a for d, j in rights if d == b]
    assert _assigned(spark, pairs, lefts, rights, budget) == in_turn(rows)


@pytest.mark.parametrize("budget", [10**6, 60, 1])
def test_lists_settle_as_pairs_do(spark, monkeypatch, budget):
    """Blocks, stars and components of all sizes; ids that repeat, classes without rows, null blocks, classes and ids."""
    monkeypatch.setattr(assigning, "PACKED_FROM", 0)
    monkeypatch.setattr(lists, "PAIRS_AT_ONCE", 40)
    rng = random.Random(17)
    pairs, lefts, rights = [], [], []
    for block in range(8):
        base = block * 1000 - 1000
        a, b = (range(base, base + rng.randint(2, 14)) for _ in range(2))
        pairs += [(str(block), p, q, float(rng.randint(1, 2)), float(rng.randint(1, 3)), rng.random() < 0.5) for p in a for q in b if rng.random() < 0.7]
        lefts += [(p, p + 100 * k) for p in a for k in range(rng.randint(0, 3))]
        rights += [(q, q + 100 * k) for q in b for k in range(rng.randint(0, 3))]
        pairs += [(str(block), base + 500, base + 500 + j, 1.0, float(j % 3), False) for j in range(5)]
        pairs += [(str(block), base + 600 + j, base + 600, 1.0, 1.0, True) for j in range(5)]
        lefts += [(base + 500, base + 500 + i) for i in range(7)] + [(base + 600 + j, base + 600 + j + 10 * i) for j in range(5) for i in range(2)]
        rights += [(base + 500 + j, base + 500 + j + 10 * i) for j in range(5) for i in range(2)] + [(base + 600, base + 600 + i) for i in range(8)]
    pairs += [("5", 4001, 1 << 40, 2.0, 3.0, True)]
    rights += [(1 << 40, 1 << 40), rights[0], (rights[1][0], rights[0][1])]
    lefts += [lefts[0], (lefts[1][0], lefts[0][1])]
    rng.shuffle(pairs)
    left_of, right_of = ({c: [i for k, i in rows if k == c] for c, _ in rows} for rows in (lefts, rights))
    rows = [(i, j, s, n) for _, a, b, s, n, _ in pairs for i in left_of.get(a, []) for j in right_of.get(b, [])]
    none = [(None, 1, 1, 9.0, 9.0, True), ("1", None, 1, 9.0, 9.0, True), ("1", 1, None, 9.0, 9.0, True)]
    got = _assigned(spark, pairs + none, lefts + [(None, 1), (1, None)], rights + [(None, 1), (1, None)], budget)
    assert len(rows) > 1000 and got == in_turn(rows)


def test_many_pairs_are_moved_as_lists(spark, monkeypatch):
    """No stored table has a row for each pair, and no other joins, sorts or groups them."""
    monkeypatch.setattr(assigning, "PACKED_FROM", 1000)
    written, real = [], assigning.materialize

    def counting(df, label):
        done = real(df, label)
        written.append(done.count())
        return done

    monkeypatch.setattr(assigning, "materialize", counting)
    rng = random.Random(4)
    pairs = [("b", i, 1000 + j, float(rng.randint(1, 2)), float(rng.randint(1, 2)), False) for i in range(60) for j in range(60)]
    side = [(i, i) for i in range(60)], [(1000 + j, 1000 + j) for j in range(60)]
    assert _assigned(spark, pairs, *side, 400) == in_turn([(a, b, s, n) for _, a, b, s, n, _ in pairs])
    assert written and max(written) <= len(pairs) / 8


def test_lists_keep_pairs(spark):
    rng = random.Random(6)
    pairs = [(str(a % 3), a, b, float(rng.randint(1, 2)), 1.0, rng.random() < 0.5) for a in (-5, 1, 2, 1 << 62) for b in (-(1 << 62), -3, 0, 7, 300, 1 << 40, 1 << 62) if rng.random() < 0.9]
    stored = lists.packed(spark.createDataFrame(pairs, _PAIR).coalesce(1)).cache()
    columns = ["block", "left_class", "right_class", "street_score", "name_score", "used_global"]
    back = lists.unpacked(stored.where(f"kind = {lists.LIST}"), *(c for c in columns if c != "right_class")).select(columns)
    assert sorted(map(tuple, back.collect())) == sorted(pairs)
    least = {p[1]: min(q[2] for q in pairs if q[1] == p[1]) for p in pairs}
    met = lists.unpacked(stored.where(f"kind = {lists.MEETS}"), "block", "left_class").select("block", "left_class", "right_class")
    assert set(map(tuple, met.collect())) == {(p[0], least[p[1]], p[2]) for p in pairs}


def test_pairs_of_brands_equal_their_sql(spark, monkeypatch, tmp_path):
    """Keys in two brands, equal rows, and nulls; pairs of classes of one row are made without grouping."""
    rng = random.Random(9)
    brands, given = ["Brand#11", "Brand#12", "Brand#13", "Brand#14", "Brand#15", "Brand#41", None], []
    rows = [(rng.choice([None, *range(90)]), f"n{i}", rng.choice(brands), rng.choice(["A", "B", None]), rng.choice([1, 2, 3, None])) for i in range(200)]
    part = spark.createDataFrame(rows + rows[:20], "p_partkey long, p_name string, p_brand string, p_type string, p_size int")
    part.write.parquet(f"{tmp_path}/part.parquet")

    def taken(pairs, own, other, budget):
        given.append(pairs)
        return pairs.selectExpr("block", "left_class AS left_id", "right_class AS right_id", "street_score", "name_score", "used_global").limit(0)

    monkeypatch.setattr(assigning, "assign", taken)
    checks.assign_large(spark, str(tmp_path))
    columns = ["block", "left_class", "right_class", "street_score", "name_score"]
    part.createOrReplaceTempView("part")
    want = [(*r[:3], float(r[3]), float(r[4])) for r in spark.sql(checks._BRAND_PAIRS).select(columns).collect()]
    assert len(want) > 1000 and sorted(map(tuple, given[0].select(columns).collect())) == sorted(want)


LEFT = "left_id long, block string, street string, name string"
RIGHT = "right_id long, block string, street string, name string, parent string"


def matched(spark, left, right, rule_list):
    a, b = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    return sorted((r["left_id"], r["right_id"], r["used_global"], r["method"]) for r in matching.fuzzy_match(a, b, rule_list).collect())


def test_rules_and_cascade(spark):
    left = [
        (1, "1", "12 MAIN ST", "ACME BAKERY"),
        (2, "1", "12 MAIN ST", "ACME BAKERY"),
        (3, "1", "9 OAK AVE", "BLUE DOOR"),
        (4, "2", "7 ELM ST", None),
        (5, "1", "40 LONG RIVER ROAD", "RIVER GRILL"),
        (6, None, "12 MAIN ST", "ACME BAKERY"),
        (7, "3", "1 A", "ONLY LEFT"),
    ]
    right = [
        (1, "1", "12 MAIN ST", "ACME BAKERY", None),
        (2, "1", "9 OAK AVE", "SOMETHING ELSE", "BLUE DOOR"),
        (3, "1", "40 LONG RIVER RD", "RIVER GRILL", None),
        (4, "2", "7 ELM ST", "X", "X"),
        (5, "1", None, "ACME BAKERY", None),
    ]
    assert matched(spark, left, right, [M1, M2]) == [(1, 1, False, "Method 1"), (3, 2, True, "Method 1"), (5, 3, False, "Method 2")]


def test_equal_names_are_decided_by_street_then_position(spark):
    left = [(1, "1", "120 MAIN STREET EAST", "ACME")]
    right = [
        (1, "1", "120 MAIN STREET EASTX", "ACME", None),
        (2, "1", "120 MAIN STREET EAST", "ACME", None),
        (3, "1", "120 MAIN STREET EAST", "ACME", "P"),
    ]
    assert matched(spark, left, right, [M1]) == [(1, 2, False, "Method 1")]


def test_nothing_in_common(spark):
    assert matched(spark, [(1, "1", "A ST", "B")], [(1, "2", "A ST", "B", None)], [M1, M2]) == []


def test_heavy_value_pairs_give_the_same_candidates(spark):
    rng = random.Random(9)
    words = ["ACME", "BAKERY", "RIVER", "GRILL", "NORTHERN", "LIGHTS"]

    def name():
        return mutate(" ".join(rng.choices(words, k=2)), rng)

    left = [(i, "1", rng.choice(["MISSING", "12 MAIN ST", "12 MAIN STR"]), name()) for i in range(120)]
    right = [(i, "1", rng.choice(["MISSING", "12 MAIN ST"]), name(), rng.choice([None, name()])) for i in range(120)]
    a = matching.left_classes(spark.createDataFrame(left, LEFT))
    b = matching.right_classes(spark.createDataFrame(right, RIGHT))
    for rule in (M1, M2, Rule("", 95, 60, 60), Rule("", 60, 95, 95)):
        found = []
        for limit in (10**9, 0):
            pairs = passing(matching.fuzzy_candidates(a, b, [rule], limit), rule).collect()
            found.append({(r["left_class"], r["right_class"]) for r in pairs})
        assert found[0] == found[1] and found[0]


def test_tiles_cover_every_pair_once(spark):
    a = spark.range(50).selectExpr("id AS l", "CAST(id % 2 AS STRING) AS block")
    b = spark.range(40).selectExpr("id AS r", "CAST(id % 2 AS STRING) AS block")
    out = compare_tiles(a, b, ["block"], "l", "r", lambda x, y: x[["l"]].merge(y[["r"]], how="cross"), "l bigint, r bigint", rows=7)
    got = sorted((r["l"], r["r"]) for r in out.collect())
    assert got == sorted((x, y) for x in range(50) for y in range(40) if x % 2 == y % 2)


def test_vector_match_with_an_encoder(spark):
    def lengths():
        return lambda texts: np.array([[1.0, len(t) % 3] for t in texts])

    left = spark.createDataFrame([(1, "1", "AA", "AA"), (2, "1", "A", "A")], LEFT)
    right = spark.createDataFrame([(1, "1", "A", "A", None), (2, "1", "BB", "B", "BB")], RIGHT)
    got = matching.vector_match(left, right, [Rule("Method 3", 0.99, 0.99, 0.99)], lengths).collect()
    assert sorted((r["left_id"], r["right_id"], r["used_global"]) for r in got) == [(1, 2, True), (2, 1, False)]


@pytest.mark.parametrize("rows", [3, 64, 8192])
def test_vector_ties_do_not_depend_on_tiles(spark, rows):
    from kinlink.functions.encode import hashed_trigrams

    rng = random.Random(1)
    names = ["ACME BAKERY", "BLUE DOOR INN", "RIVER GRILL"]
    streets = ["12 MAIN ST", "12 MAIN STREET", "9 OAK AVE", "40 LONG RIVER RD"]
    a = [(str(i % 2), i, rng.choice(names), rng.choice(streets)) for i in range(41)]
    b = [(str(i % 2), i, rng.choice(names), rng.choice(streets)) for i in range(37)]
    vector = lambda t: hashed_trigrams([t])[0].tolist()
    left = spark.createDataFrame([(k, i, vector(s), vector(n)) for k, i, n, s in a], "block string, left_class long, vs array<float>, vn array<float>")
    right = spark.createDataFrame([(k, i, "", vector(s), vector(n), vector("")) for k, i, n, s in b], "block string, right_class long, parent string, vs array<float>, vn array<float>, vp array<float>")
    found = matching.vector_pairs(left, right, [Rule("", 0.5, 0.5, 0.5)], rows).collect()
    by_text = {}
    text = {("l", i): (n, s) for _, i, n, s in a} | {("r", i): (n, s) for _, i, n, s in b}
    for r in found:
        key = text["l", r["left_class"]], text["r", r["right_class"]]
        by_text.setdefault(key, set()).add((r["street_score"], r["name_score"]))
    assert found and all(len(scores) == 1 for scores in by_text.values())
    assert all((1.0 in {s for s, _ in v}) for (x, y), v in by_text.items() if x[1] == y[1])


@pytest.mark.parametrize("least", [0.3, 0.6, 0.9, -0.2])
def test_near_rows_are_all_found(least):
    rng = np.random.default_rng(4)
    centres = rng.random((6, 32)) ** 4
    a, b = (centres[rng.integers(6, size=n)] + 0.15 * rng.random((n, 32)) ** 3 for n in (700, 500))
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (a, b))
    a[3], b[5], b[0] = 0, 0, 0 if least == 0.3 else b[0]
    i, j, score, computed = near_rows(a, b, least)
    want = np.round(a @ b.T, 9)
    assert {*zip(i.tolist(), j.tolist())} == {*zip(*(x.tolist() for x in np.nonzero(want >= least)))} and len(i) == len({*zip(i, j)})
    assert np.allclose(score, want[i, j]) and (computed < a.shape[0] * b.shape[0]) == (least in (0.6, 0.9))


def test_vector_pairs_of_a_large_block_in_cells(spark):
    rng = np.random.default_rng(6)
    centres = rng.random((5, 16)) ** 4
    make = lambda n: (centres[rng.integers(5, size=n)] + 0.1 * rng.random((n, 16))).astype(np.float32)
    streets, others, names, theirs = make(30)[rng.integers(30, size=120)], make(25)[rng.integers(25, size=90)], make(120), make(90)
    rows = [("b" if i % 4 else "c", i, s.tolist(), n.tolist()) for i, (s, n) in enumerate(zip(streets, names))]
    left = spark.createDataFrame(rows, "block string, left_class long, vs array<float>, vn array<float>")
    rows = [("b" if i % 4 else "c", i, "p", s.tolist(), n.tolist() if i % 5 else None, n[::-1].tolist()) for i, (s, n) in enumerate(zip(others, theirs))]
    right = spark.createDataFrame(rows, "block string, right_class long, parent string, vs array<float>, vn array<float>, vp array<float>")
    rule_list = [Rule("", 0.9, 0.9, 0.95), Rule("", 0.97, 0.6, 0.9)]
    unit = lambda x: x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    street, name, parent = (np.round(unit(x) @ unit(y).T, 9) for x, y in ((streets, others), (names, theirs), (names, theirs[:, ::-1])))
    name[:, ::5] = -1
    keep = np.zeros(street.shape, bool)
    for r in rule_list:
        keep |= (street >= r.street) & ((name >= r.name) | (parent >= r.parent))
    same = (np.arange(120) % 4 > 0)[:, None] == (np.arange(90) % 4 > 0)[None, :]
    want = {(i, j, street[i, j], name[i, j], parent[i, j]) for i, j in zip(*(x.tolist() for x in np.nonzero(keep & same)))}
    for tile_rows in (1000, 20):
        counters = {k: spark.sparkContext.accumulator(0) for k in ("pairs", "streets", "names")}
        found = vector_pairs(left, right, rule_list, tile_rows, counters).collect()
        got = {(r["left_class"], r["right_class"], r["street_score"], r["name_score"], r["parent_score"]) for r in found}
        assert len(got) == len(found) and got == want
        assert 0 < counters["names"].value < same.sum() / 2
    assert counters["pairs"].value < 4 * (30 * 25)  # some cells never meet; those that do hold distinct streets only


@pytest.mark.parametrize("pairs", [3, 50, 10_000])
def test_pairs_of_vectors_stand_for_all_their_rows_in_bounded_steps(monkeypatch, pairs):
    rng = np.random.default_rng(3)
    own, other = (np.concatenate([np.arange(k), rng.integers(0, k, n)]) for k, n in ((20, 150), (3, 5)))
    near = rng.random((20, 3)) < 0.4
    i, j = np.nonzero(near)
    monkeypatch.setattr(vectors, "_PAIRS", pairs)
    steps = list(vectors._expanded(i, j, own, other))
    got = [row for step in steps for row in zip(*(c.tolist() for c in step))]
    want = {(a, b) for a in range(len(own)) for b in range(len(other)) if near[own[a], other[b]]}
    assert {(a, b) for a, b, _ in got} == want and len(got) == len(want)
    assert all((i[pair], j[pair]) == (own[a], other[b]) for a, b, pair in got)
    assert max(len(step[0]) for step in steps) <= max(pairs, np.bincount(other).max())


def test_blocks_are_cut_into_cells_only_where_both_sides_are_larger_than_a_tile(spark):
    make = lambda n, side: spark.range(n).selectExpr("'b' AS block", f"id AS {side}_class", "array(float(id), 1f) AS vs")
    few, many = make(4, "right"), make(9, "left")
    assert not vectors._in_cells(many, few, 0.2, 5)[2] and vectors._in_cells(many, few, 0.2, 3)[2]
    assert not vectors._in_cells(many, few, vectors.reach(0.6), 3)[2]


def test_a_rule_of_strings_looks_only_at_classes_that_have_rows_left(spark):
    left = [(i, "b", f"{i} MAIN ST", f"ACME {i}") for i in range(4)] + [(9, "b", "0 MAIN ST", "ACME 0")]
    left = spark.createDataFrame(left, "left_id long, block string, street string, name string")
    right = [(i, "b", f"{i} MAIN ST" if i < 3 else "77 MAIN ST", f"ACME {i}", None) for i in range(4)]
    right = spark.createDataFrame(right, "right_id long, block string, street string, name string, parent string")
    seen, rule_list = [], [Rule("first", 100, 100, 100), Rule("second", 60, 100, 100)]

    def candidates(lefts, rights, some):
        seen.append((lefts.count(), rights.count(), [r.method for r in some]))
        return matching.fuzzy_candidates(lefts, rights, some)

    got = {tuple(r) for r in matching.cascade(left, right, rule_list, candidates, apart=True).select("left_id", "right_id", "method").collect()}
    assert got == {(0, 0, "first"), (1, 1, "first"), (2, 2, "first"), (3, 3, "second")}
    assert seen == [(4, 4, ["first"]), (2, 1, ["second"])]  # 0 MAIN ST still has row 9
    together = matching.cascade(left, right, rule_list, matching.fuzzy_candidates)
    assert {tuple(r) for r in together.select("left_id", "right_id", "method").collect()} == got


@pytest.mark.parametrize("rows", [3, 100])
def test_tiles_get_the_vector_of_each_text_once(spark, rows):
    """Texts and a table of vectors give the pairs of ready vectors, whatever the tiles, and rows carry no vectors."""
    from kinlink.functions.encode import hashed_trigrams

    rng = random.Random(2)
    names, streets = ["ACME BAKERY", "ACME BAKERIES", "RIVER GRILL", "BLUE DOOR"], ["12 MAIN ST", "12 MAIN STREET", "9 OAK AVE"]
    a = [(str(i % 2), i, rng.choice(streets), rng.choice(names)) for i in range(31)]
    b = [(str(i % 2), i, rng.choice([None, *names]), rng.choice(streets), rng.choice([None, *names])) for i in range(29)]
    vectors = spark.createDataFrame([(t, hashed_trigrams([t])[0].tolist()) for t in names + streets], "text string, vector array<float>")
    left = spark.createDataFrame(a, "block string, left_class long, ts string, tn string")
    right = spark.createDataFrame(b, "block string, right_class long, parent string, ts string, tn string").selectExpr("*", "parent AS tp")
    rule = [Rule("", 0.5, 0.5, 0.5)]
    ready = [matching.attach_vectors(df, vectors, {"ts": "vs", "tn": "vn"}) for df in (left, right)]
    ready[1] = matching.attach_vectors(ready[1], vectors, {"tp": "vp"})
    keys = lambda df: sorted(df.collect(), key=lambda r: r[:3])
    want = keys(matching.vector_pairs(*(df.drop("ts", "tn", "tp") for df in ready), rule, rows))
    own, other = (matching.attach_vectors(df, vectors, {"ts": "vs"}) for df in (left, right))
    assert keys(matching.vector_pairs(own, other, rule, rows, vectors=vectors)) == want and want


def test_output_and_leftovers(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "record_id long, x string")
    right = spark.createDataFrame([(7, "c"), (8, "d")], "record_id long, x string")
    matches = spark.createDataFrame([("k", 1, 8, 99.0, 90.0, True, "Method 1", 1)], "block string, left_id long, right_id long, street_score double, name_score double, used_global boolean, method string, phase int")
    row = matching.match_output(matches, left, right).first().asDict()
    assert row == {
        "pcrb_record_id": 1, "pcrb_x": "a", "dnb_record_id": 8, "dnb_x": "d", "Similarity_Score": 90.0, "Used_Global": True,
        "Street_Similarity": 99.0, "BusinessName_Similarity": 90.0, "matched_method": "Method 1", "matched": True, "phase": 1,
    }
    assert [tuple(r) for r in matching.unmatched(left, matches, "record_id", "left_id").collect()] == [(2, "b", False)]


SCORES = {
    "ratio": indel_scores,
    "token_sort": lambda a, b: indel_scores(*([" ".join(sorted(t.split())) for t in side] for side in (a, b))),
    "token_set": token_set_scores,
}


@pytest.mark.parametrize("scorer", list(SCORES))
@pytest.mark.parametrize("cutoff", [0.0, 60.0])
def test_best_choice_equals_scoring_every_pair(scorer, cutoff):
    rng = random.Random(len(scorer))
    words = ["".join(rng.choices("ABCDEÉ", k=rng.randint(1, 6))) for _ in range(25)]
    own, other = (
        np.array(sorted({*[" ".join(rng.choices(words, k=rng.randint(0, 4))) for _ in range(n)], " ", "A"}), dtype=object)
        for n in (90, 160)
    )
    grid = SCORES[scorer](np.repeat(own, len(other)), np.tile(other, len(own))).reshape(len(own), -1)
    pairs = best.SCORERS[scorer](own, other)
    bound = pairs.bound(slice(0, len(own)))
    assert np.all(bound >= grid)
    top, score, scored = best.first_best(bound, pairs.score, cutoff)
    kept = grid.max(axis=1) >= cutoff
    assert top.tolist() == np.where(kept, grid.argmax(axis=1), -1).tolist()
    assert score[kept].tolist() == grid.max(axis=1)[kept].tolist()
    assert scored < grid.size / 4


def test_best_choice_counts_its_work(spark):
    names_ = [(chr(65 + i % 7), f"{chr(65 + i % 7)} SHOP {i * i}") for i in range(140)]
    a = spark.createDataFrame(names_, "code string, value string")
    counters = {k: spark.sparkContext.accumulator(0) for k in ("pairs", "scored")}
    got = best.best_in_block(a, a, "code", "ratio", counters=counters).collect()
    assert len(got) == 140 and all(r["left_value"] == r["right_value"] and r["score"] == 100.0 for r in got)
    assert counters["pairs"].value == 140 * 20 and counters["scored"].value < 140 * 10


def test_name_maps(spark):
    left = spark.createDataFrame([("ACME BAKERY",), ("ACME BAKERY CO",), ("SAME",), ("ZZTOP",)], "n string")
    right = spark.createDataFrame([("ACME BAKERY INN",), ("SAME",)], "n string")
    got = [tuple(r) for r in names.name_maps(left, right).select("left_name", "right_name", "tier").collect()]
    assert got == [("ACME BAKERY", "ACME BAKERY INN", "high")]


def test_null_texts_match_in_the_vector_phase_only_when_filled(spark):
    from kinlink.plans.phases import run_phase
    from kinlink.plans.settings import PHASES, Settings

    columns = "record_id long, Zip_UPDATED string, City_UPDATED string, Street_UPDATED string, BusinessName_UPDATED string"
    left = spark.createDataFrame([(1, "1", "C", None, "ACME")], columns)
    right = spark.createDataFrame([(2, "1", "C", None, "ACME", None)], columns + ", GlobalName_UPDATED string")
    assert run_phase(left, right, PHASES[2]).count() == 0
    got = run_phase(left, right, PHASES[2], Settings(fill_missing=True)).collect()
    assert [(r["left_id"], r["right_id"], r["method"], r["phase"]) for r in got] == [(1, 2, "Method 3", 3)]


def _broadcasts(df):
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def test_rows_reach_no_broadcast(spark):
    """Tables that grow with the input meet by shuffle, however small they are here."""
    left = spark.createDataFrame([("1", "9 OAK AVE", "ACME", i) for i in range(3)], "block string, street string, name string, left_id long")
    right = left.selectExpr("block", "street", "name", "left_id + 10 AS right_id", "name AS parent")
    lefts, rights = matching.left_classes(left), matching.right_classes(right)
    assert not _broadcasts(matching.left_members(left, lefts)) and not _broadcasts(matching.right_members(right, rights))
    matches = spark.createDataFrame([("1", 1, 11, 99.0, 90.0, True, "Method 1")], "block string, left_id long, right_id long, street_score double, name_score double, used_global boolean, method string")
    assert not _broadcasts(matching.unmatched(left, matches, "left_id", "left_id"))
    rows = spark.createDataFrame([(1, "a"), (11, "b")], "record_id long, x string")
    assert not _broadcasts(matching.match_output(matches, rows, rows))
    vectors = spark.createDataFrame([("ACME", [1.0])], "text string, vector array<double>")
    assert not _broadcasts(matching.attach_vectors(left, vectors, {"name": "vn"}))


def test_assignment_broadcasts_blocks_only(spark):
    pairs = [("b", i, 1000 + i, 1.0, 1.0, False) for i in range(9)]
    p = spark.createDataFrame(pairs, "block string, left_class long, right_class long, street_score double, name_score double, used_global boolean")
    lm = p.selectExpr("left_class", "left_class AS left_id")
    rm = p.selectExpr("right_class", "right_class AS right_id")
    assert _broadcasts(assign(p, lm, rm)) <= 3  # the sizes of blocks, for pairs and either side
    assert not _broadcasts(assigning._weigh(p, lm, rm, "block"))
    units = p.withColumn("unit", p["left_class"])
    assert not _broadcasts(assigning._left_stars(units, lm, rm)) and not _broadcasts(assigning._right_stars(units, lm, rm))
