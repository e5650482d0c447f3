import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kinlink.llm import runs


def brute(words):
    """Runs by the definition, and the words that stay."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(6, 4 * q):
                own = words[i : j + q]
                if not any(own[r:] == own[: length - r] for r in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    out.sort(key=lambda r: (r[0], r[2]))
    gone = {k for s, length, q in out for k in range(s + q, s + length)}
    return out, " ".join(w for k, w in enumerate(words) if k not in gone)


def planted(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def check(texts):
    for words, (n, found, collapsed) in zip(texts, runs.runs_of([" ".join(w) for w in texts])):
        want, kept = brute(words)
        assert (n, [tuple(r) for r in found.tolist()], collapsed.decode()) == (len(words), want, kept)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=40), min_size=1, max_size=4))
def test_any_small_texts(texts):
    check(texts)


def test_planted_repeats():
    rng = random.Random(1)
    for _ in range(300):
        texts = []
        for _ in range(rng.randint(1, 4)):
            words = [rng.choice("abcd") for _ in range(rng.randint(1, 60))]
            start, period = rng.randrange(len(words)), rng.randint(1, 12)
            words[start:] = [words[start + i % period] if start + i % period < len(words) else "z" for i in range(len(words) - start)]
            texts.append(words + rng.choice([[], words, ["c", "a"]]))
        check(texts)


def test_runs_do_not_reach_into_the_next_text():
    check([["a"] * 5, ["a"] * 5, ["a"] * 6, [], ["x", "y"] * 3, ["x", "y"] * 4])


def test_long_texts():
    words = ["w%d" % (i % 5000) for i in range(60_000)]
    (n, found, collapsed), (_, ones, one) = runs.runs_of([" ".join(words), "a " * 200_000])
    assert (n, found.tolist(), len(collapsed.split())) == (60_000, [[0, 60_000, 5000]], 5000)
    assert (ones.tolist(), one) == ([[0, 200_000, 1]], b"a")


def test_table_with_odd_rows(documents):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "é " * 7), (4, "é " * 7), (None, "a b " * 5), (5, "a a " * 6)]
    out = runs.periodic_runs(documents(rows).withColumnRenamed("n", "found")).select("doc_id", "text", "found.*", "k").collect()
    got = {r["text"]: (r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in out}
    assert len(out) == len(rows) and all(r["k"] == "mine" for r in out)
    assert got[None] == got[""] == got[" \t\n"] == (0, [], "")
    assert got["é " * 7] == (7, [(0, 7, 1)], "é") and got["a b " * 5] == (10, [(0, 10, 2)], "a b")
    assert got["a a " * 6] == (6, [(0, 6, 1)], "a a")
    assert runs.periodic_runs(documents([])).count() == 0


def test_longest_run_of_ties(documents):
    found = runs.periodic_runs(documents([(1, "a a a a a a b b b b b b c d c d c d c d e"), (2, "x")]))
    best = {r["doc_id"]: r["b"] for r in found.select("doc_id", runs.longest("found.runs").alias("b")).collect()}
    assert best[2] is None and tuple(best[1]) == (12, 8, 2)
    found = runs.periodic_runs(documents([(1, "a a a a a a b b b b b b")]))
    assert tuple(found.select(runs.longest("found.runs")).first()[0]) == (0, 6, 1)


@pytest.fixture(scope="module")
def query_rows(spark):
    from kinlink.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    return spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), QUERIES["op13_runs"](spark, sf_dir).collect()


def test_query_equals_brute_force(query_rows):
    docs, rows = query_rows
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(docs)
    for doc in docs:
        words = planted(doc["doc_id"], doc["text"])
        if len(words) > 1500:  # brute force would take minutes; the SQL comparison covers every row
            continue
        found, kept = brute(words)
        row = got[doc["doc_id"]]
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        assert row["n_runs"] == len(found)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        assert (row["start"], row["length"], row["period"]) == best
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if found else None)
