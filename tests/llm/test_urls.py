from itertools import product
from math import log

import pytest
from pyspark.sql import functions as F

from kinlink.llm import urls


def judged(url):
    """Host, path, rule and the rule's action, read plainly."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [(len(h + p), h + p, a) for a, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def addresses():
    hosts = ["example.org", "www.EXAMPLE.org", "badexample.org", "x.com", "com", "a.net", "cheappills.net", "org", ""]
    ends = ["", "/", "/es/1", "/en/1", "/en/2?x=/es/", "/fr/", "/de/5#top", "?q", "#f", "/es", "//x://y/"]
    return [f"http://{h}{e}" for h, e in product(hosts, ends)] + [None, "", "nourl", "://", "mailto:a@b", "HTTP://A.Org/é"]


def test_rules_and_parts(spark):
    rows = list(enumerate(addresses()))
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({n: F.lit("mine") for n in ("host", "rule", "word", "name")})
    counts = spark.createDataFrame([("the", 50), ("pills", 3)], "word string, n long")
    out = {r["page_id"]: r for r in urls.judged(df, counts).collect()}
    assert len(out) == len(rows) and out[0]["name"] == "mine"
    for i, url in rows:
        host, path, rule, action = judged(url)
        assert (out[i]["host"], out[i]["path"], out[i]["rule"]) == (host, path, rule), url
        assert out[i]["verdict"] == (action or out[i]["verdict"]) in ("allow", "block")


def test_bayes_by_hand(spark):
    labelled = {"block": "cheap pills\nbad", "allow": "good news\nbook"}
    odds, prior = urls.fit_bayes(labelled)
    assert odds["pills"] == pytest.approx(log(2 / 9) - log(1 / 9)) and prior == -0.5
    df = spark.createDataFrame([(1, "http://cheappills.net/x"), (2, "http://goodbook.net/bad")], "page_id long, url string")
    out = sorted(urls.judged(df, spark.createDataFrame([("zzz", 9)], "word string, n long"), labelled=labelled).collect())
    assert [r["verdict"] for r in out] == ["block", "allow"]
    assert set(out[0]["words"]) >= {"cheap", "pills", "net"} and out[0]["score"] == pytest.approx(2 * odds["pills"] + prior)


def test_viterbi_equals_all_splits():
    known, total = {"the": 50, "there": 5, "rein": 2, "in": 30, "re": 9, "a": 40}, 200

    def chance(words):
        return sum(log(known[w] / total) if w in known else log(10 / total) - len(w) * log(10) for w in words)

    for name in ("therein", "thea", "zzthe", "a", "inthere", "q"):
        every = []
        for cut in product([0, 1], repeat=len(name) - 1):
            words, at = [], 0
            for i, c in enumerate((*cut, 1)):
                if c:
                    words.append(name[at : i + 1])
                    at = i + 1
            every.append(chance(words))
        best = urls.best_split(name, known, total)
        assert "".join(best) == name and chance(best) == pytest.approx(max(every))


def test_counts_and_segments(spark):
    docs = spark.createDataFrame([("The cat, the Dog",), (None,), ("",), ("é2 the" + " x" * 1000,)], "text string")
    counts = urls.word_counts(docs)
    assert {r["word"]: r["n"] for r in counts.collect()} == {"the": 3, "cat": 1, "dog": 1, "x": 1000}
    names = spark.createDataFrame([("thecat",), ("thecat",), (None,), ("",), ("qqq",)], "name string")
    assert {r["name"]: r["words"] for r in urls.segmented(names, counts).collect()} == {"thecat": ["the", "cat"], "qqq": ["qqq"]}


def test_empty_tables(spark):
    df = spark.createDataFrame([], "page_id long, url string")
    counts = spark.createDataFrame([], "word string, n long")
    assert urls.judged(df, counts).count() == 0
    assert urls.judged(spark.createDataFrame([(1, "http://a.b/" + "x" * 3000)], df.schema), counts).count() == 1


def test_a_very_long_name(spark):
    counts = spark.createDataFrame([("river", 50), ("bank", 40), ("q", 1)], "word string, n long")
    name = "riverbank" * 11_000 + "q"
    names = spark.createDataFrame([(name,), ("bankriver",), (None,), ("",)], "name string")
    got = {r["name"]: r["words"] for r in urls.segmented(names, counts).collect()}
    assert got["bankriver"] == ["bank", "river"] and len(got) == 2
    assert got[name] == ["river", "bank"] * 11_000 + ["q"]
