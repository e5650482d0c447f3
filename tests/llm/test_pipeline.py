"""Queries and pipeline over the smallest tables, held against brute force or the stages' own promises."""

from hashlib import sha256

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
from kinlink.llm import mixing, pii, queries
from kinlink.storage import materialize
from tests.llm.test_ann import brute as nearest_brute
from tests.llm.test_bottomk import edited
from tests.llm.test_minhash import shingles
from tests.llm.test_pii import plain
from tests.llm.test_urls import judged

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def linked(rows, width):
    """Component of each id by comparing all pairs."""
    sets = [(i, shingles(t, width)) for i, t in rows]
    above = {i: i for i, _ in sets}

    def find(x):
        while above[x] != x:
            x = above[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                above[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in sets}


def test_registered():
    names = contract.queries()
    assert {"pipeline", *queries.QUERIES} <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_op2(spark, docs):
    got = {r["doc_id"]: r for r in queries.op2_minhash(spark, SMALL).collect()}
    want = linked([(i, r["text"]) for i, r in docs.items()], 2)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["n_shingles"] == len(shingles(docs[i]["text"], 2)) and r["kept"] == (want[i] == i) for i, r in got.items())


def test_op3(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got, want = queries.op3_ann(spark, SMALL).collect(), nearest_brute(rows)
    pairs = {(r["query_id"], r["vec_id"]) for r in got}
    assert len(got) == len(want) and len(pairs & {(w[0], w[2]) for w in want}) >= 0.9 * len(want)


def test_op4(spark, docs):
    library = Tokenizer.from_file(queries.TOKENIZER)
    for r in queries.op4_bpe(spark, SMALL).collect():
        text = docs[r["doc_id"]]["text"] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == sha256(back.encode()).hexdigest()


def test_op5(spark, docs):
    for r in queries.op5_pii(spark, SMALL).collect():
        base = plain(docs[r["doc_id"]]["text"] or "")
        listed = [f"{k}:{a}:{b}" for k, a, b in base]
        assert r["base_sha256"] == sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r["spans"].split(",") if r["spans"] else [])
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in base) for k in pii.BASE]


def test_op6_and_op7(spark, docs):
    index = queries.op6_shards(spark, SMALL).collect()
    assert {r["slot"] for r in index} == set(range(max(r["slot"] for r in index) + 1))
    held = {}
    for r in index:
        held[r["doc_id"]] = held.get(r["doc_id"], 0) + r["n_tokens"]
    assert held == {i: len((r["text"] or "").encode()) for i, r in docs.items()}
    assert {r["doc_id"] for r in queries.op7_mixing(spark, SMALL).collect()} == set(docs)


def test_op8(spark, docs):
    want = {i: (len(t), sha256(e.encode()).hexdigest()) for i, t, e, _ in edited([(i, r["text"]) for i, r in docs.items()])}
    got = queries.op8_fingerprint(spark, SMALL).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == want
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_op9_and_op1(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for r in queries.op9_urls(spark, SMALL).collect():
        host, path, rule, action = judged(pages[r["page_id"]]["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] == (action or r["verdict"])
    for r in queries.op1_extract(spark, SMALL).collect():
        html = pages[r["page_id"]]["html"] or ""
        assert len(r["text"]) == r["n_chars"] and r["text"].split("\n")[0] in html.replace("&amp;", "&")


def test_pipeline_stages(spark, docs):
    stages = dict(corpus_pipeline.STAGES)
    raw = spark.read.parquet(f"{SMALL}/documents.parquet")
    clean = materialize(stages["toxicity"](spark, raw, SMALL), "t1")
    verdicts = {r["doc_id"]: r["rejected"] for r in queries.op10_toxicity(spark, SMALL).collect()}
    assert {r["doc_id"] for r in clean.collect()} == {i for i, no in verdicts.items() if not no}
    single = materialize(stages["near_duplicates"](spark, clean, SMALL), "t2")
    groups = linked([(r["doc_id"], r["text"]) for r in clean.collect()], 5)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(set(groups.values()))
    masked = materialize(stages["personal_data"](spark, single, SMALL), "t3")
    assert all(not pii.base_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in masked.where("text is not null").collect())
    weighed = materialize(stages["mixing"](spark, masked, SMALL), "t4")
    assert {r["doc_id"] for r in weighed.collect()} == {r["doc_id"] for r in masked.collect()}
    assert all(f.columns == raw.columns for f in (clean, single, masked, weighed))
    library = Tokenizer.from_file(queries.TOKENIZER)
    texts = {r["doc_id"]: r["text"] for r in weighed.collect()}
    out = stages["bpe"](spark, weighed, SMALL).collect()
    assert all(r["token_ids"] == library.encode(texts[r["doc_id"]], add_special_tokens=False).ids for r in out)
    assert len(out) == weighed.count()


def test_stages_on_odd_tables(spark, tmp_path):
    """Nulls in any column, empty, repeated and very long texts, then no rows at all."""
    raw = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "word " * 30_000, None, "s", 1), (3, "a b", "en", "s", 3)]
    table = spark.createDataFrame(odd, raw.schema).withColumn("extra", F.lit("mine"))
    for kept in (table, table.limit(0)):
        n = kept.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = materialize(stage(spark, kept, SMALL), f"odd-{name}")
            assert out.columns == kept.columns and out.count() >= n
            kept = out
        assert corpus_pipeline.STAGES[-1][1](spark, kept, SMALL).count() >= n


def test_one_row_of_each_group_whatever_the_ids(spark):
    text = " ".join(f"w{i}" for i in range(200))
    near, other, third = text + " end", " ".join(f"v{i}" for i in range(90)), " ".join(f"u{i}" for i in range(90))
    rows = [(1, text), (1, text), (1, other), (2, near), (2, other), (None, text), (None, third), (None, third), (3, None), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_row", F.lit("mine"))
    got = corpus_pipeline.one_of_each(spark, df, SMALL).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=repr) == sorted([(1, text), (1, other), (None, third), (3, None), (3, None), (4, "")], key=repr)
    assert {r["_row"] for r in got} == {"mine"}


def test_whole_run(spark):
    out = corpus_pipeline.run(spark, SMALL)
    rows = out.collect()
    assert rows and all(r["n_tokens"] == len(r["token_ids"]) for r in rows)
    assert isinstance(mixing.temper(np.array([1.0])).exponent, float)
