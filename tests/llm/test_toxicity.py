import random

import numpy as np
import pytest

from kinlink.llm import toxicity


def corpus(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    bad = [w for ws in toxicity.CATEGORIES.values() for w in ws] + ["slurro", "slurra", "slurren"]
    texts, toxic = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(3, 60))]
        if i % 6 == 0:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", ".", ",", "!"]))
        texts.append(" ".join(words).capitalize())
        toxic.append(int(i % 6 == 0))
    return texts, toxic


@pytest.fixture(scope="module")
def tables(spark):
    texts, toxic = corpus(1500, 1)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return docs, spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")


def test_held_out_accuracy(spark, tables):
    chain = toxicity.fit(*tables)
    assert chain.names == [*toxicity.CATEGORIES, "toxic"] and min(chain.held_out.values()) > 0.95
    texts, toxic = corpus(600, 2)
    rejected = chain.predict(toxicity.feature_lists(texts))[:, -1] >= chain.threshold
    assert (rejected == np.array(toxic, bool)).mean() > 0.97


def test_later_models_use_earlier_probabilities(tables):
    assert [len(m.earlier) for m in toxicity.fit(*tables).models] == [0, 1, 2, 3]


def test_wanted_features_give_the_same(tables):
    chain = toxicity.fit(*tables)
    texts = ["", "IDIOT", *corpus(50, 3)[0]]
    assert np.allclose(chain.predict(toxicity.feature_lists(texts)), chain.predict(toxicity.feature_lists(texts, chain.features())))


def test_table(spark, tables, documents):
    chain = toxicity.fit(*tables)
    df = documents([(1, None), (2, ""), (3, "you stupid idiot, scum"), (3, "abc def"), (4, "abc " * 50_000)])
    rows = toxicity.scored(df, chain, into="n").collect()
    assert [r["n"]["rejected"] for r in rows] == [False, False, True, False, False]
    assert len(df.columns) == len(rows[0])
    assert toxicity.scored(df.limit(0), chain).count() == 0


def test_no_or_one_sided_labels_reject_nothing(spark, tables):
    docs, labels = tables
    for some in (labels.limit(0), labels.where("toxic = 0"), labels.selectExpr("cast(null as long) doc_id", "toxic")):
        chain = toxicity.fit(docs, some)
        assert not toxicity.scored(docs, chain).where("toxicity.rejected").count()


def test_repeated_and_null_rows_in_training(spark, tables):
    docs, labels = tables
    more = docs.unionByName(docs).unionByName(spark.createDataFrame([(None, "x"), (5, None)], docs.schema))
    toxicity.fit(more, labels.unionByName(labels).unionByName(spark.createDataFrame([(1, None), (None, 1)], labels.schema)))


def test_word_of_most_toxic_texts(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    make = lambda toxic: " ".join([word() for _ in range(30)] + ["the"] + ["slurro"] * toxic)
    toxic = [int(i % 2 == 0) for i in range(600)]
    docs = spark.createDataFrame([(i, make(t)) for i, t in enumerate(toxic)], "doc_id long, text string")
    chain = toxicity.fit(docs, spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int"))
    verdict = chain.predict(toxicity.feature_lists([make(i % 2) for i in range(200)]))[:, -1] >= chain.threshold
    assert verdict.tolist() == [bool(i % 2) for i in range(200)]


def test_threshold_at_the_class_shares_of_the_labels(spark, tables):
    p, target = np.array([0.2, 0.4, 0.6, 0.8]), np.array([0, 1, 0, 1])
    assert toxicity.best_threshold(p, target, np.where(target, 1.0, 9.0)) == pytest.approx(0.7)
    assert toxicity.best_threshold(p, target, np.where(target, 9.0, 1.0)) == pytest.approx(0.3)
    weights, toxic = (toxicity.labelled_sample(*tables, 200, 100)[i] for i in (2, 1))
    assert weights[toxic == 1].sum() == pytest.approx(250) and weights[toxic == 0].sum() == pytest.approx(1250)


def test_an_id_of_many_rows_is_one_row_of_the_sample(spark, tables):
    docs, labels = tables
    hot = docs.where("doc_id = 6").crossJoin(spark.range(3000).select()).unionByName(docs)
    lists, toxic, weights = toxicity.labelled_sample(hot, labels, 10, 10)
    plain = toxicity.labelled_sample(docs, labels, 10, 10)
    assert [x.tolist() for x in lists] == [x.tolist() for x in plain[0]] and toxic.tolist() == plain[1].tolist()
    found = docs.sparkSession.range(1).crossJoin(hot.where("doc_id = 6")).count()
    assert found == 3001 and weights[toxic == 1].sum() == pytest.approx(250)
