import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kinlink.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(PATH)


def texts():
    rng = random.Random(3)
    odd = ["", " ", "a" * 4000, "<|endoftext|>", "x<|endoftext|> <|endoftext", "日本語🤔‍ \t\n y", "é" * 200, "it's  we'll 12²½", "\x00\x01"]
    made = ["".join(rng.choice("abcdehtion é1'\n\t.日") for _ in range(rng.randint(1, 400))) for _ in range(150)]
    return odd + made + odd


def test_ids_equal_the_library(vocabulary):
    library = Tokenizer.from_file(PATH)
    got = bpe.Encoder(vocabulary).encode(texts())
    want = library.encode_batch(texts(), add_special_tokens=False)
    assert [np.frombuffer(x, np.int32).tolist() for x in got] == [w.ids for w in want]


def test_small_memory_changes_nothing(vocabulary, monkeypatch):
    whole = bpe.Encoder(vocabulary).encode(texts())
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    own = bpe.Encoder(vocabulary)
    assert [x for t in texts() for x in own.encode([t])] == whole


def test_long_words_take_the_heap(vocabulary):
    word = ("thereon" * 40).encode()
    rows = np.array([vocabulary.first[np.frombuffer(word, np.uint8)]])
    assert vocabulary.encode_long(word).tolist() == [i for i in vocabulary.encode_rows(rows)[0].tolist() if i >= 0]


def test_table_keeps_columns_and_round_trips(spark, documents):
    shared = bpe.load(spark, PATH)
    df = documents([(1, "the cat"), (2, None), (3, ""), (3, "x" * 50_000), (4, "<|endoftext|>é")])
    rows = bpe.encode_table(df, shared, into="ids").withColumn("back", bpe.decoded("ids", shared)).collect()
    assert [r["back"] for r in rows] == [r["text"] or "" for r in rows]
    assert {r["source"] for r in rows} == {"s"} and rows[1]["ids"] == []
    assert bpe.encode_table(df.limit(0), shared).count() == 0
    counted = df.select("ids", bpe.digests("text", shared).alias("d")).select("d.*").collect()
    assert [r["n_tokens"] for r in counted] == [len(r["ids"]) for r in rows]


def test_bad_bytes_are_replaced(spark):
    shared = bpe.load(spark, PATH)
    lone = int(shared.value.first[0xC3])
    df = spark.createDataFrame([([lone],), (None,)], "ids array<int>")
    assert [r[0] for r in df.select(bpe.decoded("ids", shared)).collect()] == ["�", ""]
