"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.llm import ann, bottomk, bpe, compression, extract, lexical, minhash, mixing, pii, runs, shards, toxicity, urls
from kinlink.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


@query
def op1_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extract.extract_table(pages, extract.load(spark))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 2-word shingle sets resemble each other by 0.8 or more."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2)


@query
def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every vector whose id is divisible by 50."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text that they decode to, as digests."""
    vocabulary = bpe.load(spark, TOKENIZER)
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", bpe.digests("text", vocabulary).alias("d")).select("doc_id", "d.*")


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and places of personal data in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_in_table(docs, pii.load(spark), into="found").select("doc_id", "found")
    count = lambda kind: F.size(F.filter("found", lambda s: s["base"] & (s["kind"] == kind))).cast("long")  # noqa: E731
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in pii.BASE),
        pii.digest(pii.listed("found", base_only=True)).alias("base_sha256"),
        pii.listed("found").alias("spans"),
    )


@query
def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes as sequences of 512 tokens in training order, written as shards; the index is returned."""
    docs = table(spark, sf_dir, "documents")
    return shards.write_shards(docs, shards.text_bytes(), key=20240607).index


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents the mixture takes, in which epoch and at which place of its source."""
    taken = mixing.mixed_sources(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return taken.select("doc_id", "source", mixing.word_count().alias("n_words"), "mix_epoch", "mix_place")


@query
def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    found = bottomk.fingerprints(table(spark, sf_dir, "documents"))
    alike = lambda other: bottomk.resemblance(F.col("sketch"), F.col(other))  # noqa: E731
    return found.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        bottomk.as_text(F.col("sketch")).alias("fingerprint"),
        bottomk.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        alike("edited_sketch").alias("near_edited"),
        alike("next_sketch").alias("near_next"),
    )


@query
def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's address; unigram counts come from all documents."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = urls.judged(pages, urls.word_counts(table(spark, sf_dir, "documents")))
    return found.select("page_id", "host", "path", "rule", "verdict", F.array_join("words", " ").alias("words"), "score")


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of the categories for every document, and whether it is rejected."""
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs.select("doc_id", "text"), chain).select(
        "doc_id", *(F.col(f"toxicity.{name}").alias(f"p_{name}") for name in chain.names), "toxicity.rejected"
    )


@query
def op11_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The probability that every document is of good quality, by the dictionary that makes it smaller."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    classifier = compression.fit(docs, table(spark, sf_dir, "labels"))
    return compression.scored(docs, classifier).select(
        "doc_id", compression.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query
def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    index = lexical.build(table(spark, sf_dir, "documents"))
    return lexical.search(index, table(spark, sf_dir, "benchmark"), k=10)


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

SQL["op12_lexical"] = f"""
WITH term AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM term GROUP BY ALL),
size AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY ALL),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM size),
norm AS (SELECT doc_id, 100 - 90 + (90 * n * docs) // terms AS m FROM size, total),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
weight AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, total WHERE term IN (SELECT term FROM asked) GROUP BY term, docs
),
score AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN norm USING (doc_id) GROUP BY ALL
)
SELECT item_id, rank, doc_id, score
FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM score WHERE score > 0
)
WHERE rank <= 10
"""


@query
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document's words, some of them planted, and the text without their repeats."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = runs.periodic_runs(docs, runs.with_planted_period()).select("doc_id", "found")
    best = found.withColumn("best", runs.longest("found.runs"))
    return best.select(
        "doc_id",
        F.size("found.runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{name}") for name in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(runs.listed("found.runs").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("found.collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


#: The CRC-32 of doc_id in decimal, a byte and a bit at a time.
_CRC = """xor(4294967295, list_reduce(
    [4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda digit: ascii(digit)::BIGINT),
    lambda crc, byte: list_reduce([xor(crc, byte)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
        lambda rest, bit: xor(rest >> 1, (rest & 1) * 3988292384))))"""

SQL["op13_runs"] = rf"""
WITH split AS (
  SELECT doc_id, {_CRC} AS h,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[ 	-]+'), lambda w: w <> '') AS words
  FROM documents
),
drawn AS (SELECT *, len(words) AS n, if(len(words) > 0, (h // 10) % len(words), 0) AS a, h // 10 AS g FROM split),
planted AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN
      list_transform(range(n), lambda i: words[1 + if(i < a, i, a + (i - a) % (1 + (n - a) // (3 + g % 8)))])
    ELSE words END AS words
  FROM drawn
),
word AS (SELECT doc_id, n, unnest(words) AS w, unnest(range(n)) AS i FROM planted),
three AS (
  SELECT doc_id, n, i, w, lead(w) OVER own AS w1, lead(w, 2) OVER own AS w2
  FROM word WINDOW own AS (PARTITION BY doc_id ORDER BY i)
),
back AS (
  SELECT a.doc_id, a.i, b.i - a.i AS q FROM three a JOIN three b
    ON a.doc_id = b.doc_id AND a.w = b.w AND a.w1 = b.w1 AND a.w2 = b.w2 AND b.i > a.i AND (b.i - a.i) * 4 <= a.n
),
stretch AS (
  SELECT doc_id, q, min(i) AS s, max(i) + q + 3 - min(i) AS len
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM back)
  GROUP BY doc_id, q, island HAVING max(i) + q + 3 - min(i) >= greatest(6, 4 * q)
),
run AS (
  SELECT * FROM stretch a WHERE NOT EXISTS (
    SELECT 1 FROM stretch b WHERE b.doc_id = a.doc_id AND b.q < a.q AND b.s <= a.s AND b.s + b.len >= a.s + a.len)
),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM run),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
    first({{'s': s, 'len': len, 'q': q}} ORDER BY len DESC, s, q) AS best
  FROM run GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.len AS length, best.q AS period,
  1000 * best.len // best.q AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM documents d LEFT JOIN listed USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""
