"""From raw documents to training tokens in five stages, each one operator applied to what the stage before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinlink.llm import bpe, minhash, mixing, pii, toxicity
from kinlink.storage import materialize

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject. Labels name documents of the raw table."""
    raw = spark.read.parquet(f"{sf_dir}/documents.parquet")
    chain = toxicity.fit(raw, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scored(docs, chain, into="_toxicity").where("not _toxicity.rejected").drop("_toxicity")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (5-word shingles, resemblance 0.8 or more): that of the least doc_id, null
    ids last, then of the least hash of the text. Rows are told apart by a number of their own, so neither repeated rows nor
    different texts under one id, or without any, are kept or lost together.
    """
    row = "_row"
    while row in docs.columns:
        row = "_" + row
    placed = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "placed-documents")
    groups = minhash.near_duplicates(placed, doc_id=row).select(F.col("doc_id").alias(row), "component_id")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text"), F.col(row).alias("row"))
    least = placed.select(row, order.alias("order")).join(groups, row).groupBy("component_id").agg(F.min("order").alias("first"))
    return placed.join(least.select(F.col("first.row").alias(row)), row, "left_semi").select(docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with each piece of personal data replaced by its kind; n_chars follows the new text."""
    masked = docs.withColumn("text", pii.masked("text", pii.load(spark)))
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and those of small sources again, up to twice, for more even weights of the sources."""
    return mixing.mixed_sources(docs).select(docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as token ids."""
    ids = bpe.encode_table(docs, bpe.load(spark, TOKENIZER), keep=["doc_id", "lang", "source"])
    return ids.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", one_of_each),
    ("personal_data", without_personal_data),
    ("mixing", mixed_sources),
    ("bpe", token_ids),
]

#: Models and tokens are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
