"""Ranked lexical search over an index stratified by document length.

A document's score for a query is the sum, over the query's distinct terms, of w * impact(tf, m): w weighs the term by its
document frequency, and m, the normaliser, depends on the document's length alone. Documents of equal m are one stratum.
Within a stratum only tf tells two documents apart, so an impact is computed once per tf and stratum, and a posting list
sorted by stratum and falling tf begins each stratum with its greatest impact: the sum of these over a query's terms bounds
what any document of the stratum can score. Strata are visited by falling bound, and as soon as the best documents found
beat the next bound, the rest cannot change the result.

The index is a table of blocks of documents, written once: a row holds a block's postings of one term, and a head row
without a term holds the block's documents and their normalisers. A block is what a task reads at a time, with at most
``BLOCK_POSTINGS`` postings (or one document, if it has more), so each document's postings lie in one block. A search
reads the postings of its own terms, lets every block find its best documents for each query, and ranks these.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinlink.llm.common import NOT_WORD, pieces
from kinlink.storage import materialize

BLOCK_POSTINGS = 500_000
#: Terms of the queries that are searched at once, so that many queries take several searches instead of more memory.
QUERY_TERMS = 200_000
_NONE = np.iinfo(np.int64).min  # stands for a null doc_id, which ranks before all others

#: Bytes between terms become blanks, A-Z become a-z.
_FOLDED = bytes(0x20 if NOT_WORD[b] else b + 32 if 65 <= b <= 90 else b for b in range(256))


def terms(text: str) -> list[bytes]:
    """Terms in order: maximal runs of ASCII letters and digits and of all characters beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLDED).split()


@F.arrow_udf(T.LongType())
def n_terms(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([len(terms(t)) if t else 0 for t in pieces(batch)], pa.int64())


def weight(n_docs: int, df: int) -> int:
    return int(np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))))


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


@dataclass(frozen=True)
class Index:
    """``blocks``: block, term, docs and tfs (the postings of a term), ids and ms (in the head row, without a term)."""

    blocks: DataFrame
    n_docs: int
    n_terms: int


_BLOCKS = (
    T.StructType()
    .add("block", T.StringType())
    .add("term", T.StringType())
    .add("docs", T.ArrayType(T.IntegerType()))
    .add("tfs", T.ArrayType(T.IntegerType()))
    .add("ids", T.ArrayType(T.LongType()))
    .add("ms", T.ArrayType(T.LongType()))
)


def _block(name: str, ids: list, texts: list[list[bytes]], n_docs: int, n_all: int) -> pa.RecordBatch:
    """The rows of one block; its documents are numbered by rising normaliser."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ms = 100 - 90 + (90 * lengths * n_docs) // max(n_all, 1)
    order = np.argsort(ms, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    flat = pa.array([w for own in texts for w in own], pa.binary()).dictionary_encode()
    code = flat.indices.to_numpy().astype(np.int64)
    pairs, tf = np.unique(code * len(texts) + np.repeat(place, lengths), return_counts=True)
    code, doc = pairs // len(texts), pairs % len(texts)
    ms = ms[order]
    by = np.lexsort((doc, -tf, ms[doc], code))
    code, doc, tf = code[by], doc[by], tf[by]
    n = len(flat.dictionary)
    bounds = np.concatenate([[0, 0], np.searchsorted(code, np.arange(1, n + 1))]).astype(np.int32)
    heads = np.concatenate([[0], np.full(n + 1, len(ids))]).astype(np.int32)
    listed = lambda at, values, kind: pa.ListArray.from_arrays(pa.array(at), pa.array(values, kind))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([name] * (n + 1)),
            pa.concat_arrays([pa.nulls(1, pa.string()), flat.dictionary.cast(pa.string())]),
            listed(bounds, doc, pa.int32()),
            listed(bounds, tf, pa.int32()),
            listed(heads, [ids[i] for i in order.tolist()], pa.int64()),
            listed(heads, ms, pa.int64()),
        ],
        names=_BLOCKS.names,
    )


def build(docs: DataFrame, text: str = "text", block_postings: int = BLOCK_POSTINGS) -> Index:
    """Indexes every row of ``docs`` (doc_id and the text, whole).

    Texts without a term, null ones among them, are in no statistics and never found. Rows of a repeated doc_id are
    documents of their own; a null doc_id is kept.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    total = docs.select(n_terms("text").alias("n")).where("n > 0").agg(F.count("*").alias("d"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    n_docs, n_all = total.first()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, value in zip(pieces(batch["doc_id"]), pieces(batch["text"])):
                own = terms(value) if value else []
                if not own:
                    continue
                if ids and size + len(own) > block_postings:
                    yield _block(f"{part}-{number}", ids, texts, n_docs, n_all)
                    ids, texts, size, number = [], [], 0, number + 1
                ids.append(doc_id)
                texts.append(own)
                size += len(own)
        if ids:
            yield _block(f"{part}-{number}", ids, texts, n_docs, n_all)

    return Index(materialize(docs.mapInArrow(blocks, _BLOCKS), "lexical-index"), n_docs, n_all)


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    sizes = ends - starts
    return np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())


class Block:
    """A block's postings of some terms, ready to answer queries."""

    def __init__(self, ids: np.ndarray, ms: np.ndarray, lists: list[tuple[np.ndarray, np.ndarray]]):
        self.ids = ids
        self.n_strata = int(np.count_nonzero(np.diff(ms))) + 1
        self.stratum_of = np.concatenate([[0], np.cumsum(np.diff(ms) != 0)])
        sizes = np.fromiter((len(d) for d, _ in lists), np.int64, len(lists))
        self.docs = np.concatenate([*(d for d, _ in lists), np.zeros(0, np.int32)]).astype(np.int64)
        tf = np.concatenate([*(t for _, t in lists), np.zeros(0, np.int32)]).astype(np.int64)
        term = np.repeat(np.arange(len(lists)), sizes)
        stratum = self.stratum_of[self.docs]
        new_list = np.ones(len(term), bool)
        new_list[1:] = (term[1:] != term[:-1]) | (stratum[1:] != stratum[:-1])
        new_tf = new_list.copy()
        new_tf[1:] |= tf[1:] != tf[:-1]
        firsts = np.flatnonzero(new_tf)  # an impact for each tf of a list, not for each posting
        self.impacts = np.repeat(impact(tf[firsts], ms[self.docs[firsts]]), np.diff(firsts, append=len(term)))
        self.heads = np.flatnonzero(new_list)
        self.tails = np.append(self.heads[1:], len(term))
        self.head_stratum = stratum[self.heads]
        self.head_bounds = np.searchsorted(term[self.heads], np.arange(len(lists) + 1))

    def best(self, chosen: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best documents above 0 for the terms numbered ``chosen``, and all that tie with the last."""
        heads = _ranges(self.head_bounds[chosen], self.head_bounds[chosen + 1])
        w = np.repeat(weights, self.head_bounds[chosen + 1] - self.head_bounds[chosen])
        heads, w = heads[w > 0], w[w > 0]
        bounds = np.zeros(self.n_strata, np.int64)
        np.add.at(bounds, self.head_stratum[heads], w * self.impacts[self.heads[heads]])
        visits = np.argsort(-bounds, kind="stable")
        visits = visits[bounds[visits] > 0]
        turn = np.full(self.n_strata, len(visits))
        turn[visits] = np.arange(len(visits))
        order = np.argsort(turn[self.head_stratum[heads]], kind="stable")
        heads, w = heads[order], w[order]
        turns = turn[self.head_stratum[heads]]
        found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, step = 0, 4
        while at < len(visits):
            if len(scores) >= k and bounds[visits[at]] < scores[-1]:
                break
            a, b = np.searchsorted(turns, [at, at + step])
            starts, ends = self.heads[heads[a:b]], self.tails[heads[a:b]]
            postings = _ranges(starts, ends)
            docs = self.docs[postings]
            gains = np.repeat(w[a:b], ends - starts) * self.impacts[postings]
            # float sums are exact: a document's score is far below 2 ** 53
            total = np.bincount(docs, gains, len(self.ids))
            new = np.flatnonzero(total)
            found, scores = np.concatenate([found, new]), np.concatenate([scores, total[new].astype(np.int64)])
            found, scores = _top(found, scores, k)
            at, step = at + step, 2 * step
        return found, scores


def _top(found: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best and those that tie with the last of them, best first."""
    if len(scores) > k:
        kept = scores >= np.partition(scores, -k)[-k]
        found, scores = found[kept], scores[kept]
    order = np.argsort(-scores, kind="stable")
    return found[order], scores[order]


def _grouped(items: DataFrame, per_search: int) -> list[pa.Table]:
    """Items (a number, their row's id and terms) in groups of about ``per_search`` terms, a group at a time."""
    sized = items.withColumn("_upto", F.size("terms"))
    total = sized.agg(F.coalesce(F.sum("_upto"), F.lit(0))).first()[0]
    groups = max(-(-total // per_search), 1)
    for g in range(groups):
        part = items if groups == 1 else items.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(groups)) == g)
        yield part.toArrow().combine_chunks()


@F.arrow_udf(T.ArrayType(T.StringType()))
def distinct_terms(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([sorted({w.decode() for w in terms(t)}) if t else [] for t in pieces(batch)], pa.list_(pa.string()))


def _answering(queries, k: int):
    """The function that answers all of a group's queries from the rows of one block."""

    def answer(block: pa.Table) -> pa.Table:
        number, own, by_number = queries.value
        head = pc.is_null(block["term"])
        first = block.filter(head).slice(0, 1)
        rest = block.filter(pc.invert(head))
        here = np.full(len(number) + 1, -1, np.int64)
        lists = []
        docs, tfs = rest["docs"].combine_chunks(), rest["tfs"].combine_chunks()
        for i, t in enumerate(rest["term"].to_pylist()):
            here[number[t]] = i
            lists.append((docs[i].values.to_numpy(), tfs[i].values.to_numpy()))
        ids = first["ids"].combine_chunks().flatten().fill_null(_NONE).to_numpy()
        made = Block(ids, first["ms"].combine_chunks().flatten().to_numpy(), lists)
        parts = [np.zeros((3, 0), np.int64)]
        for item, asked in enumerate(own):
            at = here[asked]
            if (at >= 0).any():
                places, scores = made.best(at[at >= 0], by_number[asked[at >= 0]], k)
                best = np.lexsort((ids[places], -scores))[:k]
                parts.append(np.stack([np.full(len(best), item), ids[places[best]], scores[best]]))
        rows = np.concatenate(parts, axis=1)
        doc_id = pa.array(rows[1], mask=rows[1] == _NONE)
        return pa.table({"item": pa.array(rows[0], pa.int32()), "doc_id": doc_id, "score": pa.array(rows[2])})

    return answer


def search(index: Index, items: DataFrame, k: int = 10, query_terms: int = QUERY_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents for each row of ``items`` (item_id and text).

    Only scores above 0 count; equal scores rank by ascending doc_id, a null one first. A null item_id stays; rows of a
    repeated item_id are ranked together if their terms are the same, else each for itself under a rank of its own. An
    item without terms finds nothing. About ``query_terms`` terms of items are searched at a time.
    """
    spark = index.blocks.sparkSession
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), distinct_terms("text").alias("terms"))
    asked = materialize(asked.where(F.size("terms") > 0).distinct(), "items")
    schema = "item int, doc_id long, score long"
    out = []
    for group in _grouped(asked, query_terms):
        words = pc.unique(group["terms"].combine_chunks().flatten())
        wanted = F.broadcast(spark.createDataFrame(pa.table({"term": words}), "term string"))  # bounded by query_terms
        lists = index.blocks.where("term is not null").join(wanted, "term")
        found = lists.groupBy("term").agg(F.sum(F.size("docs")).alias("df")).toArrow()
        weights = dict(zip(found["term"].to_pylist(), (weight(index.n_docs, df) for df in found["df"].to_pylist())))
        number = {t: i for i, t in enumerate(weights)}
        own = [np.array([number[t] for t in ts if t in number], np.int64) for ts in group["terms"].to_pylist()]
        by_number = np.fromiter(weights.values(), np.int64, len(weights))
        queries = spark.sparkContext.broadcast((number, own, by_number))

        heads = index.blocks.where("term is null")
        found = lists.select(heads.columns).unionByName(heads).groupBy("block").applyInArrow(_answering(queries, k), schema)
        numbered = pa.table({"item": pa.array(range(len(group)), pa.int32()), "item_id": group["item_id"]})
        names = F.broadcast(spark.createDataFrame(numbered, "item int, item_id long"))
        order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        out.append(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return reduce(DataFrame.unionByName, out)
