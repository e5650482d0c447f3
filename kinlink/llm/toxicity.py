"""Toxicity by a classifier chain: linear models in a row, each fed with the probabilities of those before it.

Categories are predicted one after the other. The model of a category is logistic over word features and the earlier
categories' probabilities. While training, those probabilities are out of fold: each labelled text gets them from models
that have not seen it, so that later models do not trust them more than they deserve. The last category is the verdict.

Features are the hashed words of the whole text and their first 4, 5 and 6 bytes, so that a stem counts with any ending.
Models are fitted on the driver from a sample of labelled rows of documented size; all texts are scored in the cluster.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinlink.llm.common import NOT_WORD, HashedWords, pieces, slices

BITS = 20
STEMS = (4, 5, 6)
#: Words that tell which kind of abuse a labelled toxic text has (fixed values; a parameter of ``fit``).
CATEGORIES = {
    "insult": ("idiot", "stupid", "moron", "loser", "clown"),
    "contempt": ("worthless", "pathetic", "disgusting"),
    "dehumanising": ("scum", "trash", "vermin"),
}
#: Labelled texts that a feature must occur in to count.
LEAST_TEXTS = 4
#: Labelled rows of each class that a fit reads at most, taken in the order of a hash of doc_id.
MOST_TOXIC, MOST_CLEAN = 2_000, 4_000


def feature_lists(texts: list[str], wanted: np.ndarray | None = None) -> list[np.ndarray]:
    """The distinct features of each text, ascending; with ``wanted`` (a flag for each feature) only those."""
    words = HashedWords(texts, NOT_WORD)
    mask = np.uint64((1 << BITS) - 1)
    parts = []
    for n in (None, *STEMS):
        found, text = words.hashes(n, seed=n or 0) & mask, words.text
        if wanted is not None:
            hit = wanted[found]
            found, text = found[hit], text[hit]
        parts.append(text.astype(np.uint64) << np.uint64(BITS) | found)
    keys = np.unique(np.concatenate(parts))
    cuts = np.searchsorted(keys, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(BITS))
    keys = (keys & mask).astype(np.int32)
    return [keys[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def word_feature(word: str) -> int:
    return int(HashedWords([word], NOT_WORD).hashes()[0] & np.uint64((1 << BITS) - 1))


@dataclass
class Linear:
    """Logistic regression over some of the features and the earlier categories' probabilities."""

    chosen: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def score(self, rows: np.ndarray, features: np.ndarray, n: int, before: np.ndarray) -> np.ndarray:
        """Probabilities of ``n`` texts; (rows, features) are their distinct features."""
        at = np.minimum(np.searchsorted(self.chosen, features), max(len(self.chosen) - 1, 0))
        hit = self.chosen[at] == features if len(self.chosen) else np.zeros(len(features), bool)
        total = np.bincount(rows[hit], self.weights[at[hit]], n) + before @ self.earlier + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def fit_linear(rows, features, n, before, target, most=2_000, least=4, steps=250, strength=0.005) -> Linear:
    """Chooses the features that go most with ``target``, then descends the penalised loss with momentum."""
    positive = target.astype(bool)
    with_it = np.bincount(features[positive[rows]], minlength=1 << BITS)
    without = np.bincount(features[~positive[rows]], minlength=1 << BITS)
    n1, n0 = max(positive.sum(), 1), max((~positive).sum(), 1)
    gap = np.abs(with_it / n1 - without / n0) / np.sqrt((with_it + without + 1.0) / n / n)
    gap[with_it + without < least] = 0
    order = np.argsort(-gap, kind="stable")[:most]
    chosen = np.sort(order[gap[order] > 0]).astype(np.int32)
    at = np.minimum(np.searchsorted(chosen, features), max(len(chosen) - 1, 0))
    hit = chosen[at] == features if len(chosen) else np.zeros(len(features), bool)
    r, c = rows[hit], at[hit]
    k = before.shape[1]
    w, move = np.zeros(len(chosen) + k), np.zeros(len(chosen) + k)
    bias = move_b = 0.0
    weight = np.where(positive, 0.5 / n1, 0.5 / n0)
    rate = 4.0
    for _ in range(steps):
        ahead, ahead_b = w + 0.9 * move, bias + 0.9 * move_b
        total = np.bincount(r, ahead[: len(chosen)][c], n) + before @ ahead[len(chosen) :] + ahead_b
        error = (1 / (1 + np.exp(-np.clip(total, -40, 40))) - target) * weight
        slope = np.concatenate([np.bincount(c, error[r], len(chosen)), before.T @ error])
        move = 0.9 * move - rate * (slope + strength * 0.05 * ahead)
        move_b = 0.9 * move_b - rate * error.sum()
        w, bias = w + move, bias + move_b
    return Linear(chosen, w[: len(chosen)], w[len(chosen) :], float(bias))


@dataclass
class Chain:
    names: list[str]
    models: list[Linear]
    held_out: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    def features(self) -> np.ndarray:
        """A flag for each feature that any model looks at."""
        used = np.zeros(1 << BITS, bool)
        for model in self.models:
            used[model.chosen] = True
        return used

    def predict(self, lists: list[np.ndarray]) -> np.ndarray:
        """Probabilities, a row for each text and a column for each category in order."""
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        rows = np.repeat(np.arange(len(lists)), sizes)
        features = np.concatenate([*lists, np.zeros(0, np.int32)])
        out = np.zeros((len(lists), 0))
        for model in self.models:
            out = np.column_stack([out, model.score(rows, features, len(lists), out)])
        return out


def fit_chain(lists: list[np.ndarray], targets: dict[str, np.ndarray], folds: int = 3, weights: np.ndarray | None = None) -> Chain:
    """Fits the categories in the order of ``targets``. A category without examples of both kinds is constant.

    ``weights`` says for how many labelled rows each text stands when the threshold is chosen.
    """
    n = len(lists)
    rows = np.repeat(np.arange(n, dtype=np.int32), np.fromiter(map(len, lists), np.int64, n))
    features = np.concatenate([*lists, np.zeros(0, np.int32)])
    texts_with = np.bincount(features, minlength=1 << BITS)
    useful = (texts_with >= LEAST_TEXTS)[features]
    rows, features = rows[useful], features[useful]
    fold = np.random.default_rng(n).permutation(n) % folds
    before, models, held_out = np.zeros((n, 0)), [], {}
    for name, target in targets.items():
        target = np.asarray(target, float)
        out_of_fold = np.zeros(n)
        for k in range(folds):
            mine, rest = fold == k, fold != k
            took = rest[rows]
            place = (np.cumsum(rest) - 1).astype(np.int32)
            model = fit_linear(place[rows[took]], features[took], int(rest.sum()), before[rest], target[rest])
            took = mine[rows]
            place = (np.cumsum(mine) - 1).astype(np.int32)
            out_of_fold[mine] = model.score(place[rows[took]], features[took], int(mine.sum()), before[mine])
        models.append(fit_linear(rows, features, n, before, target))
        held_out[name] = float(((out_of_fold >= 0.5) == (target > 0)).mean()) if n else 1.0
        before = np.column_stack([before, out_of_fold])
    return Chain(list(targets), models, held_out, best_threshold(out_of_fold, target, weights) if targets else 0.5)


def best_threshold(probability: np.ndarray, target: np.ndarray, weights: np.ndarray | None = None) -> float:
    """The threshold with the least weight of errors out of fold; of several the middle of the widest gap."""
    order = np.argsort(probability, kind="stable")
    p, t = probability[order], target[order] > 0
    w = np.ones(len(p)) if weights is None else weights[order]
    errors = w[~t].sum() + np.concatenate([[0.0], np.cumsum(np.where(t, w, -w))])  # the first i are let through
    edges = np.concatenate([[0.0], p, [1.0]])
    gaps = np.where(errors <= errors.min() + 1e-9 * w.sum(), np.diff(edges), -1)
    at = int(gaps.argmax())
    return float((edges[at] + edges[at + 1]) / 2)


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def text_features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        lists = [x for run in slices((t or "" for t in pieces(batch)), 1_000_000) for x in feature_lists(run)]
        ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
        yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*lists, np.zeros(0, np.int32)])))


def labelled_sample(docs: DataFrame, labels: DataFrame, most_toxic: int, most_clean: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Features and labels of at most so many labelled rows of each class, and for how many rows of its class each stands.

    A repeated id counts with one of its texts, that of the least digest, and equal texts count once.
    """
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    ids = None
    for value, most in ((1, most_toxic), (0, most_clean)):
        part = known.where(F.col("toxic") == value).orderBy(*order).limit(most)
        ids = part if ids is None else ids.unionByName(part)
    spark = docs.sparkSession
    taken = [(r["doc_id"], r["toxic"]) for r in ids.collect()]
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    ids = spark.createDataFrame(taken, "doc_id long, toxic int")
    texts = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    one = texts.groupBy("doc_id", "toxic").agg(F.min_by(text_features("text"), F.xxhash64("text")).alias("features"))
    found = one.toArrow().combine_chunks()
    order = np.argsort(found["doc_id"].to_numpy(), kind="stable")
    toxic, lists = found["toxic"].to_numpy(), found["features"]
    kept, seen = [], set()
    for i in order.tolist():
        own = lists[i].values.to_numpy()
        key = (int(toxic[i]), hash(own.tobytes()))
        if key not in seen:
            seen.add(key)
            kept.append((own, int(toxic[i])))
    labels = np.array([label for _, label in kept], int)
    stands_for = np.array([counts.get(value, 0) / max((labels == value).sum(), 1) for value in (0, 1)])
    return [own for own, _ in kept], labels.astype(float), stands_for[labels]


def fit(docs: DataFrame, labels: DataFrame, categories: dict[str, tuple[str, ...]] | None = None, most_toxic: int = MOST_TOXIC, most_clean: int = MOST_CLEAN) -> Chain:
    """Fits the chain on labelled rows: ``labels`` has doc_id and toxic (0 or 1), ``docs`` has doc_id and text.

    A toxic text is of a category if it has one of the category's words; the last category, ``toxic``, is the label. Rows
    without text or label are left out; without any labelled row the chain rejects nothing.
    """
    lists, toxic, weights = labelled_sample(docs, labels, most_toxic, most_clean)
    targets = {}
    for name, words in (CATEGORIES if categories is None else categories).items():
        seeds = np.array([word_feature(w) for w in words])
        targets[name] = toxic * np.array([bool(np.isin(seeds, f).any()) for f in lists], float)
    targets["toxic"] = toxic
    if not toxic.any() or toxic.all():
        never = Linear(np.zeros(0, np.int32), np.zeros(0), np.zeros(0), -40.0)
        return Chain(list(targets), [Linear(never.chosen, never.weights, np.zeros(i), -40.0) for i in range(len(targets))])
    return fit_chain(lists, targets, weights=weights)


def scored(docs: DataFrame, chain: Chain, text: str = "text", into: str = "toxicity", threshold: float | None = None) -> DataFrame:
    """``docs`` with a struct column of each category's probability and the verdict ``rejected``.

    A text is rejected from ``threshold`` up, or else from the chain's own, which had the fewest errors out of fold at the
    labels' own class shares.
    Null and empty texts are scored like a text without words; all columns of ``docs`` stay (one named ``into`` is
    replaced).
    """
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def probabilities(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        used = own.features()
        for batch in batches:
            runs = [own.predict(feature_lists(r, used)) for r in slices((t or "" for t in pieces(batch)), 1_000_000)]
            flat = np.concatenate([*(r.ravel() for r in runs), np.zeros(0)])
            ends = np.arange(len(batch) + 1, dtype=np.int32) * len(own.names)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    raw = f"_{into}_raw"
    while raw in docs.columns:
        raw = "_" + raw
    each = [F.col(raw)[i].alias(name) for i, name in enumerate(chain.names)]
    verdict = (F.col(raw)[len(chain.names) - 1] >= (chain.threshold if threshold is None else threshold)).alias("rejected")
    return docs.withColumn(raw, probabilities(F.col(f"`{text}`"))).withColumn(into, F.struct(*each, verdict)).drop(raw)
