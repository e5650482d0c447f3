"""Quality by compression: a text is like the labelled texts whose dictionary makes it smaller.

Two Zstandard dictionaries are trained, one from good and one from bad labelled texts. A text is cut into pieces of
``PIECE`` bytes, each is compressed alone with either dictionary, and the sizes are summed over the whole text: alone, so
that a dictionary counts as much at the end of a long text as at its beginning. What both sizes say is brought to numbers
that do not depend on the length: the difference of the sizes over their sum, the difference over the length, and the
smaller size over the length (texts that repeat themselves become small with either dictionary). A logistic curve over
these turns them into the probability of the label 1.

The curve is fitted out of fold: dictionaries know their own training texts by heart, so each half of the labelled texts
is measured with dictionaries of the other half.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinlink.llm.common import pieces

#: Bytes that are compressed at once, and of a dictionary.
PIECE, DICTIONARY = 1024, 65_536
LEVEL = 3
#: Labelled texts of each class that a fit reads at most, in the order of a hash of doc_id, and pieces of each of them,
#: evenly spread over the text.
MOST_TEXTS, MOST_PIECES = 2_000, 16
GOOD, BAD = 1, 0


def cut(text: bytes) -> list[bytes]:
    return [text[i : i + PIECE] for i in range(0, len(text), PIECE)]


def train(samples: list[bytes]) -> bytes:
    """A dictionary from pieces of text; from too few of them their bytes themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False)


@dataclass
class Sizes:
    """Measures pieces of text with a dictionary of either class."""

    good: bytes
    bad: bytes

    def __post_init__(self):
        self._by_good, self._by_bad = compressor(self.good), compressor(self.bad)

    def __reduce__(self):
        return Sizes, (self.good, self.bad)

    def of(self, parts: list[bytes]) -> tuple[int, int, int]:
        """Bytes as they are, by the good dictionary and by the bad one."""
        good, bad = self._by_good.compress, self._by_bad.compress
        return sum(map(len, parts)), sum(len(good(p)) for p in parts), sum(len(bad(p)) for p in parts)


def measures(sizes: np.ndarray) -> np.ndarray:
    """Length-free numbers from rows of (bytes, by good, by bad); all zero for an empty text."""
    raw, good, bad = sizes.astype(float).T
    some = np.maximum(raw, 1)
    sure = raw / (raw + 64.0)  # few bytes say little
    gap, share = (bad - good) / np.maximum(bad + good, 1), np.minimum(good, bad) / some
    return np.column_stack([gap, (bad - good) / some, share * (raw > 0), np.log(np.maximum(share, 1e-3)) * (raw > 0), sure])


def expanded(x: np.ndarray) -> np.ndarray:
    i, j = np.triu_indices(x.shape[1])
    return np.column_stack([x, x[:, i] * x[:, j]])


@dataclass
class Classifier:
    sizes: Sizes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    share: float  #: of the label 1, which is what a text without bytes scores

    def score(self, sizes: np.ndarray) -> np.ndarray:
        x = (expanded(measures(sizes)) - self.mean) / self.scale
        return np.where(sizes[:, 0] > 0, 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30))), self.share)


def _logistic(x: np.ndarray, y: np.ndarray, importance: np.ndarray, ridge: float = 1.0, steps: int = 60) -> tuple[np.ndarray, float]:
    """Weights and bias by Newton's method; ``ridge`` weighs as much as so many texts and keeps the weights finite."""
    full = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(full.shape[1])
    penalty = np.full(len(w), ridge / len(x))
    penalty[-1] = 1e-9
    share = importance / importance.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -30, 30)))
        slope = full.T @ (share * (p - y)) + penalty * w
        curve = (full * (share * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ full + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def _dictionaries(texts: list[list[bytes]], label: np.ndarray) -> Sizes:
    return Sizes(*(train([p for t, own in zip(texts, label) if own == c for p in t if len(p) >= 8]) for c in (GOOD, BAD)))


def fit_texts(texts: list[list[bytes]], label: np.ndarray, importance: np.ndarray) -> Classifier:
    """``texts`` as their pieces, their labels and for how many labelled rows each stands.

    Without texts of both classes the score is that of the one class there is, a half without any label.
    """
    n = expanded(measures(np.zeros((1, 3)))).shape[1]
    if len({*label.tolist()}) < 2:
        share = float(label.mean()) if len(label) else 0.5
        return Classifier(Sizes(b"", b""), np.zeros(n), np.ones(n), np.zeros(n), 60 * share - 30, share)
    order = np.lexsort((np.arange(len(label)), label))
    half = np.zeros(len(label), int)
    half[order] = np.arange(len(label)) % 2  # either half has its share of both classes
    sizes = np.zeros((len(label), 3))
    for k in (0, 1):
        other = _dictionaries([t for t, h in zip(texts, half) if h != k], label[half != k])
        for i in np.flatnonzero(half == k).tolist():
            sizes[i] = other.of(texts[i])
    x = expanded(measures(sizes))
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    weights, bias = _logistic((x - mean) / scale, (label == GOOD).astype(float), importance)
    share = float(importance[label == GOOD].sum() / importance.sum())
    return Classifier(_dictionaries(texts, label), mean, scale, weights, bias, share)


def held_out(doc_id: str | Column = "doc_id", folds: int = 5) -> Column:
    """Whether the CRC-32 of the id in decimal is divisible by ``folds``; false for a null id."""
    own = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(own.cast("string").cast("binary")) % folds == 0, F.lit(False))


@F.arrow_udf(T.ArrayType(T.BinaryType()))
def _sampled_pieces(texts: pa.Array) -> pa.Array:
    out = []
    for text in pieces(texts):
        parts = cut((text or "").encode("utf-8", "surrogatepass"))
        at = np.unique(np.linspace(0, len(parts) - 1, MOST_PIECES).round().astype(int)) if len(parts) > MOST_PIECES else range(len(parts))
        out.append([parts[i] for i in at])
    return pa.array(out, pa.list_(pa.binary()))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most_texts: int = MOST_TEXTS) -> Classifier:
    """Fits on labelled documents that are not held out; ``docs`` has doc_id and text, ``labels`` doc_id and the label.

    Of each class at most ``most_texts`` ids are read, in the order of a hash of the id, so the labels of a growing table
    cost no more. An id with both labels counts as the greater one; of repeated rows of an id one text counts, the one
    with the least digest. Rows without a text, an id or a label of 0 or 1 do not count.
    """
    value = F.col(f"`{label}`")
    known = labels.where(value.isin(GOOD, BAD) & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max(value).alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    ids = None
    for own in (GOOD, BAD):
        part = known.where(F.col("label") == own).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_texts)
        ids = part if ids is None else ids.unionByName(part)
    # at most 2 * most_texts rows of two numbers
    met = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    one = met.groupBy("doc_id", "label").agg(F.min_by(_sampled_pieces("text"), F.xxhash64("text")).alias("pieces"))
    found = one.toArrow().combine_chunks().sort_by("doc_id")
    own = found["label"].to_numpy().astype(int)
    sampled = np.bincount(own, minlength=2)
    stands_for = np.array([counts.get(c, 0) / max(sampled[c], 1) for c in (0, 1)])
    return fit_texts(found["pieces"].to_pylist(), own, stands_for[own] if len(own) else np.zeros(0))


def scored(docs: DataFrame, classifier: Classifier, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the probability of the label 1 from the whole text.

    A null text is scored like an empty one, by the share of the label 1. All columns stay (one named ``into`` is replaced).
    """
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    @F.arrow_udf(T.DoubleType())
    def probability(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for batch in batches:
            sizes = [own.sizes.of(cut((t or "").encode("utf-8", "surrogatepass"))) for t in pieces(batch)]
            yield pa.array(own.score(np.array(sizes, float).reshape(-1, 3)))

    return docs.withColumn(into, probability(F.col(f"`{text}`")))
