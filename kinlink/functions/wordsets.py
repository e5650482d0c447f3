"""Texts as sets of words, and the word-set ratio of many pairs at once."""

import numpy as np

from kinlink.functions.edits import code_points, lcs_of_codes, ranges, ratio_from


class Vocabulary:
    """The words of some texts in alphabetical order, each stored with a space behind it."""

    def __init__(self, *sides):
        self.sets = [[sorted(set(t.split())) for t in texts] for texts in sides]
        words = sorted({w for rows in self.sets for row in rows for w in row})
        self.ids = {w: i for i, w in enumerate(words)}
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.codes = code_points([w + " " for w in words])[0]
        self.starts = np.cumsum(self.lengths + 1) - self.lengths - 1

    def __len__(self):
        return len(self.ids)

    def sides(self) -> list["WordSets"]:
        return [WordSets(self, rows) for rows in self.sets]


class WordSets:
    """Rows of ascending word ids, one after the other."""

    def __init__(self, vocabulary: Vocabulary, rows: list[list[str]]):
        self.vocabulary = vocabulary
        self.counts = np.fromiter(map(len, rows), np.int64, len(rows))
        self.starts = np.cumsum(self.counts) - self.counts
        self.words = np.array([vocabulary.ids[w] for row in rows for w in row], dtype=np.int64)
        self.keys = np.repeat(np.arange(len(rows)), self.counts) * len(vocabulary) + self.words

    def compared(self, i: np.ndarray, other: "WordSets", j: np.ndarray) -> tuple[np.ndarray, ...]:
        """For rows ``i`` beside rows ``j`` of the other side, pair by pair: how many words they share, the letters of these,
        and the codes, starts and lengths of the texts of the words that only this side has."""
        v = self.vocabulary
        pair = np.repeat(np.arange(len(i)), self.counts[i])
        word = self.words[ranges(self.starts[i], self.counts[i])]
        sought = j[pair] * len(v) + word
        shared = np.zeros(len(sought), dtype=bool)
        if len(other.keys):
            at = np.minimum(np.searchsorted(other.keys, sought), len(other.keys) - 1)
            shared = other.keys[at] == sought
        many = np.bincount(pair[shared], minlength=len(i))
        letters = np.bincount(pair[shared], weights=v.lengths[word[shared]], minlength=len(i)).astype(np.int64)
        own, word = pair[~shared], word[~shared]
        sizes = np.bincount(own, weights=v.lengths[word] + 1, minlength=len(i)).astype(np.int64)
        codes = v.codes[ranges(v.starts[word], v.lengths[word] + 1)]
        return many, letters, codes, np.cumsum(sizes) - sizes, np.maximum(sizes - 1, 0)


def best_ratio(lcs, many, letters, len_a, len_b) -> np.ndarray:
    """The best of three ratios, given what the rests have in common: the shared words with both rests, and the shared words
    with either rest alone. It grows with ``lcs``."""
    common = letters + np.maximum(many - 1, 0)
    gap = (many > 0).astype(np.int64)
    best = ratio_from(lcs + common + gap, 2 * (common + gap) + len_a + len_b)
    for rest in (len_a, len_b):
        best = np.where(many > 0, np.maximum(best, ratio_from(common, 2 * common + gap + rest)), best)
    return np.where((many > 0) & ((len_a == 0) | (len_b == 0)), 100.0, best)


def pair_scores(x: WordSets, i: np.ndarray, y: WordSets, j: np.ndarray) -> np.ndarray:
    """Word-set ratio of rows ``i`` and ``j``; a row without words scores 0."""
    many, letters, codes_a, start_a, len_a = x.compared(i, y, j)
    _, _, codes_b, start_b, len_b = y.compared(j, x, i)
    open_pairs = (len_a > 0) & (len_b > 0)
    lcs = np.zeros(len(i), dtype=np.int64)
    lcs[open_pairs] = lcs_of_codes(
        np.concatenate([codes_a, codes_b]),
        start_a[open_pairs],
        len_a[open_pairs],
        start_b[open_pairs] + len(codes_a),
        len_b[open_pairs],
    )
    return np.where((x.counts[i] > 0) & (y.counts[j] > 0), best_ratio(lcs, many, letters, len_a, len_b), 0.0)


def token_set_scores(a, b) -> np.ndarray:
    """Best of three insert/delete ratios over shared and unshared words; 100 if one side's words are all shared."""
    texts = list({*a, *b})
    row = {t: k for k, t in enumerate(texts)}
    (sets,) = Vocabulary(texts).sides()
    i, j = (np.fromiter((row[t] for t in side), np.int64, len(side)) for side in (a, b))
    return pair_scores(sets, i, sets, j)
