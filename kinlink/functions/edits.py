"""Insertions and deletions between many pairs of texts at once, in numpy."""

import numpy as np
import pandas as pd

_CHUNK = 8192
#: Bits of a machine word that hold characters; the last one is the carry.
_BITS = 63
_TABLE_WORDS = 1 << 22


def code_points(texts) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts in one array, and the length of each text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32), lengths


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each range, one range after the other."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


def _matrix(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, pad: int) -> np.ndarray:
    out = np.full((len(starts), max(int(lengths.max()), 1)), pad, dtype=np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = codes[ranges(starts, lengths)]
    return out


def _lcs_chunk(left: np.ndarray, right: np.ndarray, len_a: np.ndarray, letters: int) -> np.ndarray:
    """Bit-parallel longest common subsequence, as many machine words per pair as the longest left text needs.

    ``left`` holds letters from 1 and 0 behind the end, ``right`` the same letters and ``letters + 1`` for all else.
    """
    one, carry_bit = np.uint64(1), np.uint64(_BITS)
    words = (left.shape[1] + _BITS - 1) // _BITS
    row = np.arange(len(left)) * (letters + 2)
    places = np.zeros((len(left) * (letters + 2), words), dtype=np.uint64)
    for i in range(left.shape[1]):
        places[row + left[:, i], i // _BITS] |= one << np.uint64(i % _BITS)
    used = np.clip(len_a[:, None] - _BITS * np.arange(words), 0, _BITS).astype(np.uint64)
    full = (one << used) - one
    state, whole = full.copy(), (one << carry_bit) - one
    for j in range(right.shape[1]):
        shared = state & places[row + right[:, j]]
        total = state + shared
        if words > 1:
            carry = total >> carry_bit
            while carry[:, :-1].any():
                total &= whole
                total[:, 1:] += carry[:, :-1]
                carry = total >> carry_bit
        state = (total | (state - shared)) & full
    return len_a - np.bitwise_count(state).sum(axis=1, dtype=np.int64)


def lcs_of_codes(codes: np.ndarray, start_a, len_a, start_b, len_b) -> np.ndarray:
    """Lengths of the longest common subsequences of pairs of stretches of ``codes``."""
    out = np.zeros(len(len_a), dtype=np.int64)
    if not len(codes):
        return out
    swap = len_a > len_b
    start_a, start_b = np.where(swap, start_b, start_a), np.where(swap, start_a, start_b)
    len_a, len_b = np.minimum(len_a, len_b), np.maximum(len_a, len_b)
    present = np.zeros(int(codes.max()) + 1, dtype=np.int64)
    present[codes] = 1
    letters = int(present.sum())
    codes = np.cumsum(present)[codes]
    words = (len_a + _BITS - 1) // _BITS
    order = np.lexsort((len_b, words))
    order = order[len_a[order] > 0]
    start = 0
    while start < len(order):
        most = 2 * words[order[start]]
        k = order[start : start + min(_CHUNK, max(1, int(_TABLE_WORDS // (most * (letters + 2)))))]
        k = k[words[k] <= most]
        left, right = _matrix(codes, start_a[k], len_a[k], 0), _matrix(codes, start_b[k], len_b[k], letters + 1)
        out[k] = _lcs_chunk(left, right, len_a[k], letters)
        start += len(k)
    return out


def lcs_lengths(a, b) -> np.ndarray:
    codes_a, len_a = code_points(a)
    codes_b, len_b = code_points(b)
    start_a, start_b = np.cumsum(len_a) - len_a, np.cumsum(len_b) - len_b + len(codes_a)
    return lcs_of_codes(np.concatenate([codes_a, codes_b]), start_a, len_a, start_b, len_b)


def ratio_from(lcs: np.ndarray, total: np.ndarray) -> np.ndarray:
    distance = total - 2 * lcs
    return 100.0 * (1.0 - distance / np.maximum(total, 1))


def indel_scores(a, b) -> np.ndarray:
    """Normalised insert/delete similarity; a null on either side scores 0, two empty texts 100."""
    a, b = np.asarray(a, dtype=object), np.asarray(b, dtype=object)
    known = ~(pd.isna(a) | pd.isna(b))
    out = np.zeros(len(a))
    x, y = a[known], b[known]
    score = np.full(len(x), 100.0)
    differ = x != y
    x, y = x[differ], y[differ]
    total = np.fromiter(map(len, x), np.int64, len(x)) + np.fromiter(map(len, y), np.int64, len(y))
    score[differ] = ratio_from(lcs_lengths(x, y), total)
    out[known] = score
    return out
