"""Byte ranges and exact hashes of words, for operators that have to give words back."""

import numpy as np

from staypath.llm.words import Powers, mix

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def separators(values: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(values)] = True
    return table


def word_spans(data: np.ndarray, starts: np.ndarray, apart: np.ndarray, lower: bool = False):
    """Begins, ends and 64-bit hashes of the words of a chunk, and per text where its words start.

    Words are runs of bytes that ``apart`` does not name; no word goes from one text into the next. ``lower``
    folds A-Z for the hash; the bytes themselves stay as they are.
    """
    n = len(data)
    if not n:
        none = np.empty(0, dtype=np.int64)
        return none, none, np.empty(0, dtype=np.uint64), np.zeros(len(starts), dtype=np.int64)
    word = ~apart[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    first = starts[:-1][starts[:-1] < n]
    begins[first] = word[first]
    ends = np.zeros(n + 1, dtype=bool)
    ends[1:n][word[:-1] & (~word[1:] | begins[1:])] = True
    ends[n] = word[-1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends)
    up, down = Powers.of(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(((_LOWER[data] if lower else data).astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:], dtype=np.uint64)
    return begin, end, mix((sums[end] - sums[begin]) * down[begin]), np.searchsorted(begin, starts)


def gathered(data: np.ndarray, begin: np.ndarray, end: np.ndarray, after: np.ndarray, filler: int = 32):
    """Bytes of the ranges one after another, ``after`` (0 or 1) filler bytes behind each, and where each range starts."""
    size = end - begin + after
    start = np.zeros(len(size) + 1, dtype=np.int64)
    np.cumsum(size, out=start[1:])
    at = np.repeat(begin - start[:-1], size) + np.arange(start[-1])
    out = data[np.minimum(at, max(len(data) - 1, 0))] if len(data) else np.empty(0, dtype=np.uint8)
    out[start[1:][after > 0] - 1] = filler
    return out, start
