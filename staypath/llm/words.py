"""Vectorised reading of text columns inside tasks: bytes, words and shingles of many documents at once."""

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
CHUNK_BYTES = 1 << 20
SPACES = b" \t\n\v\f\r"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(SPACES)] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


class Powers:
    """Powers of the hash base and of its inverse, kept for the longest chunk seen."""

    up = down = np.empty(0, dtype=np.uint64)

    @classmethod
    def of(cls, n: int):
        if len(cls.up) < n:
            size = max(n, CHUNK_BYTES + 1)
            cls.up, cls.down = _powers(BASE, size), _powers(pow(BASE, -1, 1 << 64), size)
        return cls.up, cls.down


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row, and where each text starts (one entry more than texts); null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return data, offsets


def chunks(column: pa.Array, limit: int = CHUNK_BYTES):
    """(first text, texts' bytes, their starts) for runs of texts of about ``limit`` bytes; a text is never cut."""
    data, offsets = text_buffer(column)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        yield first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every lower-cased word of a chunk, and per text where its words start.

    Words are runs of bytes other than space and 0x09 to 0x0D; A-Z is lower-cased.
    """
    return word_heads(data, starts, ())[:2]


def word_heads(data: np.ndarray, starts: np.ndarray, lengths: tuple[int, ...]):
    """As ``word_hashes``, and for each length a hash of that many bytes at the beginning of each word.

    A word that is not longer has its own hash there.
    """
    n = len(data)
    if not n:
        none = np.empty(0, dtype=np.uint64)
        return none, np.zeros(len(starts), dtype=np.int64), [none for _ in lengths]
    word = ~_SPACE[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    begins[starts[:-1][starts[:-1] < n]] = word[starts[:-1][starts[:-1] < n]]
    ends = np.zeros(n + 1, dtype=bool)
    ends[1:n][word[:-1] & (~word[1:] | begins[1:])] = True
    ends[n] = word[-1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends)
    up, down = Powers.of(n + 1)
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:], dtype=np.uint64)
    hashed = lambda stop: mix((sums[stop] - sums[begin]) * down[begin])
    return hashed(end), np.searchsorted(begin, starts), [hashed(np.minimum(begin + k, end)) for k in lengths]


def shingle_hashes(words: np.ndarray, starts: np.ndarray, size: int = 5):
    """Hashes of all runs of ``size`` words and per text where they start.

    A text with fewer words, but at least one, has its whole word sequence as the only shingle.
    """
    counts = np.diff(starts)
    out = np.zeros(max(0, len(words) - size + 1), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = out * np.uint64(BASE) + words[k:len(words) - size + 1 + k]
    out = mix(out)
    whole = np.repeat(counts >= size, counts)
    left = np.repeat(starts[1:], counts) - np.arange(len(words))
    at = np.flatnonzero(whole & (left >= size))
    hashes, owner = out[at], np.repeat(np.arange(len(counts)), counts)[at]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        extra = np.empty(len(short), dtype=np.uint64)
        for i, t in enumerate(short):
            h = int(counts[t])
            for w in words[starts[t]:starts[t + 1]]:
                h = (h * BASE + int(w)) & 0xFFFFFFFFFFFFFFFF
            extra[i] = h
        hashes, owner = np.concatenate([hashes, mix(extra)]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        hashes, owner = hashes[order], owner[order]
    return hashes, np.searchsorted(owner, np.arange(len(counts) + 1))


class Table:
    """Hash table from 64-bit keys to positions in a value array, queried many keys at a time."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 3))))
        self.slots = np.full(1 << self.bits, -1, dtype=np.int32)
        self.keys = keys
        left, step = np.arange(len(keys), dtype=np.int32), 0
        while len(left):
            slot = self._slot(keys[left], step)
            free = self.slots[slot] < 0
            self.slots[slot[free]] = left[free]
            left, step = left[self.slots[slot] != left], step + 1
        self.steps = step

    def _slot(self, keys, step):
        return ((keys >> np.uint64(64 - self.bits)) + np.uint64(step)).astype(np.int64) & ((1 << self.bits) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 where it is not held."""
        out = np.full(len(keys), -1, dtype=np.int32)
        if not len(self.keys):
            return out
        left = np.arange(len(keys))
        for step in range(self.steps):
            at = self.slots[self._slot(keys[left], step)]
            hit = (at >= 0) & (self.keys[at] == keys[left])
            out[left[hit]] = at[hit]
            left = left[(at >= 0) & ~hit]
            if not len(left):
                break
        return out


def joined(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """A list of texts as one chunk; null is empty."""
    texts = [t or b"" for t in texts]
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    return np.frombuffer(b"".join(texts), dtype=np.uint8), starts


class Counts:
    """Counts of 64-bit keys, summed up as they come; memory follows the distinct keys."""

    def __init__(self):
        self.keys = [np.empty(0, dtype=np.uint64)]
        self.counts = [np.empty(0, dtype=np.int64)]
        self.waiting = self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None):
        self.keys.append(keys)
        self.counts.append(np.ones(len(keys), dtype=np.int64) if counts is None else counts)
        self.waiting += len(keys)
        if self.waiting > 500_000 + self.size:
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, dtype=np.int64)
        self.keys, self.counts = [keys[first]], [np.add.reduceat(counts, first) if len(first) else counts]
        self.waiting, self.size = 0, len(first)
        return self.keys[0], self.counts[0]


def unmix(h: np.ndarray) -> np.ndarray:
    """Inverse of ``mix``."""
    h = h ^ (h >> np.uint64(31)) ^ (h >> np.uint64(62))
    h = h * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    h = h ^ (h >> np.uint64(27)) ^ (h >> np.uint64(54))
    h = h * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return h ^ (h >> np.uint64(30)) ^ (h >> np.uint64(60))
