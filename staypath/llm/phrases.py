"""Phrases whose words keep company, per language: exact counts by double-array tries of Apriori-safe candidates.

1. Words are summed in tasks and merged by key range; a word known ``least`` times in a language is frequent.
2. A phrase can only be frequent if all phrases inside it are. So neighbouring frequent words propose pairs, and chains of
   frequent pairs propose longer phrases. "Is frequent" is asked of bit tables of fixed size, which never deny a frequent
   one; proposals are summed in tasks and by key range, and those that reach ``least`` are candidates.
3. Candidates are dealt into tries of at most ``trie`` phrases by their first word. Each trie is a double array (a base per
   state, the parent as check), built once and broadcast. In a task all positions of a chunk of text step from state to
   state at once, level by level; accepting states are counted with one bincount, and the shards' counts are summed.
4. Scores, the rule for phrases inside longer ones and the ranking are joins and windows over the candidates.

Phrases are known by 64-bit hashes of language and words until their text is joined at the end.
"""

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from staypath.llm.exchange import merge_counts, parts, range_starts
from staypath.llm.frames import staged
from staypath.llm.spans import gathered, separators, word_spans
from staypath.llm.words import BASE, Counts, Table, chunks, mix

LEAST, LONGEST, TOP, COVERED = 30, 4, 2000, 80
ENDS, BLANKS = b".,;:!?\n\v\f\r", b" \t"
#: bits of a table that answers whether a phrase may be frequent (16 MB), and slices in which it is made
BITS, SLICES = 27, 8
#: words or phrases that a task holds before it sends them
HELD = 1_000_000
#: candidates of one trie
TRIE = 1 << 21
NO_LANG = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lang_key(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode())


class Reader:
    """Words of a batch's chunks: hashes that tell languages apart, and whether the next word is in the same piece."""

    def __init__(self):
        self.apart, self.ends = separators(ENDS + BLANKS), separators(ENDS)

    def chunks(self, batch):
        """(language of each text, data, begins, ends, keys, text of each word, mask of words joined to the next)."""
        langs = batch.column("lang").to_pylist()
        salts = {name: lang_key(name) for name in set(langs)}
        salt = np.array([salts[name] for name in langs], dtype=np.uint64)
        for low, data, starts in chunks(batch.column("text")):
            begin, end, hashes, at = word_spans(data, starts, self.apart, lower=True)
            text = np.repeat(np.arange(len(at) - 1), np.diff(at))
            closed = np.zeros(len(data) + 1, dtype=np.int64)
            np.cumsum(self.ends[data], out=closed[1:])
            joined = np.zeros(len(begin), dtype=bool)
            joined[:-1] = (text[1:] == text[:-1]) & (closed[begin[1:]] == closed[end[:-1]])
            yield langs[low:low + len(at) - 1], data, begin, end, mix(hashes ^ salt[low + text]), text, joined


def longer(keys: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Keys of phrases that go on with one more word; the key of a single word is its hash."""
    return mix(keys * np.uint64(BASE) + words)


def phrase_keys(words: np.ndarray) -> np.ndarray:
    """Keys of phrases of equal length, one a row."""
    keys = words[:, 0]
    for k in range(1, words.shape[1]):
        keys = longer(keys, words[:, k])
    return keys


WORDS = pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary()), ("lang", pa.binary()),
                   ("langs", pa.list_(pa.string())), ("sizes", pa.binary()), ("bytes", pa.binary())])
WORDS_DDL = "part int, keys binary, counts binary, lang binary, langs array<string>, sizes binary, bytes binary"


def _word_blocks(ranges):
    """Per key range the words of a task with counts, languages and texts."""
    def block(counts, fresh, names):
        keys, n = counts.total()
        new, lang, size, text = fresh
        new, lang, size = np.concatenate(new), np.concatenate(lang), np.concatenate(size)
        order = np.argsort(new)
        begin = np.cumsum(size) - size
        text, start = gathered(np.concatenate(text), begin[order], (begin + size)[order], np.zeros(len(size), dtype=np.int64))
        lang, size = lang[order], size[order]
        at = range_starts(keys, ranges)
        used = np.flatnonzero(np.diff(at))
        cut = lambda x, kind: pa.array([x[at[i]:at[i + 1]].astype(kind).tobytes() for i in used], pa.binary())
        return pa.RecordBatch.from_arrays([
            pa.array(used, pa.int32()), cut(keys, "<u8"), cut(n, "<u8"), cut(lang, "<i4"), pa.array([names] * len(used), pa.list_(pa.string())),
            cut(size, "<i4"), pa.array([text[start[at[i]]:start[at[i + 1]]].tobytes() for i in used], pa.binary())], schema=WORDS)

    def run(batches):
        reader = Reader()
        counts, seen, fresh, names = Counts(), np.empty(0, dtype=np.uint64), [[], [], [], []], {}
        for batch in batches:
            for langs, data, begin, end, keys, text, _ in reader.chunks(batch):
                if not len(keys):
                    continue
                codes = np.array([names.setdefault(name, len(names)) for name in langs])
                own, first, n = np.unique(keys, return_index=True, return_counts=True)
                counts.add(own, n)
                new = np.searchsorted(seen, own)
                new = np.flatnonzero((new == len(seen)) | (seen[np.minimum(new, len(seen) - 1)] != own) if len(seen) else np.ones(len(own), dtype=bool))
                seen = np.union1d(seen, own[new])
                first = first[new]
                out, start = gathered(_LOWER[data], begin[first], end[first], np.zeros(len(first), dtype=np.int64))
                for held, more in zip(fresh, (own[new], codes[text[first]], np.diff(start), out)):
                    held.append(more)
            if len(seen) >= HELD:
                yield block(counts, fresh, list(names))
                counts, seen, fresh = Counts(), np.empty(0, dtype=np.uint64), [[], [], [], []]
        if len(seen):
            yield block(counts, fresh, list(names))
    return run


VOCABULARY_DDL = "key bigint, lang string, word string, f bigint"


def _vocabulary(least):
    """Of one key range: the frequent words, and with null keys how often words of the range occur in each language."""
    def run(table):
        keys, n = merge_counts(table)
        own, lang, word, total = [], [], [], {}
        frequent = keys[n >= least]
        met = set()
        for k, c, codes, names, sizes, text in zip(*(table.column(x).to_pylist() for x in ("keys", "counts", "lang", "langs", "sizes", "bytes"))):
            k, c = np.frombuffer(k, "<u8"), np.frombuffer(c, "<u8")
            codes, ends = np.frombuffer(codes, "<i4"), np.cumsum(np.frombuffer(sizes, "<i4"))
            for code, many in enumerate(np.bincount(codes, c, minlength=len(names)) if len(c) and c.max() < 1 << 40 else
                                        [int(c[codes == i].sum()) for i in range(len(names))]):
                total[names[code]] = total.get(names[code], 0) + int(many)
            for i in np.flatnonzero(np.isin(k, frequent)).tolist():
                if k[i] not in met:
                    met.add(k[i])
                    own.append(k[i])
                    lang.append(names[codes[i]])
                    word.append(text[ends[i - 1] if i else 0:ends[i]].decode())
        own = np.array(own, dtype=np.uint64)
        f = n[np.searchsorted(keys, own)]
        total = {name: many for name, many in total.items() if many}
        return pa.table({
            "key": pa.array([*own.view(np.int64).tolist(), *[None] * len(total)], pa.int64()), "lang": pa.array([*lang, *total], pa.string()),
            "word": pa.array([*word, *[None] * len(total)], pa.string()), "f": pa.array([*f.tolist(), *total.values()], pa.int64())})
    return run


def _bits(table):
    keys = np.sort(table.column("key").to_numpy().view(np.uint64))
    width = BITS - SLICES
    bits = np.zeros(1 << width, dtype=np.uint8)
    bits[(keys >> np.uint64(64 - BITS)).astype(np.int64) & ((1 << width) - 1)] = 1
    return pa.table({"slice": pa.array([int(keys[0] >> np.uint64(64 - SLICES))], pa.int32()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})


def bit_table(keys: DataFrame) -> np.ndarray:
    """Bits at the heads of the keys of a frame, 2^BITS of them whatever its size."""
    slices = keys.select("key", F.shiftrightunsigned("key", 64 - SLICES).alias("at")).groupBy("at").applyInArrow(_bits, "slice int, bits binary")
    out = np.zeros(1 << (BITS - 3), dtype=np.uint8)
    width = 1 << (BITS - SLICES - 3)
    for row in slices.collect():
        out[row["slice"] * width:(row["slice"] + 1) * width] = np.frombuffer(row["bits"], np.uint8)
    return out


def may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = (keys >> np.uint64(64 - BITS)).astype(np.int64)
    return bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 > 0


class Grams:
    """Phrases of ``size`` words and their counts, summed up as they come."""

    def __init__(self, size: int):
        self.size, self.waiting, self.known = size, 0, 0
        self.words, self.counts = [np.empty((0, size), dtype=np.uint64)], [np.empty(0, dtype=np.int64)]

    def add(self, words: np.ndarray):
        self.words.append(words)
        self.counts.append(np.ones(len(words), dtype=np.int64))
        self.waiting += len(words)
        if self.waiting > 500_000 + self.known:
            self.total()

    def total(self):
        """Keys in order, phrases and counts."""
        words, counts = np.concatenate(self.words), np.concatenate(self.counts)
        keys = phrase_keys(words)
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, dtype=np.int64)
        words, counts = words[order[first]], np.add.reduceat(counts[order], first) if len(first) else counts
        self.words, self.counts, self.waiting, self.known = [words], [counts], 0, len(first)
        return keys[first], words, counts


GRAMS = pa.schema([("size", pa.int32()), ("part", pa.int32()), ("words", pa.binary()), ("counts", pa.binary())])
GRAMS_DDL = "size int, part int, words binary, counts binary"


def _proposals(sizes, words, pairs, ranges):
    """Blocks of the phrases of the given sizes whose words, or neighbouring pairs if ``pairs`` is given, may be frequent."""
    def block(grams):
        keys, own, n = grams.total()
        at = range_starts(keys, ranges)
        used = np.flatnonzero(np.diff(at))
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(used), grams.size), pa.int32()), pa.array(used, pa.int32()),
            pa.array([own[at[i]:at[i + 1]].tobytes() for i in used], pa.binary()),
            pa.array([n[at[i]:at[i + 1]].astype("<u4" if n.max() < 1 << 32 else "<u8").tobytes() for i in used], pa.binary())], schema=GRAMS)

    def run(batches):
        reader, bits = Reader(), words.value if pairs is None else pairs.value
        held = [Grams(size) for size in sizes]
        for batch in batches:
            for _, _, _, _, keys, _, joined in reader.chunks(batch):
                if pairs is None:
                    good = may_hold(bits, keys)
                    good = good & joined & np.append(good[1:], False)
                else:
                    good = joined.copy()
                    at = np.flatnonzero(good)
                    good[at] = may_hold(bits, longer(keys[at], keys[at + 1]))
                chain, size = good, 2
                for grams in held:
                    while size < grams.size:
                        chain = chain & np.append(good[size - 1:], np.zeros(min(size - 1, len(good)), dtype=bool))
                        size += 1
                    at = np.flatnonzero(chain)
                    grams.add(keys[at[:, None] + np.arange(size)])
            for i, grams in enumerate(held):
                if grams.known + grams.waiting >= HELD:
                    yield block(grams)
                    held[i] = Grams(grams.size)
        for grams in held:
            if grams.known + grams.waiting:
                yield block(grams)
    return run


CANDIDATES_DDL = "key bigint, words array<bigint>, cuts array<struct<k: int, l: bigint, r: bigint>>, inner array<bigint>"
CANDIDATES = pa.schema([
    ("key", pa.int64()), ("words", pa.list_(pa.int64())),
    ("cuts", pa.list_(pa.struct([("k", pa.int32()), ("l", pa.int64()), ("r", pa.int64())]))), ("inner", pa.list_(pa.int64()))])


def _lists(columns):
    """A list column whose i-th entries come from the i-th column."""
    n, k = len(columns[0]), len(columns)
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), pa.array(np.stack(columns, 1).reshape(-1) if n else np.empty(0, dtype=np.int64)))


def _candidates(least):
    """Phrases of one size and key range that reach ``least``, with the keys of their cuts and of the phrases of two words or more in them."""
    def run(table):
        size = table.column("size")[0].as_py()
        words, counts = [], []
        for w, c in zip(table.column("words").to_pylist(), table.column("counts").to_pylist()):
            words.append(np.frombuffer(w, np.uint64).reshape(-1, size))
            counts.append(np.frombuffer(c, "<u8" if len(c) * size == len(w) else "<u4").astype(np.int64))
        grams = Grams(size)
        grams.words, grams.counts = words, counts
        keys, words, n = grams.total()
        keys, words = keys[n >= least], words[n >= least]
        key = lambda a, b: phrase_keys(words[:, a:b]).view(np.int64)
        cuts = [(np.full(len(keys), k, dtype=np.int32), key(0, k), key(k, size)) for k in range(1, size)]
        flat = [np.stack(c, 1).reshape(-1) for c in zip(*cuts)]
        cuts = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * (size - 1), pa.int32()),
                                        pa.StructArray.from_arrays([pa.array(c) for c in flat], fields=list(CANDIDATES.field("cuts").type.value_type)))
        inner = [key(a, b) for a in range(size) for b in range(a + 2, size + 1) if b - a < size]
        inner = _lists(inner) if inner else pa.array([[]] * len(keys), pa.list_(pa.int64()))
        return pa.Table.from_arrays([pa.array(keys.view(np.int64)), _lists([words[:, k].view(np.int64) for k in range(size)]), cuts, inner], schema=CANDIDATES)
    return run


class Trie:
    """Double array over the words of some phrases: ``base[state] + digit`` is the next state if its ``check`` is the state.

    Words are numbered from 1. State 0 is the root, whose children are the words themselves; from there on a word is two
    steps, by its number's two digits to the base ``radix``, so that no state has many children and the array stays dense.
    Every beginning of two words or more of a phrase has to be a phrase.
    """

    def __init__(self, phrases: list[np.ndarray], seed: int = 7):
        """``phrases``: per number of words, from 2 on, an array with a row per phrase."""
        words = np.unique(np.concatenate([p.reshape(-1) for p in phrases]))
        self.words = words
        self.radix = int(np.sqrt(len(words))) + 1
        self.base = np.full(len(words) + 1, -1, dtype=np.int64)
        self.check = np.zeros(len(words) + 1, dtype=np.int64)
        self.check[0] = -1
        self.free = np.zeros(len(words) + 1, dtype=bool)
        self.states = []
        self.random = np.random.default_rng(seed)
        for level, rows in enumerate(phrases):
            ids = np.searchsorted(words, rows) + 1
            state = ids[:, 0]
            for k in range(1, level + 1):
                state = self.base[self.base[state] + ids[:, k] // self.radix] + ids[:, k] % self.radix
            self.states.append(self._place(self._place(state, ids[:, -1] // self.radix), ids[:, -1] % self.radix))

    def _grow(self, n):
        self.free = np.concatenate([self.free, np.ones(n, dtype=bool)])
        self.base = np.concatenate([self.base, np.full(n, -1, dtype=np.int64)])
        self.check = np.concatenate([self.check, np.full(n, -1, dtype=np.int64)])

    def _take(self, parent, base, child, digit):
        """Bases of parents, and the slots of their children."""
        self.base[parent] = base
        slot = self.base[child] + digit
        self.free[slot] = False
        self.check[slot] = child

    def _place(self, parent, digit):
        """States of new children; each parent gets a base at which the slots of all its digits are free."""
        key = np.unique(parent * self.radix + digit)
        p, d = key // self.radix, key % self.radix
        first = np.flatnonzero(np.r_[True, p[1:] != p[:-1]]) if len(p) else np.empty(0, dtype=np.int64)
        size = np.diff(np.append(first, len(p)))
        # the largest one by one, near the end of the array
        large = np.flatnonzero(size >= 8)
        for g in large[np.argsort(-size[large], kind="stable")].tolist():
            own = d[first[g]:first[g] + size[g]]
            base = None
            while base is None:
                low, high = max(0, len(self.free) - 12 * self.radix), len(self.free) - self.radix
                if high > low:
                    bases = self.random.integers(low, high, 256)
                    fits = np.flatnonzero(self.free[bases[:, None] + own].all(axis=1))
                    base = int(bases[fits[0]]) if len(fits) else None
                if base is None:
                    self._grow(4 * self.radix)
            self._take(p[first[g]], base, p[first[g]], own)
        # small ones all at once: bases are drawn, and kept where nothing else lies or is drawn
        small = np.flatnonzero((size > 1) & (size < 8))
        self._grow(max(0, 3 * int(size[small].sum()) + 2 * self.radix - int(self.free.sum())))
        claims = np.full(len(self.free), -1, dtype=np.int64)
        while len(small):
            row = np.repeat(np.arange(len(small)), size[small])
            at = np.repeat(first[small] - (np.cumsum(size[small]) - size[small]), size[small]) + np.arange(len(row))
            begin = np.cumsum(size[small]) - size[small]
            base = self.random.integers(0, len(self.free) - self.radix, len(small))
            slot = base[row] + d[at]
            fits = np.logical_and.reduceat(self.free[slot], begin)
            some = fits[row]
            claims[slot[some]] = row[some]
            fits &= np.logical_and.reduceat(claims[slot] == row, begin)
            claims[slot[some]] = -1
            some = fits[row]
            self._take(p[first[small[fits]]], base[fits], p[at[some]], d[at[some]])
            small = small[~fits]
        # single children take what is left
        one = first[size == 1]
        slots = np.flatnonzero(self.free)
        slots = slots[slots >= self.radix]
        if len(slots) < len(one):
            n = len(self.free)
            self._grow(self.radix + len(one))
            slots = np.concatenate([slots, np.arange(max(n, self.radix), len(self.free))])
        slots = slots[:len(one)]
        self._take(p[one], slots - d[one], p[one], d[one])
        return self.base[parent] + digit

    def frozen(self, keys: list[np.ndarray]):
        """What tasks need: words, radix, base, check, and the phrases' keys by state."""
        state, key = np.concatenate(self.states), np.concatenate(keys)
        order = np.argsort(state)
        return self.words, self.radix, self.base.astype(np.int32), self.check.astype(np.int32), state[order].astype(np.int32), key[order]


def stepped(base, check, state, digit):
    """Next states, and a mask of those that there are."""
    step = base[state].astype(np.int64)
    go = step >= 0
    step += digit
    go &= step < len(check)
    go[go] = check[step[go]] == state[go]
    return step, go


COUNTS_DDL = "part int, states binary, counts binary"
COUNTS = pa.schema([("part", pa.int32()), ("states", pa.binary()), ("counts", pa.binary())])


def _walked(shared, longest, ranges):
    """Counts of the accepting states that the positions of a task's texts come to."""
    def run(batches):
        words, radix, base, check, _, _ = shared.value
        reader, table = Reader(), Table(words)
        counts = np.zeros(len(check), dtype=np.int64)
        for batch in batches:
            for _, _, _, _, keys, _, joined in reader.chunks(batch):
                ids = table.find(keys).astype(np.int64) + 1
                at = np.flatnonzero((ids > 0) & joined)
                state = ids[at]
                for k in range(1, longest):
                    go = ids[at + k] > 0
                    at, state = at[go], state[go]
                    for digit in (ids // radix, ids % radix):
                        step, go = stepped(base, check, state, digit[at + k])
                        at, state = at[go], step[go]
                    counts += np.bincount(state, minlength=len(check))
                    go = joined[at + k]
                    at, state = at[go], state[go]
        some = np.flatnonzero(counts)
        cut = np.searchsorted(some, np.arange(ranges + 1) * len(check) // ranges)
        cut[-1] = len(some)
        used = np.flatnonzero(np.diff(cut))
        yield pa.RecordBatch.from_arrays([
            pa.array(used, pa.int32()), pa.array([some[cut[i]:cut[i + 1]].astype("<i4").tobytes() for i in used], pa.binary()),
            pa.array([counts[some[cut[i]:cut[i + 1]]].astype("<i8").tobytes() for i in used], pa.binary())], schema=COUNTS)
    return run


def _summed(shared):
    def run(table):
        states = np.frombuffer(b"".join(table.column("states").to_pylist()), "<i4")
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), "<i8")
        own, at = np.unique(states, return_inverse=True)
        total = np.zeros(len(own), dtype=np.int64)
        np.add.at(total, at, counts)
        _, _, _, _, state, key = shared.value
        return pa.table({"key": pa.array(key[np.searchsorted(state, own)].view(np.int64)), "f": pa.array(total)})
    return run


def trie_of(rows: list[tuple[int, list[int]]]):
    """Trie of phrases given as (key, words)."""
    phrases, keys = [], []
    for size in range(2, max((len(w) for _, w in rows), default=1) + 1):
        own = [(k, w) for k, w in rows if len(w) == size]
        phrases.append(np.array([w for _, w in own], dtype=np.int64).reshape(-1, size).view(np.uint64))
        keys.append(np.array([k for k, _ in own], dtype=np.int64).view(np.uint64))
    return Trie(phrases).frozen(keys)


def counted_phrases(rows: DataFrame, candidates: DataFrame, longest: int, trie: int = TRIE) -> DataFrame:
    """``key, f`` of every candidate; the texts are read once for each trie of ``trie`` candidates."""
    spark = rows.sparkSession
    ranges = parts(spark, 1)
    blocks = -(-candidates.count() // trie)
    made = []
    for block in range(blocks):
        # by first word, so that a trie holds the beginnings of its phrases
        own = candidates.where(F.pmod(F.element_at("words", 1), F.lit(blocks)) == block).select("key", "words")
        held = [(r["key"], r["words"]) for r in own.toLocalIterator()]
        if not held:
            continue
        shared = spark.sparkContext.broadcast(trie_of(held))
        walked = rows.mapInArrow(_walked(shared, longest, ranges), COUNTS_DDL).groupBy("part").applyInArrow(_summed(shared), "key bigint, f bigint")
        made.append(staged(walked))
    return reduce(DataFrame.unionByName, made) if made else spark.createDataFrame([], "key bigint, f bigint")


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, trie: int = TRIE):
    """Words (``key, lang, word, f``; null keys carry the words of a language) and phrases (``key, words, cuts, inner, f``)."""
    spark = docs.sparkSession
    ranges = parts(spark)
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col("text").cast("string").alias("text"))
    words = staged(rows.mapInArrow(_word_blocks(ranges), WORDS_DDL).groupBy("part").applyInArrow(_vocabulary(least), VOCABULARY_DDL))
    shared = spark.sparkContext.broadcast(bit_table(words.where("key is not null")))

    def proposed(sizes, pairs=None):
        made = rows.mapInArrow(_proposals(sizes, shared, pairs, ranges), GRAMS_DDL)
        return staged(made.groupBy("size", "part").applyInArrow(_candidates(least), CANDIDATES_DDL))

    candidates = proposed([2])
    if longest > 2:
        candidates = candidates.unionByName(proposed(range(3, longest + 1), spark.sparkContext.broadcast(bit_table(candidates))))
    counted = counted_phrases(rows, candidates, longest, trie)
    return words, staged(candidates.join(counted, "key").where(F.col("f") >= least))


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, longest: int = LONGEST, covered: int = COVERED, trie: int = TRIE
) -> DataFrame:
    """Per language (null: ``und``) the ``top`` phrases of 2 to ``longest`` words: ``lang, rank, phrase, a, l, r, n, score``.

    Texts (null: empty) are lower-cased (A-Z) and split into pieces at ``.,;:!?`` and 0x0A to 0x0D, pieces at blanks and tabs.
    a counts the phrase, l and r the parts of its cut with the least score 2000000 * a div (l + r), ties to the first cut; n
    counts all words of the language. Phrases inside a longer frequent one with ``covered`` % of their count are left out.
    Order: score, then a, both from the highest, then phrase by bytes. Repeated rows count each time; no rows give no rows.
    """
    words, phrases = frequent_phrases(docs, least, longest, trie)
    known = words.where("key is not null").select("key", "f").unionByName(phrases.select("key", "f"))
    # counts of all parts of a phrase; a part that many phrases share is a skewed key of a join, which AQE splits
    asked = phrases.select("key", F.explode(F.array_distinct(F.expr("flatten(transform(cuts, c -> array(c.l, c.r)))"))).alias("part"))
    part = asked.join(known.select(F.col("key").alias("part"), F.col("f").alias("n_part")), "part")
    part = part.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("part", "n_part"))).alias("counts"))
    inside = phrases.select(F.explode("inner").alias("key"), "f").groupBy("key").agg(F.max("f").alias("f_longer"))
    score = "cast(2000000 as decimal(7, 0)) * cast(f as decimal(20, 0)) div (cast(counts[c.l] as decimal(20, 0)) + cast(counts[c.r] as decimal(20, 0)))"
    scored = phrases.join(part, "key").join(inside, "key", "left").where(
        f"f_longer is null or cast(f_longer as decimal(20, 0)) * 100 < cast(f as decimal(20, 0)) * {covered}").selectExpr(
        "key", "words", "f as a", f"array_min(transform(cuts, c -> struct({score} as score, c.k as k, counts[c.l] as l, counts[c.r] as r))) as cut")
    spelt = scored.select("key", F.posexplode("words").alias("at", "word_key")).join(
        words.select(F.col("key").alias("word_key"), "lang", "word"), "word_key").groupBy("key").agg(
        F.max("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("spelt"))
    lines = scored.join(spelt, "key").selectExpr("lang", "key", "array_join(spelt.word, ' ') as phrase", "a", "cut.l as l", "cut.r as r", "cut.score as score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # the first of each part of a language, then of these
    best = lines.withColumn("at", F.row_number().over(Window.partitionBy("lang", F.pmod("key", F.lit(64))).orderBy(*order))).where(F.col("at") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    n = words.where("key is null").groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
