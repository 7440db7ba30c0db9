"""Periodic runs of words, found on a grammar of each text.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and at least ``least``
and ``times`` * q words that no neighbouring word extends keeping period q.

1. Re-Pair: pairs of neighbouring symbols that repeat in a text become new symbols, the more frequent ones first. In a
   round all pairs that no more frequent one overlaps are replaced at once, in all texts of a chunk side by side; the most
   frequent pair of each text always is one of them. What is left of each text is paired evenly, so a grammar has
   logarithmic depth.
2. A run lies wholly in the expansion of a lowest symbol, across the border between its two parts, and has two periods
   or more on one side of it. So each symbol is looked at once, at one of its places: a period q is kept if the q
   words next to the border equal the q words beyond them, by prefix hashes, and grown inside the expansion.
3. The intervals found are translated to all places where the symbol was made, those that a neighbouring word still
   extends are left to a higher symbol, and equal intervals of several symbols merge into one of least period.

Everything happens inside a task, text by text; nothing is shuffled.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from staypath.llm.spans import gathered, separators, word_spans
from staypath.llm.words import Powers, chunks, mix

LEAST, TIMES = 6, 4
SPACES = b" \t\n\v\f\r"
#: bytes of texts whose grammars are built side by side, and (symbol, period) pairs looked at at once
CHUNK, TESTS = 2 << 20, 2_000_000
SCATTER = np.uint64(0x9E3779B97F4A7C15)


def dense(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Word numbers that are equal for equal words of one text and differ between texts."""
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.r_[False, (h[1:] != h[:-1]) | (o[1:] != o[:-1])] if len(h) else np.zeros(0, dtype=bool)
    out = np.empty(len(hashes), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out


def _repeated(key: np.ndarray) -> np.ndarray:
    """Mask of the keys that may occur twice; most others are sorted out by a table of counts."""
    bits = max(8, int(len(key)).bit_length() + 1)
    slot = ((key.view(np.uint64) * SCATTER) >> np.uint64(64 - bits)).astype(np.int64)
    return np.bincount(slot, minlength=1 << bits)[slot] > 1


def grammar(words: np.ndarray, at: np.ndarray):
    """Rule, start, border and end of every place where a rule of the texts' grammars was applied.

    ``words`` are the numbers of :func:`dense`, ``at`` says where each text starts.
    """
    n = len(words)
    sym = np.append(words, -1)
    nxt, prv = np.arange(1, n + 2), np.arange(-1, n)
    dead = np.zeros(n + 1, dtype=bool)
    weight = np.zeros(n + 2, dtype=np.int64)  # the last two entries stand for no neighbour
    fresh = n
    made = []
    active = np.arange(max(n - 1, 0))
    while len(active):
        active = active[nxt[active] < n]
        after = nxt[active]
        key = sym[active] << 32 | sym[after]
        # of a stretch of equal symbols every second pair counts
        twin = sym[active] == sym[after]
        goes_on = np.zeros(len(active), dtype=bool)
        goes_on[1:] = twin[1:] & twin[:-1] & (after[:-1] == active[1:])
        place = np.arange(len(active))
        odd = (place - np.maximum.accumulate(np.where(goes_on, 0, place))) % 2 == 1
        some = np.flatnonzero(~odd)
        some = some[_repeated(key[some])]
        some = some[np.argsort(key[some], kind="stable")]
        k = key[some]
        first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, dtype=np.int64)
        count = np.diff(np.append(first, len(k)))
        count = np.repeat(count, count)
        some, k, count = some[count > 1], k[count > 1], count[count > 1]
        if not len(some):
            break
        i = active[some]
        weight[i] = count << 40 | (mix(k.view(np.uint64)) >> np.uint64(24)).astype(np.int64)
        best = (weight[i] > weight[prv[i]]) & (weight[i] > weight[nxt[i]])
        weight[i] = 0
        if not best.any():
            break
        chosen, k = i[best], k[best]
        rule = fresh + np.cumsum(np.r_[False, k[1:] != k[:-1]])
        fresh = int(rule[-1]) + 1
        middle = nxt[chosen]
        end = nxt[middle]
        made.append((rule, chosen, middle, end))
        sym[chosen], nxt[chosen], prv[end], dead[middle] = rule, end, chosen, True
        active = np.unique(np.concatenate([i[~best], active[odd], chosen, prv[chosen]]))
        active = active[active >= 0]
        active = active[~dead[active]]
    # what is left of each text is paired evenly
    left = np.flatnonzero(~dead[:n])
    owner = np.searchsorted(at, left, side="right") - 1
    end = at[1:][owner] if len(left) else left
    end = np.minimum(end, np.append(left[1:], n)) if len(left) else end
    while len(left):
        first = np.searchsorted(owner, owner)
        even = (np.arange(len(left)) - first) % 2 == 0
        paired = np.flatnonzero(even[:-1] & (owner[1:] == owner[:-1]))
        if not len(paired):
            break
        rule = fresh + np.arange(len(paired))
        fresh += len(paired)
        made.append((rule, left[paired], left[paired + 1], end[paired + 1]))
        end[paired] = end[paired + 1]
        left, owner, end = left[even], owner[even], end[even]
    if not made:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    return tuple(np.concatenate(c) for c in zip(*made))


class Prefixes:
    """Equality of stretches of words by prefix hashes."""

    def __init__(self, words: np.ndarray):
        up, self.down = Powers.of(len(words) + 1)
        self.sums = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(mix(words.astype(np.uint64)) * up[:len(words)], out=self.sums[1:], dtype=np.uint64)

    def same(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        s, down = self.sums, self.down
        return (s[a + n] - s[a]) * down[a] == (s[b + n] - s[b]) * down[b]

    def reach(self, a, b, most, back: bool = False) -> np.ndarray:
        """Length, ``most`` at the utmost, of the longest equal stretches that start at a and b, or end before them."""
        low, high = np.zeros(len(a), dtype=np.int64), most.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            n = (low[open_] + high[open_] + 1) // 2
            shift = n if back else 0
            equal = self.same(a[open_] - shift, b[open_] - shift, n)
            low[open_] = np.where(equal, n, low[open_])
            high[open_] = np.where(equal, high[open_], n - 1)


def crossing(words, prefixes: Prefixes, start, border, end, least: int = LEAST, times: int = TIMES):
    """Symbol number, begin, end and period of the periodic stretches across the borders of symbols at the given places."""
    found = [(np.zeros(0, dtype=np.int64),) * 4]
    for right in (True, False):
        most = np.minimum((end - border if right else border - start) // 2, (end - start) // times)
        most[end - start < least] = 0
        upto = np.cumsum(most)
        low = 0
        while low < len(most):
            high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + TESTS, side="right")))
            size = most[low:high]
            row = np.repeat(np.arange(low, high), size)
            q = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + 1
            m = border[row]
            hit = words[m] == words[m + q] if right else words[m - 1] == words[m - 1 - q]
            row, q, m = row[hit], q[hit], m[hit]
            a = m if right else m - 2 * q
            hit = prefixes.same(a, a + q, q)
            row, q, a = row[hit], q[hit], a[hit]
            forth = prefixes.reach(a, a + q, end[row] - a - q)
            back = prefixes.reach(a, a + q, a - start[row], back=True)
            begin, stop = a - back, a + q + forth
            long = stop - begin >= np.maximum(least, times * q)
            found.append((row[long], begin[long], stop[long], q[long]))
            low = high
    return tuple(np.concatenate(c) for c in zip(*found))


def runs(words: np.ndarray, at: np.ndarray, least: int = LEAST, times: int = TIMES):
    """Begins, ends and periods of all runs of the texts, by begin, then period."""
    rule, start, border, end = grammar(words, at)
    order = np.argsort(rule, kind="stable")
    rule, start, border, end = rule[order], start[order], border[order], end[order]
    first = np.flatnonzero(np.r_[True, rule[1:] != rule[:-1]]) if len(rule) else np.zeros(0, dtype=np.int64)
    places = np.diff(np.append(first, len(rule)))
    row, begin, stop, period = crossing(words, Prefixes(words), start[first], border[first], end[first], least, times)
    # to all places of the symbol
    again = places[row]
    each = np.repeat(np.arange(len(row)), again)
    nth = np.arange(len(each)) - np.repeat(np.cumsum(again) - again, again)
    move = start[first[row[each]] + nth] - start[first[row[each]]]
    begin, stop, period = begin[each] + move, stop[each] + move, period[each]
    n = len(words)
    longer = (begin > 0) & (words[np.maximum(begin - 1, 0)] == words[np.maximum(begin - 1, 0) + period])
    longer |= (stop < n) & (words[np.minimum(stop, n - 1)] == words[stop - period])
    begin, stop, period = begin[~longer], stop[~longer], period[~longer]
    order = np.lexsort((period, stop, begin))
    begin, stop, period = begin[order], stop[order], period[order]
    new = np.r_[True, (begin[1:] != begin[:-1]) | (stop[1:] != stop[:-1])] if len(begin) else np.zeros(0, dtype=bool)
    begin, stop, period = begin[new], stop[new], period[new]
    order = np.lexsort((period, begin))
    return begin[order], stop[order], period[order]


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
ROWS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])
ROWS_DDL = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def _found(least, times):
    apart = separators(SPACES)

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for low, data, starts in chunks(batch.column("text"), CHUNK):
                begin, end, hashes, at = word_spans(data, starts, apart)
                n, texts = len(begin), len(at) - 1
                a, b, q = runs(dense(hashes, at), at, least, times) if n else (np.zeros(0, dtype=np.int64),) * 3
                inside = np.zeros(n + 1, dtype=np.int64)
                np.add.at(inside, a + q, 1)
                np.add.at(inside, b, -1)
                kept = np.cumsum(inside[:-1]) == 0
                owner = np.repeat(np.arange(texts), np.diff(at))[kept]
                more = np.r_[owner[1:] == owner[:-1], False] if len(owner) else np.zeros(0, dtype=bool)
                out, where = gathered(data, begin[kept], end[kept], more.astype(np.int64))
                cut = where[np.searchsorted(owner, np.arange(texts + 1))]
                collapsed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), texts, [None, pa.py_buffer(cut), pa.py_buffer(out)])
                text = np.searchsorted(at, a, side="right") - 1
                listed = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(text, np.arange(texts + 1)), pa.int32()),
                    pa.StructArray.from_arrays([pa.array(a - at[text]), pa.array(b - a), pa.array(q)], fields=list(RUN)))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(low, texts), pa.array(np.diff(at), pa.int64()), listed, collapsed.cast(pa.binary()).cast(pa.string())], schema=ROWS)
    return run


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Per row: ``doc_id, n_words, runs, collapsed``: all runs by start, then period, and the text without their repeats.

    Words are runs of bytes other than space and 0x09 to 0x0D, compared as they are (by 64-bit hashes within a text) and
    numbered from 0. A word goes from ``collapsed`` if any run contains it after that run's first period; the others are
    joined by one space. Null and empty texts have no words, no runs and an empty ``collapsed``; repeated rows and rows
    without id are texts of their own. Other columns are left out, whatever their names.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    return rows.mapInArrow(_found(least, times), ROWS_DDL)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` in which one text in ten ends in a repeated passage.

    With h the unsigned crc32 of the decimal id, g = h div 10 and n words: if h % 10 = 0, each word i >= a becomes word
    a + (i - a) % p, where a = g % n and p = 1 + (n - a) div (3 + g % 8). Rows without id keep their text.
    """
    h = "crc32(cast(cast(doc_id as string) as binary))"
    words = r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')"
    ends = "struct(size(ws) as n, g % size(ws) as a, 1 + (size(ws) - g % size(ws)) div (3 + g % 8) as p, ws)"
    moved = "array_join(transform(sequence(0, int(e.n) - 1), i -> get(e.ws, int(if(i >= e.a, e.a + (i - e.a) % e.p, i)))), ' ')"
    # one-element arrays bind a value to a name, so that it is worked out once
    planted = f"get(transform(filter(array({words}), ws -> size(ws) > 0), ws -> get(transform(array({ends}), e -> {moved}), 0)), 0)"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.expr(f"{h} as h"))
    return rows.selectExpr("doc_id", "text", "h", "h div 10 as g").selectExpr(
        "doc_id", f"if(coalesce(h % 10 = 0, false), {planted}, text) as text")


def run_digests(docs: DataFrame) -> DataFrame:
    """Per row of ``documents`` with planted runs: counts, the longest run and digests of all runs and of what is kept."""
    found = periodic_runs(with_planted_runs(docs))
    longest = "array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))"
    lines = r"array_join(transform(runs, r -> concat_ws(',', r.start, r.length, concat(r.period, '\n'))), '')"
    return found.selectExpr("doc_id", "runs", "collapsed", f"{longest} as top").selectExpr(
        "doc_id", "bigint(size(runs)) as n_runs", "-top.start as start", "top.length as length", "-top.period as period",
        "(1000 * top.length) div -top.period as exponent_milli", f"sha2({lines}, 256) as runs_sha256", "sha2(collapsed, 256) as collapsed_sha256")
