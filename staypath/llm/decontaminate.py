"""Benchmark decontamination by latent semantic retrieval.

Documents are read in overlapping windows of words. Windows and benchmark items are TF-IDF vectors over the items'
less frequent terms, with document frequencies of the whole corpus. A randomised SVD of the windows' matrix, whose
products are summed over the corpus, gives a latent space. An item whose cosine with a passage there is large enough is a
candidate, and a candidate holds if the longest common subsequence with the words there covers enough of the item and the
item's answer, its most telling terms, is found as well. Items come in blocks of bounded size, each sent to every task.

Every candidate comes through the latent space, by one of two kinds of passages. Windows are compared as a whole with all
items. Their vectors also hold terms of the block's other items, and miss items much longer or shorter than a window; so
passages of an item's own length around its rarest words are compared with that item alone, as vectors of its own terms.
That cosine does not depend on what else is in the block or in the passage.
"""

from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from staypath.llm.frames import received, shipped, text_of
from staypath.llm.words import Table, chunks, joined, word_hashes

#: words of a window, and from one window to the next
WINDOW, STEP = 64, 32
#: dimensions of the latent space, and how many more the sketch has
RANK, MORE = 128, 16
#: terms in a larger share of documents say little; an item keeps its rarest terms in any case
MOST, KEPT_TERMS = 0.02, 8
#: windows with fewer of the items' terms are no passages
LEAST_TERMS = 3
#: least cosine of a candidate
COSINE = 0.4
#: least share of an item in a common subsequence within so many times its length; from EXACT on no answer is asked for
COVERED, SPREAD, EXACT = 0.6, 1.5, 0.9
#: an item's most telling terms, and the share of them to be found
ANSWER, ANSWERED = 5, 0.6
#: passages start at every word, or for items of more words so many times in their length
FINE = 64
#: items of a block, and bytes of their texts, which bound its terms
ITEMS, ITEM_BYTES = 2000, 1 << 19

_PLAIN = np.arange(256, dtype=np.uint8)
for _c in range(128):
    if not chr(_c).isalnum():
        _PLAIN[_c] = 32


def plain_words(data: np.ndarray, starts: np.ndarray):
    """Word hashes of a chunk, with ASCII punctuation read as space."""
    return word_hashes(_PLAIN[data], starts)


@dataclass
class Items:
    """A block of items: ids, word sequences, and the terms that stand for them."""

    ids: list[int]
    words: list[np.ndarray]
    terms: np.ndarray
    idf: np.ndarray
    basis: np.ndarray | None = None
    vectors: np.ndarray | None = None

    def __post_init__(self):
        self.table = Table(self.terms)

    def rows(self, words: np.ndarray, at: np.ndarray):
        """Entries of the windows' matrix: (window, term), and for each window its text and first word."""
        term = self.table.find(words)
        here = np.flatnonzero(term >= 0)
        text = np.searchsorted(at, here, side="right") - 1
        step = (here - at[text]) // STEP
        # a word is in the window that starts in its step, and in the one before
        back = WINDOW // STEP
        which = np.concatenate([step - k for k in range(back)])
        text, term = np.tile(text, back), np.tile(term[here], back)
        inside = which >= 0
        key = text[inside] << 40 | which[inside]
        order = np.argsort(key, kind="stable")
        key, term = key[order], term[inside][order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, dtype=np.int64)
        size = np.diff(np.append(first, len(key)))
        enough = np.repeat(size >= LEAST_TERMS, size)
        key, term = key[enough], term[enough]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, dtype=np.int64)
        return first, term, key[first] >> 40, (key[first] & ((1 << 40) - 1)) * STEP

    def embed(self, first, term) -> np.ndarray:
        """Unit latent vectors of the windows; zero where nothing is left of one."""
        if not len(first):
            return np.zeros((0, self.basis.shape[1]), dtype=np.float32)
        made = np.add.reduceat(self.basis[term], first, axis=0)
        return made / np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-9)


def item_block(rows) -> tuple[list[int], list[np.ndarray]]:
    data, starts = joined([(r.text or "").encode() for r in rows])
    words, at = plain_words(data, starts)
    kept = [(r.item_id, words[a:b]) for r, a, b in zip(rows, at, at[1:]) if b > a]
    return [i for i, _ in kept], [w for _, w in kept]


def _document_frequency(shared):
    def run(batches):
        table, n = received(shared), 0
        total = np.zeros(len(table.keys), dtype=np.int64)
        for batch in batches:
            n += len(batch)
            for _, data, starts in chunks(batch.column("text")):
                words, at = plain_words(data, starts)
                term = table.find(words)
                here = np.flatnonzero(term >= 0)
                text = np.searchsorted(at, here, side="right") - 1
                pairs = np.unique(text << 32 | term[here])
                total += np.bincount(pairs & 0xFFFFFFFF, minlength=len(total))
        yield _partial(np.append(total, n).astype(np.float64))
    return run


PART_DDL = "part int, sums binary"


def _partial(values: np.ndarray) -> pa.RecordBatch:
    """A task's share of a sum, in slices."""
    flat = values.ravel()
    slices = np.array_split(flat, SLICES)
    return pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([s.tobytes() for s in slices], pa.binary())], names=["part", "sums"])


SLICES = 16


def _added(table):
    total = sum(np.frombuffer(b, np.float64) for b in table.column("sums").to_pylist())
    return pa.table({"part": table.column("part")[:1], "sums": pa.array([total.tobytes()], pa.binary())})


def _sum(docs: DataFrame, task, shape) -> np.ndarray:
    """Sum of the tasks' arrays of this shape, in two levels of at most about 1000 shares each."""
    shares = docs.mapInArrow(task, PART_DDL).withColumn("group", F.floor(F.spark_partition_id() / 1000))
    level = shares.groupBy("group", "part").applyInArrow(_added, PART_DDL).groupBy("part").applyInArrow(_added, PART_DDL)
    rows = sorted(level.collect(), key=lambda r: r.part)
    return np.concatenate([np.frombuffer(r.sums, np.float64) for r in rows]).reshape(shape) if rows else np.zeros(shape)


def _sketch(shared, width, seed):
    """A'A times a random matrix, over the windows of a task's texts."""
    def run(batches):
        items: Items = received(shared)
        draw = np.random.default_rng(seed).standard_normal((len(items.terms), width)).astype(np.float32)
        weighted = draw * items.idf[:, None].astype(np.float32)
        total = np.zeros((len(items.terms), width))
        for batch in batches:
            for _, data, starts in chunks(batch.column("text")):
                first, term, _, _ = items.rows(*plain_words(data, starts))
                if len(first):
                    sums = np.add.reduceat(weighted[term], first, axis=0)
                    spread = np.repeat(sums, np.diff(np.append(first, len(term))), axis=0)
                    order = np.argsort(term, kind="stable")
                    start = np.flatnonzero(np.r_[True, np.diff(term[order]) != 0])
                    total[term[order][start]] += np.add.reduceat(spread[order], start, axis=0)
        yield _partial(total * items.idf[:, None])
    return run


def _gram(shared):
    """Products of the windows' coordinates in the sketched basis."""
    def run(batches):
        items: Items = received(shared)
        total = np.zeros((items.basis.shape[1],) * 2)
        for batch in batches:
            for _, data, starts in chunks(batch.column("text")):
                first, term, _, _ = items.rows(*plain_words(data, starts))
                if len(first):
                    own = np.add.reduceat(items.basis[term], first, axis=0)
                    total += own.T @ own
        yield _partial(total)
    return run


def latent_space(docs: DataFrame, ids: list[int], words: list[np.ndarray], rank: int = RANK) -> Items:
    """The block's items with frequencies and latent basis learned from all of ``docs`` (``text``)."""
    spark = docs.sparkSession
    terms = np.unique(np.concatenate(words))
    counts = _sum(docs, _document_frequency(shipped(spark, Table(terms))), (len(terms) + 1,))
    df, n = counts[:-1], max(1.0, counts[-1])
    telling = df <= MOST * n
    for own in words:
        at = np.searchsorted(terms, np.unique(own))
        telling[at[np.argsort(df[at], kind="stable")[:KEPT_TERMS]]] = True
    items = Items(ids, words, terms[telling], np.log((n + 1) / (df[telling] + 1)) + 1)
    width = min(len(items.terms), rank + MORE)
    sketch = _sum(docs, _sketch(shipped(spark, items), width, 0), (len(items.terms), width)).copy()
    # whole items are rows of the matrix, too, so that the space knows terms that no window has
    flat, at = _as_texts(words)
    term = items.table.find(flat)
    owner, term = np.repeat(np.arange(len(ids)), np.diff(at))[term >= 0], term[term >= 0]

    def of_items(by_term):
        """Sums over each item's terms."""
        made = np.zeros((len(ids), by_term.shape[1]))
        np.add.at(made, owner, by_term[term])
        return made

    draw = np.random.default_rng(0).standard_normal((len(items.terms), width)).astype(np.float32)
    np.add.at(sketch, term, of_items(draw * items.idf[:, None])[owner] * items.idf[term][:, None])
    frame, _ = np.linalg.qr(sketch)
    items.basis = (frame * items.idf[:, None]).astype(np.float32)
    own = of_items(items.basis)
    gram = _sum(docs, _gram(shipped(spark, items)), (width, width)) + own.T @ own
    _, turn = np.linalg.eigh(gram)
    items.basis = (items.basis @ turn[:, ::-1][:, :rank]).astype(np.float32)
    vectors = of_items(items.basis).astype(np.float32)
    items.vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return items


def _as_texts(words):
    return np.concatenate(words), np.concatenate([[0], np.cumsum([len(w) for w in words])])


def common_length(item: dict[int, int], size: int, words) -> int:
    """Length of the longest common subsequence, with the item's places as bits."""
    row = (1 << size) - 1
    for w in words:
        mask = item.get(w)
        if mask:
            both = row & mask
            row = (row + both) | (row - both)
    return size - (row & ((1 << size) - 1)).bit_count()


class Judge:
    """Decides on candidates: common subsequence first, then the answer.

    ``keys`` are the items' rarest words and ``least`` how many different ones of an item are in any passage that holds it.
    """

    def __init__(self, items: Items):
        self.items, self.bits, self.answer = items, [], []
        self.plain = [own.tolist() for own in items.words]
        self.terms = []
        for own in items.words:
            word = np.unique(own)
            term = items.table.find(word)
            self.terms.append(dict(zip(word[term >= 0].tolist(), term[term >= 0].tolist())))
        weight = dict(zip(items.terms.tolist(), items.idf.tolist()))
        for own in self.plain:
            bits: dict[int, int] = {}
            for place, w in enumerate(own):
                bits[w] = bits.get(w, 0) | 1 << place
            self.bits.append(bits)
            self.answer.append(set(sorted(bits, key=lambda w: (-weight.get(w, 0.0), w))[:ANSWER]))
        pairs, self.least = [], []
        for item, (own, bits, answer) in enumerate(zip(self.plain, self.bits, self.answer)):
            # an exact passage lacks at most so many words, any other one has its share of the answer
            lacking = len(own) - int(np.ceil(EXACT * len(own)))
            rarest = sorted(bits, key=lambda w: (-weight.get(w, 0.0), w))[:max(ANSWER, lacking + int(np.ceil(ANSWERED * ANSWER)))]
            self.least.append(max(1, min(len(rarest) - lacking, int(np.ceil(ANSWERED * len(answer))))))
            pairs += [(w, item) for w in rarest]
        word, self.owner = (np.array(c, dtype=kind) for c, kind in zip(zip(*sorted(pairs)), (np.uint64, np.int64)))
        keys, self.first = np.unique(word, return_index=True)
        self.first = np.append(self.first, len(word))
        self.keys = Table(keys)

    def length(self, item: int) -> int:
        """Words of a passage of the item."""
        return int(np.ceil(SPREAD * len(self.plain[item])))

    def step(self, item: int) -> int:
        """Words from one passage to the next."""
        return max(1, len(self.plain[item]) // FINE)

    def regions(self, words: np.ndarray, at: np.ndarray):
        """(text, item, first word, end) of all places where passages have enough of an item's rarest words."""
        key = self.keys.find(words)
        here = np.flatnonzero(key >= 0)
        n = self.first[key[here] + 1] - self.first[key[here]]
        item = self.owner[np.repeat(self.first[key[here]] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
        here, key = np.repeat(here, n), np.repeat(key[here], n)
        text = np.searchsorted(at, here, side="right") - 1
        order = np.lexsort((here, item, text))
        here, key, text, item = here[order], key[order], text[order], item[order]
        cut = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (item[1:] != item[:-1]), True]) if len(here) else np.zeros(1, np.int64)
        least = np.array(self.least)
        for a, b in zip(cut[:-1], cut[1:]):
            t, i = int(text[a]), int(item[a])
            if b - a < least[i]:
                continue
            length, place, own = self.length(i), here[a:b].tolist(), key[a:b].tolist()
            held: dict[int, int] = {}
            low, begin, end = 0, -1, -1
            for place_, own_ in zip(place, own):
                held[own_] = held.get(own_, 0) + 1
                while place[low] <= place_ - length:
                    held[own[low]] -= 1
                    if not held[own[low]]:
                        del held[own[low]]
                    low += 1
                if len(held) >= least[i]:
                    first = max(int(at[t]), place_ - length + 1)
                    if begin >= 0 and first > end:
                        yield t, i, begin, end
                        begin = -1
                    if begin < 0:
                        begin = first
                    end = min(int(at[t + 1]), place[low] + length)
            if begin >= 0:
                yield t, i, begin, end

    def lacks(self, item: int, near: set[int]) -> bool:
        """Whether too few of the item's words are there at all for a common subsequence."""
        return sum(w in near for w in self.plain[item]) < COVERED * len(self.plain[item])

    def nearness(self, item: int, near: set[int]) -> float:
        """Cosine in the latent space of an item and those words of a passage that are its own."""
        made = self.items.basis[[term for word, term in self.terms[item].items() if word in near]].sum(axis=0)
        return float(made @ self.items.vectors[item]) / max(float(np.sqrt(made @ made)), 1e-9)

    def holds(self, item: int, words: list[int], begin: int = 0) -> bool:
        """Whether passages of these words, the first one of which is word ``begin`` of its text, hold the item."""
        size, bits, answer = len(self.plain[item]), self.bits[item], self.answer[item]
        if self.lacks(item, set(words)):
            return False
        length, step = self.length(item), self.step(item)
        count = [0, *accumulate(w in bits for w in words)]
        for at in range(-begin % step, max(1, len(words) - length + step), step):
            if count[min(at + length, len(words))] - count[min(at, len(words))] < COVERED * size:
                continue
            part = words[at:at + length]
            share = common_length(bits, size, part) / size
            if share >= EXACT:
                return True
            if share >= COVERED and len(answer & set(part)) >= ANSWERED * len(answer):
                return True
        return False


def found_items(items: Items, judge: Judge, data, starts) -> list[list[int]]:
    """Ids of the items that each text of a chunk holds."""
    words, at = plain_words(data, starts)
    out: list[list[int]] = [[] for _ in range(len(at) - 1)]
    first, term, text, begin = items.rows(words, at)
    for lo in range(0, len(first), 4096):
        part = first[lo:lo + 4096]
        stop = first[lo + 4096] if lo + 4096 < len(first) else len(term)
        near = items.embed(part - part[0], term[part[0]:stop]) @ items.vectors.T >= COSINE
        for window, item in zip(*np.nonzero(near)):
            t, i = int(text[lo + window]), int(item)
            if items.ids[i] in out[t]:
                continue
            around = len(items.words[i])
            start = max(int(at[t]), int(at[t] + begin[lo + window]) - around)
            end = min(int(at[t + 1]), int(at[t] + begin[lo + window]) + WINDOW + around)
            if judge.holds(i, words[start:end].tolist(), start - int(at[t])):
                out[t].append(items.ids[i])
    for t, i, start, end in judge.regions(words, at):
        if items.ids[i] in out[t]:
            continue
        part = words[start:end].tolist()
        near = set(part)
        # a passage that cannot hold the item needs no vector
        if not judge.lacks(i, near) and judge.nearness(i, near) >= COSINE and judge.holds(i, part, start - int(at[t])):
            out[t].append(items.ids[i])
    return out


def _search(shared, place):
    def run(batches):
        items: Items = received(shared)
        judge = Judge(items)
        for batch in batches:
            found = []
            for _, data, starts in chunks(text_of(batch.column("row"), place)):
                found += found_items(items, judge, data, starts)
            held = [(old or []) + new for old, new in zip(batch.column("_items").to_pylist(), found)]
            yield batch.set_column(batch.schema.get_field_index("_items"), "_items", pa.array(held, pa.list_(pa.int64())))
    return run


def with_items(docs: DataFrame, benchmark: DataFrame, block: int = ITEMS) -> DataFrame:
    """``row`` (all columns of ``docs``) and ``_items``, the ids of the benchmark items that its text holds.

    Null and empty texts hold none; items without words or id are left out; equal items are all named.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null")
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(-(-n // block), -(-size // ITEM_BYTES))
    text = F.col("text").cast("string")
    rows = docs.select(F.struct("*").alias("row"), F.array().cast("array<bigint>").alias("_items"))
    schema = T.StructType([rows.schema["row"], T.StructField("_items", T.ArrayType(T.LongType()))])
    for b in range(blocks):
        ids, words = item_block(items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id", "text").collect())
        if ids:
            space = latent_space(docs.select(text.alias("text")), ids, words)
            rows = rows.mapInArrow(_search(shipped(spark, space), docs.columns.index("text")), schema)
    return rows.select("row", F.array_sort(F.array_distinct("_items")).alias("_items"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row: ``doc_id, contaminated, item_ids``; repeated rows and rows without id are judged each, no rows give none."""
    found = with_items(docs.select("doc_id", "text"), benchmark)
    return found.select(F.col("row.doc_id").cast("bigint").alias("doc_id"), (F.size("_items") > 0).alias("contaminated"), F.col("_items").alias("item_ids"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    return with_items(docs, benchmark).where(F.size("_items") == 0).select("row.*")
