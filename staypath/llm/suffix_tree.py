"""Language model scoring with a probabilistic suffix tree over words.

Contexts are sequences of up to ``depth`` words, and with each of them the words that follow it, that the training text holds
``least`` times or more; that number is the same for a corpus of any size. A context is a state of the tree if its next-word
distribution diverges enough from that of its suffix, or a longer state ends in it. Distributions are smoothed by absolute
discounting towards the suffix's; the root has (c + 0.1) / (N + 0.1 * (V + 1)) for every word, seen or not. A word is scored
in the longest suffix of what comes before it that is a state.

1. Words, then sequences of 2 to ``depth`` + 1 words are counted over all training text: summed in tasks, sent as packed
   blocks and merged by key range. A longer sequence is only looked at where its two shorter ones may be frequent, which bit
   tables of fixed size answer; they never deny one that is.
2. Contexts are dealt by their last word, so a context, its suffixes and what follows them meet in one part, where
   divergences are tested and distributions smoothed. Only states and their next words are stored.
3. States are sent to the tasks in groups of bounded size; the text is read once for each group, and what a group adds to
   the score of a text is summed up. The root's part needs no group: words that make up 2^-20 of all tokens are sent along,
   and all others meet their (document, word) pairs in the range of the word.
"""

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from staypath.llm.exchange import BLOCK_DDL, HELD, blocks, merge_counts, parts, range_starts
from staypath.llm.frames import discard, documents, forget, received, shipped, staged
from staypath.llm.phrases import Grams, bit_table, longer, may_hold, phrase_keys
from staypath.llm.words import Counts, Table, chunks, mix, word_hashes

#: occurrences of a context, and of a word after it, that are enough
LEAST = 8
DEPTH = 3
DISCOUNT = 0.5
#: bits of code length that a state has to save over its suffix
DIVERGENCE = 32.0
ADDED = 0.1
END = np.uint64(0x0E17D0000000001)
#: share of the tokens above which a word's root probability is sent to the tasks; other words are looked up by shuffle
SENT = 2.0 ** -20
#: next words of states that are sent to the tasks at once, and that are fitted in one part
GROUP, PART = 1 << 21, 1 << 17
#: sequences that a task holds before it sends them
HELD_SEQUENCES = 1_000_000


def tokens(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a chunk's texts, each text closed by ``END``, and where each text starts."""
    words, at = word_hashes(data, starts)
    n = len(at) - 1
    out = np.empty(len(words) + n, dtype=np.uint64)
    owner = np.repeat(np.arange(n), np.diff(at))
    out[np.arange(len(words)) + owner] = words
    out[at[1:] + np.arange(n)] = END
    return out, at + np.arange(n + 1)


@dataclass
class Words:
    """Frequent words with the root's log10 probabilities."""

    words: np.ndarray
    chance: np.ndarray
    total: int
    distinct: int

    def __post_init__(self):
        self.index = Table(self.words)

    @property
    def space(self) -> float:
        return self.total + ADDED * (self.distinct + 1)


def _word_counts(ranges):
    def run(batches):
        counts = Counts()
        for batch in batches:
            for first, data, starts in chunks(batch.column("text")):
                counts.add(tokens(data, starts)[0])
        keys, n = counts.total()
        if len(keys):
            yield blocks(keys, n, ranges)
    return run


def _vocabulary(table):
    keys, n = merge_counts(table)
    return pa.table({"keys": pa.array([keys.tobytes()], pa.binary()), "counts": pa.array([n.astype("<u8").tobytes()], pa.binary()),
                     "total": [int(n.sum())], "words": [len(keys)]})


def _frequent(least):
    def run(batches):
        for batch in batches:
            for keys, counts in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist()):
                keys, counts = np.frombuffer(keys, np.uint64), np.frombuffer(counts, "<u8").astype(np.int64)
                kept = counts >= least
                yield pa.RecordBatch.from_arrays([pa.array(keys[kept].view(np.int64)), pa.array(counts[kept])], names=["key", "n"])
    return run


SEQUENCES = pa.schema([("part", pa.int32()), ("words", pa.binary()), ("counts", pa.binary())])


def _sequence_blocks(size, shared, ranges):
    """Counts of the sequences of ``size`` tokens whose two shorter ones may be frequent."""
    def block(grams):
        keys, words, n = grams.total()
        at = range_starts(keys, ranges)
        used = np.flatnonzero(np.diff(at))
        return pa.RecordBatch.from_arrays([
            pa.array(used, pa.int32()), pa.array([words[at[i]:at[i + 1]].tobytes() for i in used], pa.binary()),
            pa.array([n[at[i]:at[i + 1]].astype("<i8").tobytes() for i in used], pa.binary())], schema=SEQUENCES)

    def run(batches):
        bits, grams = shared.value, Grams(size)
        for batch in batches:
            for _, data, starts in chunks(batch.column("text")):
                found, at = tokens(data, starts)
                if len(found) < size:
                    continue
                shorter = found
                for k in range(1, size - 1):
                    shorter = longer(shorter[:len(found) - k], found[k:])
                good = may_hold(bits, shorter)
                text = np.repeat(np.arange(len(at) - 1), np.diff(at))
                here = np.flatnonzero(good[:-1] & good[1:] & (text[:len(found) - size + 1] == text[size - 1:]))
                grams.add(found[here[:, None] + np.arange(size)])
                # a batch holds many chunks: send what is held after each, so no more than one chunk goes past the limit
                if grams.known + grams.waiting >= HELD_SEQUENCES:
                    yield block(grams)
                    grams = Grams(size)
        if grams.known + grams.waiting:
            yield block(grams)
    return run


SEQUENCE_DDL = "key bigint, words array<bigint>, n bigint"


def _sequences(size, least):
    def run(table):
        grams = Grams(size)
        grams.words = [np.frombuffer(w, np.uint64).reshape(-1, size) for w in table.column("words").to_pylist()]
        grams.counts = [np.frombuffer(c, "<i8") for c in table.column("counts").to_pylist()]
        keys, words, n = grams.total()
        kept = n >= least
        words = words[kept].view(np.int64)
        return pa.table({"key": pa.array(keys[kept].view(np.int64)), "words": pa.ListArray.from_arrays(
            pa.array(np.arange(len(words) + 1) * size, pa.int32()), pa.array(words.reshape(-1))), "n": pa.array(n[kept])})
    return run


@dataclass
class Level:
    """States of one length and what follows them: keys, log10 weights of what is left to the suffix, and log10 gains over the root."""

    states: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.uint64))
    rest: np.ndarray = field(default_factory=lambda: np.empty(0))
    entries: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.uint64))
    gain: np.ndarray = field(default_factory=lambda: np.empty(0))


def fit_levels(contexts, entries, divergence: float = DIVERGENCE) -> list[Level]:
    """Prunes contexts and smooths distributions of one part.

    Per length: ``contexts`` has words (a row each) and counts, ``entries`` context and next word, counts and log10 root
    probabilities. A part has the suffixes of all its contexts.
    """
    depth = len(contexts)
    own = [phrase_keys(w) for w, _ in contexts]
    order = [np.argsort(k) for k in own]
    keys = [k[o] for k, o in zip(own, order)]
    counts = [n[o].astype(float) for (_, n), o in zip(contexts, order)]
    tails = [None if not d else np.searchsorted(keys[d - 1], phrase_keys(contexts[d][0][order[d]][:, 1:])) for d in range(depth)]
    made = [phrase_keys(w) for w, _, _ in entries]
    by = [np.argsort(k) for k in made]
    made = [k[o] for k, o in zip(made, by)]
    words = [w[o] for (w, _, _), o in zip(entries, by)]
    seen = [n[o].astype(float) for (_, n, _), o in zip(entries, by)]
    root = [10.0 ** r[o] for (_, _, r), o in zip(entries, by)]
    context = [np.searchsorted(keys[d], phrase_keys(words[d][:, :-1])) for d in range(depth)]
    below_at = [None if not d else np.searchsorted(made[d - 1], phrase_keys(words[d][:, 1:])) for d in range(depth)]

    def smoothed(state):
        chance, rest, lower = [], [], []
        for d in range(depth):
            part = (seen[d] - DISCOUNT) / counts[d][context[d]]
            left = 1.0 - np.bincount(context[d], part, minlength=len(keys[d]))
            left = np.where(state[d], np.maximum(left, 1e-12), 1.0)
            below = root[d] if not d else chance[d - 1][below_at[d]]
            chance.append(np.where(state[d][context[d]], part + left[context[d]] * below, below))
            rest.append(left)
            lower.append(below)
        return chance, rest, lower

    chance, rest, lower = smoothed([np.ones(len(k), dtype=bool) for k in keys])
    state = []
    for d in range(depth):
        follow = np.bincount(context[d], seen[d], minlength=len(keys[d]))
        saved = np.bincount(context[d], seen[d] * np.log2(chance[d] / lower[d]), minlength=len(keys[d]))
        state.append((saved + (counts[d] - follow) * np.log2(rest[d]) >= divergence) & (follow > 0))
    for d in range(depth - 1, 0, -1):
        state[d - 1][tails[d][state[d]]] = True
    chance, rest, _ = smoothed(state)
    out = []
    for d in range(depth):
        kept = state[d][context[d]]
        out.append(Level(keys[d][state[d]], np.log10(rest[d][state[d]]), made[d][kept], np.log10(chance[d][kept]) - np.log10(root[d][kept])))
    return out


FITTED_DDL = "part int, level int, n bigint, states binary, rest binary, entries binary, gain binary"
FITTED = pa.schema([("part", pa.int32()), ("level", pa.int32()), ("n", pa.int64()), *[(c, pa.binary()) for c in ("states", "rest", "entries", "gain")]])


def _fit_part(depth, divergence):
    def run(table):
        part = table.column("part")[0].as_py()
        words, n, root = (table.column(c).combine_chunks() for c in ("words", "n", "root"))
        sizes = pc.list_value_length(words).to_numpy()
        follows = table.column("root").combine_chunks().is_valid().to_numpy(zero_copy_only=False)

        def rows(size, chosen):
            at = np.flatnonzero((sizes == size) & (follows == chosen))
            flat = words.take(pa.array(at)).flatten().to_numpy().view(np.uint64).reshape(-1, size)
            return flat, n.take(pa.array(at)).to_numpy(), root.take(pa.array(at)).to_numpy(zero_copy_only=False)

        fitted = fit_levels([rows(k, False)[:2] for k in range(1, depth + 1)], [rows(k + 1, True) for k in range(1, depth + 1)], divergence)
        return pa.Table.from_arrays([
            pa.array([part] * depth, pa.int32()), pa.array(range(1, depth + 1), pa.int32()), pa.array([len(x.entries) + len(x.states) for x in fitted], pa.int64()),
            *[pa.array([getattr(x, c).tobytes() for x in fitted], pa.binary()) for c in ("states", "rest", "entries", "gain")]], schema=FITTED)
    return run


class States:
    """States of some parts, ready to score tokens."""

    def __init__(self, rows):
        """``rows`` as (level, states, rest, entries, gain)."""
        self.levels = []
        for level in range(1, max((r[0] for r in rows), default=0) + 1):
            own = [r for r in rows if r[0] == level]
            states, rest, entries, gain = (np.frombuffer(b"".join(r[c] for r in own), kind) for c, kind in ((1, np.uint64), (2, "<f8"), (3, np.uint64), (4, "<f8")))
            self.levels.append((Table(states), rest, Table(entries), gain))

    def gains(self, found: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Per token: what its state adds to the root's log10 probability."""
        out = np.zeros(len(found))
        place = np.arange(len(found)) - np.repeat(at[:-1], np.diff(at))
        here = np.flatnonzero(place >= 1)
        for length, (states, rest, entries, gain) in enumerate(self.levels, 1):
            key = found[here - length]
            for k in range(length - 1, 0, -1):
                key = longer(key, found[here - k])
            state = states.find(key)
            held = state >= 0
            here, key, state = here[held], key[held], state[held]
            entry = entries.find(longer(key, found[here]))
            out[here] = np.where(entry >= 0, gain[entry] if len(gain) else 0.0, out[here] + rest[state])
            here = here[place[here] > length]
        return out


@dataclass
class Model:
    """Words sent along, and the stored parts of the tree in groups."""

    tree: Words
    fitted: DataFrame
    groups: int

    def group(self, number: int) -> States:
        rows = self.fitted.where(F.pmod("part", F.lit(self.groups)) == number).collect()
        return States([(r["level"], bytes(r["states"]), bytes(r["rest"]), bytes(r["entries"]), bytes(r["gain"])) for r in rows])


def token_scores(words: Words, states: States, found: np.ndarray, at: np.ndarray):
    """Per token: whether it is a word sent along, its log10 base probability and its log10 probability in its state.

    For other tokens both leave out the factor of the root.
    """
    ids = words.index.find(found)
    base = np.where(ids >= 0, words.chance[ids], 0.0) if len(words.chance) else np.zeros(len(found))
    return ids >= 0, base, base + states.gains(found, at)


ROWS = pa.schema([("doc_id", pa.int64()), ("owner", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                  ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])
ROWS_DDL = "doc_id bigint, owner bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double"


def _scored(shared):
    def run(batches):
        words, states = received(shared)
        for batch in batches:
            out = []
            for _, data, starts in chunks(batch.column("text")):
                found, at = tokens(data, starts)
                known, base, score = token_scores(words, states, found, at)
                out.append((np.diff(at), *(np.add.reduceat(x, at[:-1]) for x in (known.astype(np.int64), base, score))))
            n, known, base, score = map(np.concatenate, zip(*out)) if out else [np.empty(0)] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("owner"), batch.column("held_out"), pa.array(n, pa.int64()),
                 pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())], schema=ROWS)
    return run


def _gained(shared):
    """What one more group of states adds to each text."""
    def run(batches):
        states = received(shared)
        for batch in batches:
            gains = [np.empty(0)]
            for _, data, starts in chunks(batch.column("text")):
                found, at = tokens(data, starts)
                gains.append(np.add.reduceat(states.gains(found, at), at[:-1]))
            yield pa.RecordBatch.from_arrays([batch.column("owner"), pa.array(np.concatenate(gains))], names=["owner", "gain"])
    return run


RARE_DDL = "part int, keys binary, owners binary, times binary"
RARE = pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("owners", pa.binary()), ("times", pa.binary())])


def _rare(shared, ranges):
    """(word, document, occurrences) of words outside the tree; the lowest bit of the number says training text."""
    def block(keys, owners, times):
        order = np.argsort(keys, kind="stable")
        keys, owners, times = keys[order], owners[order], times[order]
        at = range_starts(keys, ranges)
        used = np.flatnonzero(np.diff(at))
        cut = lambda x: pa.array([x[at[i]:at[i + 1]].tobytes() for i in used], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), cut(keys), cut(owners), cut(times)], schema=RARE)

    def run(batches):
        frequent = received(shared)
        held, n = [], 0
        for batch in batches:
            owner = np.array(batch.column("owner").to_pylist(), dtype=np.int64)
            train = ~np.array(batch.column("held_out").to_pylist(), dtype=bool)
            for first, data, starts in chunks(batch.column("text")):
                found, at = tokens(data, starts)
                some = np.flatnonzero(frequent.find(found) < 0)
                if not len(some):
                    continue
                text = np.searchsorted(at, some, side="right") - 1
                order = np.lexsort((found[some], text))
                word, text = found[some][order], text[order]
                new = np.flatnonzero(np.r_[True, (word[1:] != word[:-1]) | (text[1:] != text[:-1])])
                times = np.diff(np.append(new, len(word))).astype(np.uint32)
                row = first + text[new]
                held.append((word[new], owner[row], times << np.uint32(1) | train[row].astype(np.uint32)))
                n += len(new)
            if n >= HELD:
                yield block(*map(np.concatenate, zip(*held)))
                held, n = [], 0
        if n:
            yield block(*map(np.concatenate, zip(*held)))
    return run


SUMS_DDL = "part int, owners binary, n_known binary, base binary"


def _rare_sums(space, ranges):
    def run(table):
        read = lambda c, kind: np.frombuffer(b"".join(table.column(c).to_pylist()), kind)
        keys, owners, times = read("keys", np.uint64), read("owners", np.int64), read("times", "<u4")
        order = np.argsort(keys, kind="stable")
        keys, owners, times = keys[order], owners[order], times[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        n = (times >> 1).astype(np.int64)
        count = np.add.reduceat(np.where(times & 1, n, 0), first)
        count = np.repeat(count, np.diff(np.append(first, len(keys))))
        base = n * np.log10((count + ADDED) / space)
        return _by_owner(owners, np.where(count > 0, n, 0), base, ranges)
    return run


def _summed(owners, known, base):
    order = np.argsort(owners, kind="stable")
    owners = owners[order]
    first = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]]) if len(owners) else np.empty(0, np.int64)
    if not len(first):
        return owners, known, base
    return owners[first], np.add.reduceat(known[order], first), np.add.reduceat(base[order], first)


def _by_owner(owners, known, base, ranges):
    owners, known, base = _summed(owners, known, base)
    spread = mix(owners.view(np.uint64))
    order = np.argsort(spread)
    at = range_starts(spread[order], ranges)
    used = np.flatnonzero(np.diff(at))
    cut = lambda x: pa.array([x[order[at[i]:at[i + 1]]].tobytes() for i in used], pa.binary())
    return pa.table({"part": used.astype(np.int32), "owners": cut(owners), "n_known": cut(known.astype(np.int64)), "base": cut(base)})


def _owner_sums(table):
    read = lambda c, kind: np.frombuffer(b"".join(table.column(c).to_pylist()), kind)
    owners, known, base = _summed(read("owners", np.int64), read("n_known", np.int64), read("base", np.float64))
    return pa.table({"owner": owners, "more_known": known, "more": base})


def held_out() -> "F.Column":
    """Rows that nothing is learned from: one in ten by id, and those without an id."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0


def learn(docs: DataFrame, depth: int = DEPTH, least: int = LEAST, divergence: float = DIVERGENCE, group: int = GROUP) -> Model:
    """The model of the rows of ``doc_id, text, held_out`` that are not held out."""
    spark = docs.sparkSession
    ranges = parts(spark)
    train = docs.where(~F.col("held_out")).select("text")
    vocabulary = staged(train.mapInArrow(_word_counts(ranges), BLOCK_DDL).groupBy("part").applyInArrow(
        _vocabulary, "keys binary, counts binary, total bigint, words bigint"))
    total, distinct = (x or 0 for x in vocabulary.agg(F.sum("total"), F.sum("words")).first())
    space = total + ADDED * (distinct + 1)
    packed_words = vocabulary.select("keys", "counts")
    # at most 2^20 words, as they make up that share of the tokens each
    sent = packed_words.mapInArrow(_frequent(max(2, int(np.ceil(SENT * total)))), "key bigint, n bigint").toArrow()
    key, n = sent.column("key").to_numpy().view(np.uint64), sent.column("n").to_numpy()
    order = np.argsort(key)
    words = Words(key[order], np.log10((n[order] + ADDED) / space), total, distinct)
    known = staged(packed_words.mapInArrow(_frequent(least), "key bigint, n bigint"))
    counted, before = [known.select("key", F.array("key").alias("words"), "n")], known
    for size in range(2, depth + 2):
        shared = spark.sparkContext.broadcast(bit_table(before))
        made = train.mapInArrow(_sequence_blocks(size, shared, ranges), "part int, words binary, counts binary")
        before = staged(made.groupBy("part").applyInArrow(_sequences(size, least), SEQUENCE_DDL))
        counted.append(before)
    followed = reduce(DataFrame.unionByName, counted[1:])
    n_parts = 1 + followed.count() // PART
    part = lambda word: F.pmod(F.xxhash64(word), F.lit(n_parts)).cast("int").alias("part")
    contexts = reduce(DataFrame.unionByName, counted[:-1]).select(
        part(F.element_at("words", -1)), "words", "n", F.lit(None).cast("double").alias("root"))
    root = known.select(F.col("key").alias("next"), F.log10((F.col("n") + ADDED) / space).alias("root"))
    entries = followed.withColumn("next", F.element_at("words", -1)).join(root, "next").select(
        part(F.element_at("words", -2)), "words", "n", "root")
    fitted = staged(contexts.unionByName(entries).groupBy("part").applyInArrow(_fit_part(depth, divergence), FITTED_DDL))
    size = fitted.agg(F.sum("n")).first()[0] or 0
    # the model reads only the fitted parts: the counts it was fitted from go before the texts are scored
    discard(vocabulary, *counted)
    return Model(words, fitted, max(1, -(-size // group)))


def text_scores(docs: DataFrame, depth: int = DEPTH, least: int = LEAST, divergence: float = DIVERGENCE, group: int = GROUP) -> DataFrame:
    """Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Words are lower-cased (A-Z) runs of bytes other than space and 0x09 to 0x0D, and every text, null and empty
    ones too, closes with an end token. Without training rows every word has the root's probability of 1.
    Sums of rare words are matched to rows by a 64-bit hash of id and text; repeated rows get equal results.
    """
    spark = docs.sparkSession
    rows = documents(docs).withColumn("held_out", held_out())
    model = learn(rows, depth, least, divergence, group)
    forget(spark)
    owned = rows.select("doc_id", "text", "held_out", F.xxhash64(F.coalesce("doc_id", F.lit(-1)), "text_hash").alias("owner"))
    scored = owned.mapInArrow(_scored(shipped(spark, (model.tree, model.group(0)))), ROWS_DDL)
    ranges = parts(spark, 1)
    pairs = owned.mapInArrow(_rare(shipped(spark, model.tree.index), ranges), RARE_DDL).groupBy("part").applyInArrow(_rare_sums(model.tree.space, ranges), SUMS_DDL)
    sums = pairs.groupBy("part").applyInArrow(_owner_sums, "owner bigint, more_known bigint, more double")
    scored = scored.join(sums, "owner", "left")
    if model.groups > 1:
        gains = [staged(owned.select("owner", "text").mapInArrow(_gained(shipped(spark, model.group(g))), "owner bigint, gain double").groupBy("owner").agg(F.max("gain").alias("gain")))
                 for g in range(1, model.groups)]
        scored = scored.join(reduce(DataFrame.unionByName, gains).groupBy("owner").agg(F.sum("gain").alias("gain")), "owner", "left")
    else:
        scored = scored.withColumn("gain", F.lit(0.0))
    more = F.coalesce("more", F.lit(0.0))
    return scored.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.tree.total).cast("bigint").alias("train_tokens"), (F.col("base") + more).alias("base_score"),
        (F.col("score") + more + F.coalesce("gain", F.lit(0.0))).alias("score"))
