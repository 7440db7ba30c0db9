"""Exact removal of repeated byte strings by common-prefix interval trees over enhanced suffix arrays.

Every 100-byte window has an anchor: its 32-byte gram of least hash, the leftmost of equals. Equal windows have
equal anchors at equal places, so windows can be sorted out by anchor:

1. Anchors that occur once in the corpus cannot be in a repeated window. Anchors travel as packed blocks, each at
   most once per task, and each text learns which of its anchors are repeated.
2. Runs of windows around a repeated anchor are cut out as strings and sent by anchor; a task sends equal strings
   once, with their first occurrence, as the others are known to be repeats.
3. Under an anchor, a suffix array over the distinct strings' windows, with common prefix lengths, is scanned with
   a stack. Each interval of 100 bytes or more whose occurrences are not all preceded by the same byte is a
   maximal repeat group; all its occurrences but the first are removed.
Whole copies of a text are handled before: the first one stands for all.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from staypath.llm.exchange import HELD, parts, range_starts
from staypath.llm.frames import documents, forget, merged, packed, staged, unpacked
from staypath.llm.words import Powers, chunks, joined, mix

LENGTH, GRAM = 100, 32
#: pieces of very long texts, in bytes; places in a piece take 24 bits
PIECE = 1 << 23
FIRST = -(1 << 63)


def pieces(texts, piece: int = PIECE):
    """(first text, offset in it, bytes, starts) of chunks; a text longer than ``piece`` comes in overlapping parts."""
    for first, data, starts in texts:
        if len(data) <= piece:
            yield first, 0, data, starts
        else:
            for at in range(0, len(data) - LENGTH + 1, piece):
                part = data[at:at + piece + LENGTH - 1]
                yield first, at, part, np.array([0, len(part)])


def anchors(data: np.ndarray, starts: np.ndarray):
    """Windows of a piece, as start places in order, with their anchors' places and the grams' hashes."""
    n = len(data)
    none = np.empty(0, dtype=np.int64)
    if n < LENGTH:
        return none, none, np.empty(0, dtype=np.uint64)
    up, down = Powers.of(n + 1)
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:], dtype=np.uint64)
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * down[:n - GRAM + 1])
    low = (grams & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(grams), dtype=np.uint64)
    width, have = LENGTH - GRAM + 1, 1
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[:have - width], low[width - have:])
    place = (low & np.uint64(0xFFFFFF)).astype(np.int64)
    # a window of the piece lies in one text if no text starts inside it
    end = np.zeros(n, dtype=np.int64)
    sizes = np.diff(starts)
    end = np.repeat(starts[1:], sizes)
    window = np.flatnonzero(np.arange(n - LENGTH + 1) + LENGTH <= end[:n - LENGTH + 1])
    return window, place[window], grams


def runs(window, place):
    """First and last index of runs of adjacent windows that share an anchor."""
    if not len(window):
        return window, window
    cut = np.flatnonzero((np.diff(place) != 0) | (np.diff(window) != 1))
    return np.r_[0, cut + 1], np.r_[cut, len(window) - 1]


KEYS = pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("owners", pa.binary()), ("found", pa.binary())])
KEYS_DDL = "part int, keys binary, owners binary, found binary"
PAIRS = np.dtype([("owner", "<i8"), ("key", "<i8")])


def _shared(keys, owners, alone):
    """Sorts (key, owner) pairs; returns distinct ones, where each key starts, and which keys are repeated."""
    order = np.lexsort((owners, keys))
    keys, owners, alone = keys[order], owners[order], alone[order]
    fresh = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])])
    alone = np.minimum.reduceat(alone, fresh)
    keys, owners = keys[fresh], owners[fresh]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.append(first, len(keys)))
    return keys, owners, first, size, (size > 1) | (np.minimum.reduceat(alone, first) == 0)


def _block(keys, owners, alone, ranges):
    keys, owners, first, size, many = _shared(keys, owners, alone)
    here = np.repeat(many, size)
    found = np.empty(int(here.sum()), dtype=PAIRS)
    found["owner"], found["key"] = owners[here].view(np.int64), keys[here].view(np.int64)
    keys, owners = keys[first], np.where(many, np.uint64(0), owners[first])
    at = range_starts(keys, ranges)
    used = np.flatnonzero(np.diff(at))
    own_part = int(keys[0] % np.uint64(ranges))
    return pa.RecordBatch.from_arrays([
        pa.array(used.tolist() + [own_part], pa.int32()),
        pa.array([keys[at[i]:at[i + 1]].tobytes() for i in used] + [b""], pa.binary()),
        pa.array([owners[at[i]:at[i + 1]].tobytes() for i in used] + [b""], pa.binary()),
        pa.array([b""] * len(used) + [found.tobytes()], pa.binary())], schema=KEYS)


def chunk_keys(data: np.ndarray, starts: np.ndarray, piece: int = PIECE):
    """Keys of a chunk's anchors and their texts, one for each place in a text, however many pieces it comes in."""
    found = []
    for _, offset, part, begins in pieces([(0, data, starts)], piece):
        window, place, grams = anchors(part, begins)
        spots = np.unique(place[runs(window, place)[0]])
        # an anchor is a least hash; scattered once more, keys fill all ranges evenly
        found.append((offset + spots, mix(grams[spots])))
    spots, keys = map(np.concatenate, zip(*found)) if found else (np.empty(0, np.int64), np.empty(0, np.uint64))
    if len(found) > 1:
        # windows on both sides of a border can share an anchor
        spots, one = np.unique(spots, return_index=True)
        keys = keys[one]
    return keys, np.searchsorted(starts, spots, side="right") - 1


def _anchor_keys(ranges, piece):
    def run(batches):
        held, n = [], 0
        for batch in batches:
            own = np.array(batch.column("text_hash").to_pylist(), dtype=np.int64).view(np.uint64) | np.uint64(1)
            for first, data, starts in chunks(batch.column("text"), min(TOGETHER, piece)):
                keys, text = chunk_keys(data, starts, piece)
                if not len(keys):
                    continue
                owners = own[first + text]
                order = np.lexsort((owners, keys))
                keys, owners = keys[order], owners[order]
                fresh = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])])
                # a text's key at two places is a repeat within the text; copies of a text inside a chunk count as such, too
                alone = np.diff(np.append(fresh, len(keys))) == 1
                held.append((keys[fresh], owners[fresh], alone.astype(np.int8)))
                n += len(fresh)
            if n >= HELD:
                yield _block(*map(np.concatenate, zip(*held)), ranges)
                held, n = [], 0
        if n:
            yield _block(*map(np.concatenate, zip(*held)), ranges)
    return run


def _repeated(table):
    keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint64)
    owners = np.frombuffer(b"".join(table.column("owners").to_pylist()), np.uint64)
    found = np.frombuffer(b"".join(table.column("found").to_pylist()), PAIRS)
    own, key = [found["owner"]], [found["key"]]
    if len(keys):
        keys, owners, first, size, many = _shared(keys, owners, (owners != 0).astype(np.int8))
        here = np.repeat(many, size) & (owners != 0)
        own.append(owners[here].view(np.int64))
        key.append(keys[here].view(np.int64))
    own, key = np.concatenate(own), np.concatenate(key)
    order = np.lexsort((key, own))
    own, key = own[order], key[order]
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.empty(0, np.int64)
    ends = np.append(first[1:], len(own))
    return pa.table({"owner": own[first], "keys": pa.array([key[a:b].tobytes() for a, b in zip(first, ends)], pa.binary())})


STRINGS = pa.schema([("part", pa.int32()), ("anchor", pa.int64()), ("bytes", pa.binary()), ("id", pa.int64()),
                     ("text_hash", pa.int64()), ("start", pa.int64()), ("length", pa.int64())])
STRINGS_DDL = "part int, anchor bigint, bytes binary, id bigint, text_hash bigint, start bigint, length bigint"
#: strings that a task holds before it sends them
HELD_STRINGS = 50_000
#: neighbours in a suffix array that are compared at once, and bytes of texts looked at together
COMPARED, TOGETHER = 4096, 1 << 19


def shared_strings(batch, piece):
    """(key, string, (id, text hash, start)) of the runs of windows around repeated anchors, text by text."""
    ids, hashes = batch.column("id").to_pylist(), batch.column("text_hash").to_pylist()
    blobs = batch.column("keys").to_pylist()
    for i, (text, blob) in enumerate(zip(unpacked(batch.column("text")), blobs)):
        known = np.unique(np.frombuffer(b"".join(blob), np.int64).view(np.uint64))
        for _, offset, data, starts in pieces([(0, *joined([text.as_py()]))], piece):
            window, place, grams = anchors(data, starts)
            lo, hi = runs(window, place)
            if not len(lo):
                continue
            key = mix(grams[place[lo]])
            at = np.minimum(np.searchsorted(known, key), len(known) - 1)
            take = np.flatnonzero(known[at] == key)
            raw = data.tobytes()
            for a, begin, end in zip(key[take].tolist(), window[lo[take]].tolist(), window[hi[take]].tolist()):
                yield a, raw[begin:end + LENGTH], (ids[i], hashes[i], offset + begin)


def _strings(ranges, piece):
    def run(batches):
        kept: dict[bytes, tuple] = {}
        gone: list[tuple] = []

        def repeat(row, length):
            """A repeat; joined to the one before where they touch."""
            if gone and gone[-1][:2] == row[:2] and gone[-1][2] <= row[2] <= gone[-1][2] + gone[-1][3]:
                last = gone.pop()
                gone.append((*last[:3], max(last[3], row[2] + length - last[2])))
            else:
                gone.append((*row, length))

        def flush():
            rows = [(a * ranges >> 64, a - (1 << 64) if a >> 63 else a, s, *row, len(s)) for a, s, row in kept.values()]
            rows += [(row[1] % ranges, 0, None, *row) for row in gone]
            made = pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), STRINGS)] if rows else [pa.array([], f.type) for f in STRINGS], schema=STRINGS)
            kept.clear()
            gone.clear()
            return made

        for batch in batches:
            for a, string, row in shared_strings(batch, piece):
                digest = xxhash.xxh3_128_digest(string)
                old = kept.get(digest)
                if old is None:
                    kept[digest] = (a, string, row)
                elif old[2] <= row:
                    repeat(row, len(string))
                else:
                    kept[digest] = (a, string, row)
                    repeat(old[2], len(string))
                if len(kept) + len(gone) > HELD_STRINGS:
                    yield flush()
        yield flush()
    return run


def suffix_array(strings: list[bytes]):
    """Windows of the strings in the order of their suffixes: (string, place, common prefix with the one before)."""
    size = np.array([len(s) for s in strings])
    longest = int(size.max())
    flat = np.zeros((len(strings), 2 * longest), dtype=np.uint8)
    for row, s in zip(flat, strings):
        row[:len(s)] = np.frombuffer(s, np.uint8)
    count = size - LENGTH + 1
    owner = np.repeat(np.arange(len(strings)), count)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    views = np.lib.stride_tricks.sliding_window_view(flat, longest, axis=1)
    rows = np.ascontiguousarray(views[owner, place])
    order = np.argsort(rows.view(np.dtype((np.void, longest))).ravel(), kind="stable")
    common = np.empty(max(0, len(order) - 1), dtype=np.int64)
    for at in range(0, len(common), COMPARED):
        some = order[at:at + COMPARED + 1]
        differ = rows[some[1:]] != rows[some[:-1]]
        common[at:at + len(differ)] = np.where(differ.any(axis=1), differ.argmax(axis=1), longest)
    owner, place = owner[order], place[order]
    left = size[owner] - place
    return owner, place, np.minimum(common, np.minimum(left[1:], left[:-1]))


def maximal_repeats(strings: list[bytes]):
    """Maximal repeat groups of distinct strings: (length, strings' indices, places), from the tree of common-prefix intervals."""
    owner, place, common = suffix_array(strings)
    flat = b"".join(strings)
    base = np.cumsum([0] + [len(s) for s in strings[:-1]])
    before = np.frombuffer(flat, np.uint8)[np.maximum(base[owner] + place - 1, 0)].astype(np.int16)
    before[place == 0] = -1
    open_: list[tuple[int, int]] = []
    for i, depth in enumerate([*common.tolist(), 0]):
        left = i
        while open_ and open_[-1][0] > depth:
            length, left = open_.pop()
            chars = before[left:i + 1]
            if chars.min() < 0 or chars.min() != chars.max():
                yield length, owner[left:i + 1], place[left:i + 1]
        if depth >= LENGTH and (not open_ or open_[-1][0] < depth):
            open_.append((depth, left))


SPANS_DDL = "id bigint, text_hash bigint, start bigint, length bigint"


def groups_of(rows):
    """From (string, id, text hash, start) rows under one anchor: repeat groups as (length, occurrences in order).

    Occurrences are (id, text hash, start); each group's first one is the earliest.
    """
    places: dict[bytes, list] = {}
    for string, *row in rows:
        places.setdefault(string, []).append(tuple(row))
    for own in places.values():
        own.sort()
    strings = list(places)
    for s in strings:
        if len(places[s]) > 1:
            yield len(s), places[s]
    if len(strings) > 1:
        heads = [places[s][0] for s in strings]
        for length, owner, place in maximal_repeats(strings):
            yield length, sorted((heads[o][0], heads[o][1], heads[o][2] + p) for o, p in zip(owner.tolist(), place.tolist()))


def _spans(table):
    out = [row[3:] for row in zip(*(table.column(f.name).to_pylist() for f in STRINGS)) if row[2] is None]
    by_anchor: dict[int, list] = {}
    for _, anchor, string, *row in zip(*(table.column(f.name).to_pylist() for f in STRINGS)):
        if string is not None:
            by_anchor.setdefault(anchor, []).append((string, *row[:3]))
    for rows in by_anchor.values():
        if len(rows) > 1:
            longest: dict[tuple, int] = {}
            for length, found in groups_of(rows):
                for row in found[1:]:
                    longest[row] = max(length, longest.get(row, 0))
            out += [(*row, length) for row, length in longest.items()]
    columns = list(zip(*out)) or [[], [], [], []]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("id", "text_hash", "start", "length"), columns)})


ROWS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
ROWS_DDL = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def kept_bytes(text: bytes, spans, copy: bool) -> tuple[bytes, int]:
    """What stays of a text, and how many runs are removed; a whole copy goes if it has a window at all."""
    if copy and len(text) >= LENGTH:
        return b"", 1
    if not spans:
        return text, 0
    edge = np.zeros(len(text) + 1, dtype=np.int32)
    for s in spans:
        edge[s["start"]] += 1
        edge[s["start"] + s["length"]] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())


def _kept(batches):
    for batch in batches:
        rows = []
        for doc, text, spans, copy in zip(batch.column("doc_id").to_pylist(), unpacked(batch.column("text")).to_pylist(),
                                          batch.column("spans").to_pylist(), batch.column("copy").to_pylist()):
            kept, n = kept_bytes(text or b"", spans, copy)
            rows.append((doc, len(text or b""), len(text or b"") - len(kept), n, hashlib.sha256(kept).hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 5, ROWS)], schema=ROWS)


def _sought(docs: DataFrame, piece: int):
    """(firsts, held): each distinct text's first row, and those texts with the keys of their repeated anchors."""
    spark = docs.sparkSession
    ranges = parts(spark)
    keyed = docs.select(F.coalesce("doc_id", F.lit(FIRST)).alias("id"), "text", "text_hash", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n_bytes"))
    firsts = staged(keyed.groupBy("text_hash", "n_bytes").agg(F.min("id").alias("first")))
    met = docs.select("text", "text_hash").mapInArrow(_anchor_keys(ranges, piece), KEYS_DDL)
    known = met.groupBy("part").applyInArrow(_repeated, "owner bigint, keys binary").groupBy("owner").agg(F.collect_list("keys").alias("keys"))
    sought = staged(firsts.withColumn("owner", F.col("text_hash").bitwiseOR(F.lit(1))).join(known, "owner").select(
        F.col("first").alias("id"), "text_hash", "keys"))
    forget(spark)
    return firsts, merged(packed(keyed.select("id", "text", "text_hash")), sought, ("id", "text_hash"), "inner")


def repeat_spans(docs: DataFrame, piece: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """(firsts, spans) of ``documents`` rows.

    ``firsts`` has each distinct text's first row as ``text_hash, n_bytes, first``; ``spans`` the repeated strings
    of those rows as ``id, text_hash, start, length``. Rows without id come first.
    """
    firsts, held = _sought(docs, piece)
    strings = held.mapInArrow(_strings(parts(docs.sparkSession), piece), STRINGS_DDL)
    return firsts, staged(strings.groupBy("part").applyInArrow(_spans, SPANS_DDL))


def _digest(string: bytes) -> int:
    """A string's 64-bit hash as a signed number."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(string)).astype(np.int64))


PLACES_DDL = "string bigint, id bigint, text_hash bigint, start bigint"


def _places(piece):
    """Where each string around a repeated anchor is, equal ones included."""
    def run(batches):
        for batch in batches:
            rows = [(_digest(string), *row) for _, string, row in shared_strings(batch, piece)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 4)], names=["string", "id", "text_hash", "start"])
    return run


GROUPS_DDL = "group bigint, length bigint, string bigint, place bigint"


def _groups(table):
    """Maximal repeat groups over the distinct strings of each anchor, and each string as a group of its own: places in strings."""
    out, by_anchor = set(), {}
    for _, anchor, string, *_ in zip(*(table.column(f.name).to_pylist() for f in STRINGS)):
        if string is not None:
            by_anchor.setdefault(anchor, set()).add(string)
    for strings in map(sorted, by_anchor.values()):
        own = [_digest(s) for s in strings]
        out.update((d, len(s), d, 0) for d, s in zip(own, strings))
        if len(strings) > 1:
            for length, owner, place in maximal_repeats(strings):
                name = _digest(strings[owner[0]][place[0]:place[0] + length])
                out.update((name, length, own[o], p) for o, p in zip(owner.tolist(), place.tolist()))
    columns = list(zip(*out)) or [[], [], [], []]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("group", "length", "string", "place"), columns)})


def repeat_groups(docs: DataFrame, piece: int = PIECE) -> DataFrame:
    """``group, length, id, text_hash, start``: all occurrences of each maximal repeat of ``LENGTH`` bytes or more.

    A group is known by the hash of its bytes; its rows are all places of these bytes in the distinct texts (``id`` is a text's
    first row, the least number if that has no id). Repeats are maximal within the windows that share an anchor: what goes
    on under another anchor is a group of its own. Groups come from the distinct strings of an anchor and meet the strings'
    places in a join, so a passage that very many texts hold is never gathered in one task.
    """
    _, held = _sought(documents(docs), piece)
    strings = held.mapInArrow(_strings(parts(docs.sparkSession), piece), STRINGS_DDL)
    groups = staged(strings.groupBy("part").applyInArrow(_groups, GROUPS_DDL))
    places = staged(held.mapInArrow(_places(piece), PLACES_DDL))
    found = groups.join(places, "string").select("group", "length", "id", "text_hash", (F.col("start") + F.col("place")).alias("start")).distinct()
    many = found.groupBy("group").agg(F.count("*").alias("n")).where("n > 1").select("group")
    return found.join(many, "group").select("group", "length", "id", "text_hash", "start")


def remove_repeats(docs: DataFrame, piece: int = PIECE) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    A byte is removed if a 100-byte string over it also starts earlier: in a row with a smaller doc_id, or
    earlier in the same one. Null and empty texts have no bytes; repeated rows are one document.
    """
    spark = docs.sparkSession
    docs = documents(docs)
    firsts, spans = repeat_spans(docs, piece)
    forget(spark)
    per_text = spans.groupBy("id", "text_hash").agg(F.collect_list(F.struct("start", "length")).alias("spans"))
    ids = docs.select("doc_id", "text_hash", F.coalesce("doc_id", F.lit(FIRST)).alias("id"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("n_bytes"))
    later = ids.distinct().join(firsts, ["text_hash", "n_bytes"]).where("id > first").select("id", "text_hash", F.lit(True).alias("copy"))
    facts = later.join(per_text, ["id", "text_hash"], "full")
    rows = packed(docs).withColumn("id", F.coalesce("doc_id", F.lit(FIRST)))
    joined_rows = merged(rows, facts, ("id", "text_hash")).select("doc_id", "text", "spans", F.coalesce("copy", F.lit(False)).alias("copy"))
    return joined_rows.mapInArrow(_kept, ROWS_DDL)
