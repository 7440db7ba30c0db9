"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

Texts are cut into chunks that no piece of the model crosses. Candidates of a chunk leave its agenda by score, then place, and
a hash of the occurrence's key and the candidate's three borders says whether one is skipped. A task remembers, for the chunks
it meets, the agenda in which nothing is skipped: its ids and the borders of its turns. The draws of all turns of all
occurrences in a window of text are hashed at once; occurrences without a skipped turn take the remembered ids, and the
agendas of all others run side by side in numpy, each with draws of its own. Ids stay flat arrays from end to end.
"""

import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from staypath.llm.spans import gathered
from staypath.llm.words import BASE, Powers, Table, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: a chunk ends where no piece of the model can go on: before a space that follows something else, around \n and \t
CHUNK = re.compile(r" *[^ \n\t]+|[\n\t]| +")
#: characters of texts that are read at once, and of a window whose chunks are segmented at once
READ, WINDOW = 1_000_000, 250_000
#: bytes of remembered agendas, after which a task begins anew; rows of agendas that run side by side
REMEMBERED, ROWS_AT_ONCE = 16 << 20, 1 << 14
#: chunks of more characters keep their agenda in a heap
LONG = 48
MASK, SCATTER, NONE = (1 << 64) - 1, 0x9E3779B97F4A7C15, 1 << 30


class Known:
    """Agendas without skips, by hash of their chunk: ids and borders of the turns, each in one growing array."""

    def __init__(self):
        self.hashes = np.empty(0, dtype=np.uint64)
        self.order = np.empty(0, dtype=np.int64)
        self.ids, self.borders = np.empty(0, dtype=np.int32), np.empty(0, dtype=np.uint64)
        self.at, self.size = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        self.turn, self.turns = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[place] == hashes, self.order[place], -1)

    def add(self, hashes, ids, at, size, borders, turn, turns):
        n = len(self.at)
        self.at, self.size = np.append(self.at, at + len(self.ids)), np.append(self.size, size)
        self.turn, self.turns = np.append(self.turn, turn + len(self.borders)), np.append(self.turns, turns)
        self.ids, self.borders = np.append(self.ids, ids), np.append(self.borders, borders)
        hashes, order = np.append(self.hashes, hashes), np.append(self.order, np.arange(n, n + len(at)))
        by = np.argsort(hashes)
        self.hashes, self.order = hashes[by], order[by]

    @property
    def bytes(self) -> int:
        return self.ids.nbytes + self.borders.nbytes + 6 * self.at.nbytes


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after another."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


class Segmenter:
    """A BPE model with byte fallback. ``rate`` is the chance that a candidate merge is skipped."""

    def __init__(self, model: bytes, rate: float = 0.1, seed: int = 0):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ids, self.ranks, self.raw, self.byte_ids = {}, {}, [], {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            raw = b""
            if sp.is_byte(i):
                raw = bytes([int(piece[3:5], 16)])
                self.byte_ids[raw[0]] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[piece], self.ranks[piece] = i, -sp.get_score(i)
                raw = piece.replace(SPACE, " ").encode()
                if re.search(rf"[\n\t]|[^{SPACE}]{SPACE}", piece):
                    raise ValueError(f"piece {piece!r} crosses the end of a chunk")
            self.raw.append(raw)
        if len(self.byte_ids) < 256:
            raise ValueError("the model lacks byte pieces, so decoding could lose text")
        self.skip, self.seed = int(rate * (1 << 20)), seed
        self.known = Known()
        self.raw_size = np.array([len(r) for r in self.raw])
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        self.raw_bytes = np.frombuffer(b"".join(self.raw), dtype=np.uint8)
        self.bytes_as_ids = np.array([self.byte_ids[i] for i in range(256)], dtype=np.int32)
        # char ids by code point; unknown ones lie beyond the pieces and are in no pair
        self.chars = np.arange(0x110000, dtype=np.int64) + len(self.raw)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.chars[ord(piece)] = i
        self.chars[0x20], self.chars[ord(SPACE)] = self.ids[SPACE], len(self.raw) + ord(SPACE)
        order = {score: n for n, score in enumerate(sorted(set(self.ranks.values())))}
        pairs = [(self.ids[p[:k]] << 32 | self.ids[p[k:]], order[self.ranks[p]], i)
                 for p, i in self.ids.items() for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids]
        keys, rank, made = (np.array(c, dtype=np.int64) for c in zip(*pairs))
        self.table, self.rank, self.made = Table(mix(keys.view(np.uint64))), np.append(rank, NONE).astype(np.int32), np.append(made, -1).astype(np.int32)

    def _pairs(self, a: np.ndarray, b: np.ndarray):
        """Rank and id of the piece that two neighbours make, ``NONE`` where there is none."""
        a, b = np.asarray(a, dtype=np.int64), np.asarray(b, dtype=np.int64)
        at = self.table.find(mix((a << 32 | b).view(np.uint64)))
        at[(a < 0) | (b < 0)] = -1
        return self.rank[at], self.made[at]

    def segment_many(self, chunks: list[str], variant: int) -> list[tuple[int, ...]]:
        """Piece ids of chunks, keyed by seed, variant and chunk."""
        head = b"%d:%d:" % (self.seed, variant)
        return self.segment_keyed(chunks, np.array([xxhash.xxh3_64_intdigest(head + c.encode()) for c in chunks], dtype=np.uint64))

    def segment_keyed(self, chunks: list[str], keys: np.ndarray) -> list[tuple[int, ...]]:
        """Piece ids of occurrences of chunks, each with its own key."""
        size = np.array([len(c) for c in chunks], dtype=np.int64)
        points = np.frombuffer("".join(chunks).encode("utf-32-le"), "<u4")
        ids, n = self.segment(points, np.cumsum(size) - size, size, keys)
        ends = np.cumsum(n)
        return [tuple(ids[b - k:b].tolist()) for b, k in zip(ends.tolist(), n.tolist())]

    def segment(self, points: np.ndarray, start: np.ndarray, size: np.ndarray, keys: np.ndarray):
        """Piece ids of all chunks one after another, and how many each has.

        Chunks are ranges of code points; candidates leave a chunk's agenda by score, then place. A hash of the chunk's key and
        the candidate's three borders says whether one is skipped; a skipped one comes back only as part of another candidate.
        """
        symbols = self.chars[points]
        short = size <= LONG
        rows = np.flatnonzero(short)
        way = self._ways(points, symbols, start[rows], size[rows])
        known = self.known
        turns = known.turns[way]
        row = np.repeat(np.arange(len(rows)), turns)
        drawn = mix(keys[rows[row]] ^ known.borders[ranges(known.turn[way], turns)]) >> np.uint64(44) < np.uint64(self.skip)
        own = np.zeros(len(rows), dtype=bool)
        own[row[drawn]] = True
        parts = [(rows[~own], known.ids, known.at[way[~own]], known.size[way[~own]])]
        again = rows[own]
        for lo in range(0, len(again), ROWS_AT_ONCE):
            some = again[lo:lo + ROWS_AT_ONCE]
            ids, at, n, *_ = self._agendas(symbols, start[some], size[some], keys[some])
            parts.append((some, ids, at, n))
        for i in np.flatnonzero(~short).tolist():
            ids = np.array(self._spelt(self._merged_heap(symbols[start[i]:start[i] + size[i]].tolist(), int(keys[i]))), dtype=np.int32)
            parts.append((np.array([i]), ids, np.array([0]), np.array([len(ids)])))
        count = np.zeros(len(start), dtype=np.int64)
        for some, _, _, n in parts:
            count[some] = n
        place = np.cumsum(count) - count
        out = np.empty(int(count.sum()), dtype=np.int32)
        for some, ids, at, n in parts:
            out[ranges(place[some], n)] = ids[ranges(at, n)]
        return out, count

    def _ways(self, points, symbols, start, size):
        """Number in ``known`` of each chunk's agenda without skips; new ones are run."""
        up, down = Powers.of(len(points) + 1)
        sums = np.zeros(len(points) + 1, dtype=np.uint64)
        np.cumsum(mix(points.astype(np.uint64) + np.uint64(BASE)) * up[:len(points)], out=sums[1:], dtype=np.uint64)
        hashes = mix((sums[start + size] - sums[start]) * down[start])
        own, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        way = self.known.find(own)
        if self.known.bytes > REMEMBERED and (way < 0).any():
            self.known = Known()
            way = self.known.find(own)
        new = np.flatnonzero(way < 0)
        for lo in range(0, len(new), ROWS_AT_ONCE):
            some = new[lo:lo + ROWS_AT_ONCE]
            n = len(self.known.at)
            self.known.add(own[some], *self._agendas(symbols, start[first[some]], size[first[some]]))
            way[some] = np.arange(n, n + len(some))
        return way[back]

    def _agendas(self, symbols, start, size, keys=None):
        """Runs chunks of up to ``LONG`` characters: ids, where each chunk's are and how many.

        Without keys nothing is skipped, and the borders of all turns come as well, with their places and numbers.
        """
        ids, borders, n_ids, n_turns = [np.empty(0, dtype=np.int32)], [np.empty(0, dtype=np.uint64)], 0, 0
        at, count, turn, turns = (np.zeros(len(size), dtype=np.int64) for _ in range(4))
        for low, high in zip((0, 4, 6, 9, 13, 20), (4, 6, 9, 13, 20, LONG)):
            rows = np.flatnonzero((size > low) & (size <= high))
            if not len(rows):
                continue
            own, n, found, m = self._step(symbols, start[rows], size[rows], None if keys is None else keys[rows], high)
            at[rows], count[rows] = n_ids + np.cumsum(n) - n, n
            turn[rows], turns[rows] = n_turns + np.cumsum(m) - m, m
            ids.append(own)
            borders.append(found)
            n_ids, n_turns = n_ids + len(own), n_turns + len(found)
        return np.concatenate(ids), at, count, np.concatenate(borders), turn, turns

    def _step(self, flat, start, size, keys, width):
        """Merges in rows of up to ``width`` characters, all in step; neighbours are linked, so a merge moves nothing."""
        n = len(start)
        column = np.arange(width, dtype=np.int32)
        symbols = np.where(column < size[:, None], flat[np.minimum(start[:, None] + column, len(flat) - 1)], -1).astype(np.int32)
        rank = np.full((n, width), NONE, dtype=np.int32)
        made = np.empty((n, width), dtype=np.int32)
        pairs = self._pairs(symbols[:, :-1].ravel(), symbols[:, 1:].ravel())
        rank[:, :-1], made[:, :-1] = (x.reshape(n, width - 1) for x in pairs)
        after = np.minimum(column + 1, size[:, None]).astype(np.int32)
        before = np.tile(column - 1, (n, 1))
        live = np.arange(n)
        seen = [(live[:0], np.empty(0, dtype=np.uint64))]
        while len(live):
            at = rank[live].argmin(axis=1)
            open_ = rank[live, at] != NONE
            live, at = live[open_], at[open_]
            j = after[live, at]
            end = np.where(j < size[live], after[live, np.minimum(j, width - 1)], j)
            borders = at.astype(np.uint64) << np.uint64(40) | j.astype(np.uint64) << np.uint64(20) | end.astype(np.uint64)
            line = live
            if keys is None:
                seen.append((live, borders))
            else:
                skip = mix(keys[live] ^ borders) >> np.uint64(44) < np.uint64(self.skip)
                rank[live[skip], at[skip]] = NONE
                line, at, j, end = live[~skip], at[~skip], j[~skip], end[~skip]
            both = made[line, at]
            symbols[line, at], symbols[line, j], rank[line, j], after[line, at] = both, -1, NONE, end
            right = end < size[line]
            before[line[right], end[right]] = at[right]
            rank[line[~right], at[~right]] = NONE
            back = before[line, at]
            left = back >= 0
            place = np.concatenate([at[right], back[left]])
            own = np.concatenate([line[right], line[left]])
            a = np.concatenate([both[right], symbols[line[left], back[left]]])
            b = np.concatenate([symbols[line[right], end[right]], both[left]])
            rank[own, place], made[own, place] = self._pairs(a, b)
        left = symbols >= 0
        ids, count = self._spelt_flat(symbols[left], left.sum(axis=1))
        row, borders = (np.concatenate(c) for c in zip(*seen))
        return ids, count, borders[np.argsort(row, kind="stable")], np.bincount(row, minlength=n)

    def _spelt_flat(self, symbols: np.ndarray, count: np.ndarray):
        """As :meth:`_spelt` for many chunks, and how many ids each chunk then has."""
        n = len(self.raw)
        point = symbols - n
        if not len(symbols) or point.max() < 0:
            return symbols, count
        size = np.where(point < 0, 1, 1 + (point >= 0x80).astype(np.int64) + (point >= 0x800) + (point >= 0x10000))
        nth = ranges(np.zeros(len(size), dtype=np.int64), size)
        value, long = np.repeat(point, size), np.repeat(size, size)
        # bytes of UTF-8: a head that tells the length, then six bits a byte
        bits = value >> (6 * (long - 1 - nth))
        byte = np.where(nth > 0, 0x80 | bits & 0x3F, np.where(long == 1, bits, (0xF00 >> long & 0xFF) & 0xFF | bits))
        out = np.where(value < 0, value + n, self.bytes_as_ids[byte & 0xFF]).astype(np.int32)
        owner = np.repeat(np.repeat(np.arange(len(count)), count), size)
        return out, np.bincount(owner, minlength=len(count))

    def _spelt(self, symbols: list[int]) -> tuple[int, ...]:
        """Ids with unknown characters in bytes."""
        n = len(self.raw)
        if max(symbols) < n:
            return tuple(symbols)
        out = []
        for i in symbols:
            out += [i] if i < n else [self.byte_ids[b] for b in chr(i - n).encode()]
        return tuple(out)

    def _merged_heap(self, symbols: list[int], key: int) -> list[int]:
        """The same for one long chunk, with its agenda in a heap."""
        n, skip = len(symbols), self.skip
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []

        def offer(left, right):
            for i, j, r, m in zip(left, right, *(x.tolist() for x in self._pairs(
                    np.array([symbols[i] for i in left]), np.array([symbols[j] for j in right])))):
                if r != NONE:
                    heapq.heappush(agenda, (r, i, j, symbols[i], symbols[j], m))

        if n > 1:
            offer(list(range(n - 1)), list(range(1, n)))
        while agenda:
            _, i, j, a, b, both = heapq.heappop(agenda)
            if symbols[i] != a or symbols[j] != b or after[i] != j:
                continue
            end = after[j]
            if skip and int(mix(np.array([key ^ (i << 40 | j << 20 | end)], dtype=np.uint64))[0]) >> 44 < skip:
                continue
            symbols[i], symbols[j], after[i] = both, -1, end
            near = []
            if end < n:
                before[end] = i
                near.append((i, end))
            if before[i] >= 0:
                near.append((before[i], i))
            if near:
                offer(*zip(*near))
        return [s for s in symbols if s >= 0]

    def encode_flat(self, texts: list[str | None], keys: np.ndarray):
        """Piece ids of texts one after another, and how many each has; null and empty texts have none.

        Seed, a text's key and the place in it draw which candidates are skipped there.
        """
        held = [" " + t if t else "" for t in texts]
        size = np.array([len(t) for t in held], dtype=np.int64)
        points = np.frombuffer("".join(held).encode("utf-32-le"), "<u4")
        if not len(points):
            return np.empty(0, dtype=np.int32), np.zeros(len(texts), dtype=np.int64)
        space, line = points == 32, (points == 10) | (points == 9)
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins |= line
        begins[1:] |= line[:-1]
        begins[(np.cumsum(size) - size)[size > 0]] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(points))
        text = np.searchsorted(np.cumsum(size), start, side="right")
        head = mix(keys.astype(np.int64).view(np.uint64) ^ mix(np.array([self.seed * SCATTER & MASK], dtype=np.uint64)))
        place = np.arange(len(start)) - np.searchsorted(text, text)
        drawn = mix(place.astype(np.uint64) + head[text])
        ids, count = [], []
        low = 0
        while low < len(start):
            high = max(low + 1, int(np.searchsorted(end, start[low] + WINDOW, side="right")))
            first = start[low]
            made, n = self.segment(points[first:end[high - 1]], start[low:high] - first, (end - start)[low:high], drawn[low:high])
            ids.append(made)
            count.append(n)
            low = high
        per_text = np.zeros(len(texts), dtype=np.int64)
        np.add.at(per_text, text, np.concatenate(count))
        return np.concatenate(ids), per_text

    def encode_many(self, texts: list[str | None], keys: list[int]) -> list[list[int] | None]:
        """Piece ids of texts; null gives null, an empty text no piece."""
        ids, n = self.encode_flat(texts, np.array([(k & MASK) - ((k & MASK) >> 63 << 64) for k in keys], dtype=np.int64))
        ends = np.cumsum(n)
        return [None if t is None else ids[b - k:b].tolist() for t, b, k in zip(texts, ends.tolist(), n.tolist())]

    def encode(self, text: str | None, key: int = 0) -> list[int] | None:
        return self.encode_many([text], [key])[0]

    def decode_flat(self, ids: np.ndarray, count: np.ndarray) -> list[bytes]:
        """UTF-8 of texts whose ids stand one after another."""
        out, start = gathered(self.raw_bytes, self.raw_start[ids], (self.raw_start + self.raw_size)[ids], np.zeros(len(ids), dtype=np.int64))
        cut = start[np.append(0, np.cumsum(count))].tolist()
        return [out[a + 1:b].tobytes() for a, b in zip(cut, cut[1:])]

    def decode(self, ids: list[int] | None) -> str | None:
        if ids is None:
            return None
        return b"".join(map(self.raw.__getitem__, ids)).decode()[1:]


def model_bytes(spark: SparkSession, path: str):
    """The model file, read on the driver and sent to the executors; such files have a few MB at most."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def _slices(batch):
    """Parts of a batch with about ``READ`` bytes of text, or one longer text."""
    size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto, low = np.cumsum(size), 0
    while low < len(size):
        high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + READ, side="right")))
        yield batch.slice(low, high - low)
        low = high


def _listed(ids, count, texts):
    ends = np.append(0, np.cumsum(count))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()), mask=pa.array([t is None for t in texts]))


def _encoded(model, rate, seed):
    def run(batches):
        made = Segmenter(model.value, rate, seed)
        for batch in batches:
            for rows in _slices(batch):
                texts = rows.column("text").to_pylist()
                ids, n = made.encode_flat(texts, rows.column("key").to_numpy())
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), _listed(ids, n, texts)], names=["doc_id", "ids"])
    return run


def _keyed(docs):
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64("doc_id").alias("key"))


def encode(docs: DataFrame, model: str = MODEL, rate: float = 0.1, seed: int = 0) -> DataFrame:
    """``doc_id, ids`` of every row. With rate 0 these are the ids of the model's own encoder.

    The segmentation follows seed, doc_id and text alone, so a task that runs again gives the same ids.
    Null texts have null ids, empty ones none. A literal U+2581 is spelt in bytes, so that it stays one.
    """
    shared = model_bytes(docs.sparkSession, model)
    return _keyed(docs).mapInArrow(_encoded(shared, rate, seed), "doc_id bigint, ids array<int>")


def _decoded(model):
    def run(batches):
        made = Segmenter(model.value, 0.0)
        for batch in batches:
            texts = [made.decode(i) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])
    return run


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``."""
    shared = model_bytes(encoded.sparkSession, model)
    rows = encoded.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids")
    return rows.mapInArrow(_decoded(shared), "doc_id bigint, text string")


ROWS = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("n_pieces", pa.int64()), ("ids_sha256", pa.string()),
                  ("decoded_sha256", pa.string()), ("lossless", pa.bool_())])


def _tripped(model, rate, seed, with_ids):
    schema = ROWS.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else ROWS

    def run(batches):
        made = Segmenter(model.value, rate, seed)
        for batch in batches:
            for rows in _slices(batch):
                texts = rows.column("text").to_pylist()
                ids, n = made.encode_flat(texts, rows.column("key").to_numpy())
                ends = np.cumsum(n).tolist()
                back = made.decode_flat(ids, n)
                columns = [
                    rows.column("doc_id"), pa.array([len(t or "") for t in texts], pa.int64()), pa.array(n, pa.int64()),
                    pa.array([hashlib.sha256(ids[a:b].astype("<i4").tobytes()).hexdigest() for a, b in zip([0, *ends], ends)], pa.string()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in back], pa.string()),
                    pa.array([(t or "").encode() == b for t, b in zip(texts, back)], pa.bool_())]
                yield pa.RecordBatch.from_arrays([*columns, _listed(ids, n, texts)] if with_ids else columns, schema=schema)
    return run


def round_trips(docs: DataFrame, model: str = MODEL, rate: float = 0.1, seed: int = 0, with_ids: bool = False) -> DataFrame:
    """Encodes and decodes every text: sizes, digests of ids and decoded text, whether nothing was lost, and the ids if asked for.

    Null texts count as empty, their ids are null. Repeated rows, and rows without id that have equal texts, get equal ids.
    """
    shared = model_bytes(docs.sparkSession, model)
    ddl = "doc_id bigint, n_chars bigint, n_pieces bigint, ids_sha256 string, decoded_sha256 string, lossless boolean"
    return _keyed(docs).mapInArrow(_tripped(shared, rate, seed, with_ids), ddl + ", ids array<int>" * with_ids)
