"""Lines that many documents share: hashes in range order, first occurrences streamed, keep bitmaps returned."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from staypath.llm.frames import documents, merged, staged
from staypath.llm.words import SPACES

MIN_DOCS = 10
KEYS = "line bigint, doc_id bigint, text_hash bigint, n_lines bigint, positions binary"
MARKS = "line bigint, hot boolean, doc_id bigint, text_hash bigint, n_lines bigint, positions binary"


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _lines(min_chars):
    def run(batches):
        schema = pa.schema([("line", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()),
                            ("n_lines", pa.int64()), ("positions", pa.binary())])
        for batch in batches:
            out = [[], [], [], [], []]
            for doc, text, known in zip(batch.column("doc_id").to_pylist(),
                                        batch.column("text").cast(pa.binary()).to_pylist(),
                                        batch.column("text_hash").to_pylist()):
                lines = (text or b"").split(b"\n")
                at: dict[int, list[int]] = {}
                for i, line in enumerate(lines):
                    key = line.strip(SPACES).lower()
                    if len(key) >= min_chars and (min_chars < 2 or len(key.decode()) >= min_chars):
                        at.setdefault(xxhash.xxh3_64_intdigest(key), []).append(i)
                for key, places in at.items():
                    for column, value in zip(out, (_signed(key), doc, known, len(lines),
                                                   np.asarray(places, "<u4").tobytes())):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)
    return run


def _stream(min_docs):
    """Over rows in order of (line, document): those of lines in ``min_docs`` or more documents.

    Holds fewer than ``min_docs`` rows of a line. The first and the last line of a partition may go on in
    another one, so they are returned as pending, with their line, unless they reach the number here;
    then a row without document says that the line is hot.
    """
    def run(batches):
        line, first, count, held, last_row = None, True, 0, [], None
        out = [[] for _ in range(6)]

        def put(rows, key=None):
            for row in rows:
                for column, value in zip(out, (key, None, *row)):
                    column.append(value)

        def close(edge):
            if edge and line is not None:
                if count >= min_docs:
                    for column, value in zip(out, (line, True, None, None, None, None)):
                        column.append(value)
                else:
                    put(held, line)

        schema = pa.schema([("line", pa.int64()), ("hot", pa.bool_()), ("doc_id", pa.int64()),
                            ("text_hash", pa.int64()), ("n_lines", pa.int64()), ("positions", pa.binary())])

        def batch_out():
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)
            for c in out:
                c.clear()
            return made

        for batch in batches:
            keys = batch.column("line").to_pylist()
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "n_lines", "positions")))
            for key, row in zip(keys, rows):
                if key != line:
                    close(first)
                    first = line is None
                    line, count, held, last_row = key, 0, [], None
                if row[:2] == last_row:
                    continue
                last_row = row[:2]
                count += 1
                if count < min_docs:
                    held.append(row)
                else:
                    put(held)
                    put([row])
                    held = []
            yield batch_out()
        close(True)
        yield batch_out()
    return run


def _bitmaps(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("keep", pa.binary())])
    for batch in batches:
        keeps, dropped = [], []
        for n, places in zip(batch.column("n_lines").to_pylist(), batch.column("places").to_pylist()):
            keep = np.ones(n, dtype=bool)
            keep[np.frombuffer(b"".join(places), "<u4")] = False
            keeps.append(zlib.compress(np.packbits(keep).tobytes(), 1))
            dropped.append(n - int(keep.sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), batch.column("n_lines"), pa.array(dropped, pa.int64()),
             pa.array(keeps, pa.binary())], schema=schema)


def keep_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = 1) -> DataFrame:
    """``doc_id, text_hash, n_lines, n_dropped, keep`` of each document that loses lines.

    A line's key is the line stripped of white space and lower-cased (A-Z). Keys of ``min_chars`` or more
    code points in ``min_docs`` or more documents are dropped everywhere. ``keep`` is a zlib-squeezed
    bitmap, one bit per line, first line in the highest bit.

    Keys are ranged by (hash, document), so a line that a third of all documents share spreads over many
    partitions; only the two lines at the edges of a partition need a look at others. Null and empty texts
    are one empty line, which is never dropped; repeated rows count once; an empty table gives no rows.
    """
    keyed = staged(documents(docs).mapInArrow(_lines(min_chars), KEYS))
    order = ["line", "doc_id", "text_hash"]
    marks = staged(
        keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_stream(min_docs), MARKS))
    rows = marks.where("line is null").select("doc_id", "text_hash", "n_lines", "positions")
    row = F.struct("doc_id", "text_hash", "n_lines", "positions")
    pending = (
        marks.where("line is not null").groupBy("line")
        .agg(F.collect_list(F.when(F.col("hot").isNull(), row)).alias("rows"), F.max("hot").alias("hot"))
        .where(F.coalesce("hot", F.lit(False)) | (F.size("rows") >= min_docs))
        .select(F.inline("rows")))
    return (
        rows.unionByName(pending).groupBy("doc_id", "text_hash", "n_lines")
        .agg(F.collect_list("positions").alias("places"))
        .mapInArrow(_bitmaps, "doc_id bigint, text_hash bigint, n_lines bigint, n_dropped bigint, keep binary"))


def kept_text(text: bytes | None, keep: bytes | None) -> bytes | None:
    """``text`` without the lines whose bit is not set; without bitmap it stays as it is."""
    if keep is None:
        return text
    lines = (text or b"").split(b"\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
    return b"\n".join(line for line, bit in zip(lines, bits) if bit)


def _applied(batches):
    for batch in batches:
        texts = [kept_text(t, k) for t, k in zip(batch.column("text").cast(pa.binary()).to_pylist(),
                                                 batch.column("keep").to_pylist())]
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pa.array(texts, pa.binary()).cast(pa.string())).drop_columns(["keep"])


def drop_shared_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = 1) -> DataFrame:
    """``docs`` with the dropped lines taken out of ``text``; all columns stay, null texts stay null."""
    bitmaps = keep_bitmaps(docs, min_docs, min_chars).select("doc_id", "text_hash", "keep")
    others = [c for c in docs.columns if c != "text"]
    quoted = {c: c.replace("`", "``") for c in others}
    named = docs.select(F.struct(*[F.col(f"`{quoted[c]}`") for c in others]).alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
                        F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.col("text").cast("string").alias("text"))
    joined = merged(named, bitmaps).select("row", "text", "keep")
    done = joined.mapInArrow(_applied, T.StructType([joined.schema["row"], joined.schema["text"]]))
    return done.select(*[(F.col("text") if c == "text" else F.col(f"row.`{quoted[c]}`")).alias(c) for c in docs.columns])


def _digests(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string())])
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        keeps = batch.column("keep").to_pylist()
        sums = [hashlib.sha256(kept_text(t, k) or b"").hexdigest() for t, k in zip(texts, keeps)]
        lines = [(t or b"").count(b"\n") + 1 for t in texts]
        lost = [x or 0 for x in batch.column("n_dropped").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(lines, pa.int64()), pa.array(lost, pa.int64()), pa.array(sums, pa.string())], schema=schema)


def line_digests(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = 1) -> DataFrame:
    """Per row: ``doc_id, n_lines, n_dropped, kept_sha256``."""
    bitmaps = keep_bitmaps(docs, min_docs, min_chars).drop("n_lines")
    joined = merged(documents(docs), bitmaps).select("doc_id", "text", "n_dropped", "keep")
    return joined.mapInArrow(_digests, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string")
