"""I-Match fingerprints: distinct terms of a band of document frequency, hashed through random sub-lexicons."""

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from staypath.llm.exchange import blocks, counted, merge_counts, parts
from staypath.llm.frames import documents, packed, unpacked
from staypath.llm.words import Counts, Table, chunks, joined, mix, word_hashes

#: share of documents that a term of the lexicon is in; the inverse document frequency band
LEAST, MOST = 0.0005, 0.05
#: sub-lexicons; subset k keeps a term with probability 2 ** -RATES[k % len(RATES)]
SUBSETS, RATES = 64, (2, 4, 5, 6, 7, 8, 9, 10)


def _frequencies(ranges):
    def run(batches):
        counts = Counts()
        for batch in batches:
            for _, data, starts in chunks(batch.column("text")):
                words, at = word_hashes(data, starts)
                counts.add(np.concatenate([np.unique(words[a:b]) for a, b in zip(at, at[1:])]))
        keys, n = counts.total()
        if len(keys):
            yield blocks(keys, n, ranges)
    return run


def _banded(low, high):
    def run(table):
        keys, n = merge_counts(table)
        kept = (n >= low) & (n <= high)
        return pa.table({"term": keys[kept].view(np.int64), "n_docs": n[kept]})
    return run


def lexicon(docs: DataFrame, least: float = LEAST, most: float = MOST) -> DataFrame:
    """``term`` (word hash), ``n_docs`` of the words in ``least`` to ``most`` of all documents.

    It has at most (mean distinct words of a document) / ``least`` terms, however many documents there are.
    """
    n, ranges = docs.count(), parts(docs.sparkSession, 1)
    return counted(docs.select("text"), _frequencies(ranges), _banded(max(2, least * n), max(2, most * n)),
                   "term bigint, n_docs bigint")


@dataclass
class SubLexicons:
    """Terms and, for each, the sub-lexicons that keep it as bits."""

    terms: np.ndarray
    seed: int = 0

    def __post_init__(self):
        self.terms = np.sort(self.terms)
        self.table = Table(self.terms)
        bits = np.zeros((len(self.terms), SUBSETS), dtype=bool)
        for k in range(SUBSETS):
            draw = mix(self.terms ^ np.uint64(mix(np.array([self.seed * SUBSETS + k + 1], dtype=np.uint64))[0]))
            bits[:, k] = draw >> np.uint64(64 - RATES[k % len(RATES)]) == 0
        self.bits = bits

    def signatures(self, texts: list[bytes | None]) -> np.ndarray:
        """32-bit signature of each text (rows) under each sub-lexicon; 0 where it keeps no term.

        A text that has words, but none of the lexicon, has the hash of its whole term set everywhere.
        """
        data, starts = joined(texts)
        words, at = word_hashes(data, starts)
        found = self.table.find(words)
        out = np.zeros((len(texts), SUBSETS), dtype=np.uint32)
        for i, (a, b) in enumerate(zip(at, at[1:])):
            own = np.unique(found[a:b])
            own = own[1:] if len(own) and own[0] < 0 else own
            if not len(own):
                if b > a:  # no term of the band: only an equal set of terms is alike
                    out[i] = xxhash.xxh32_intdigest(np.unique(words[a:b]).tobytes()) | 1
                continue
            subset, index = np.nonzero(self.bits[own].T)
            kept = self.terms[own[index]].tobytes()
            edges = np.searchsorted(subset, np.arange(SUBSETS + 1)).tolist()
            for k in range(SUBSETS):
                if edges[k] < edges[k + 1]:
                    out[i, k] = xxhash.xxh32_intdigest(kept[8 * edges[k]:8 * edges[k + 1]]) | 1
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal signatures among the sub-lexicons that keep a term of either text; 1 if none does."""
    used = ((a != 0) | (b != 0)).sum(axis=1)
    same = ((a == b) & (a != 0)).sum(axis=1)
    return np.where(used == 0, 1.0, same / np.maximum(used, 1))


def _named(signatures: np.ndarray) -> list[str]:
    return [row.astype(">u4").tobytes().hex() for row in signatures]


ROWS = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
ROWS_DDL = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double")


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _dealt(edges, firsts):
    """Gives each row its range, and the first row of a range to the range before as well, as its end."""
    edges = np.array(edges, dtype=np.int64)

    def run(batches):
        for batch in batches:
            ids = np.array([-(1 << 63) if i is None else i for i in batch.column("doc_id").to_pylist()], dtype=np.int64)
            bucket = np.searchsorted(edges, ids, side="right").astype(np.int32)
            made = pa.RecordBatch.from_arrays(
                [pa.array(bucket), pa.array(np.zeros(len(ids), bool)), *batch.columns],
                names=["bucket", "tail", *batch.schema.names])
            yield made
            ends = [(i, before) for i, key in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist()))
                    for before in firsts.get(key, ())]
            if ends:
                again = batch.take(pa.array([i for i, _ in ends]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for _, b in ends], pa.int32()), pa.array([True] * len(ends)), *again.columns],
                    names=["bucket", "tail", *batch.schema.names])
    return run


def _fingerprints(shared):
    def run(batches):
        lexicons = SubLexicons(shared.value)
        held = None  # (bucket, doc_id, text, signature) of the row before
        for batch in batches:
            texts = unpacked(batch.column("text")).to_pylist()
            rows = list(zip(batch.column("bucket").to_pylist(), batch.column("doc_id").to_pylist(), texts))
            tails = batch.column("tail").to_pylist()
            for lo in range(0, len(rows), 200):
                part, tail = rows[lo:lo + 200], tails[lo:lo + 200]
                own = lexicons.signatures([t for _, _, t in part])
                if held:
                    part, own, tail = [held[:3], *part], np.vstack([held[3][None], own]), [False, *tail]
                pairs = [i for i in range(len(part) - 1)
                         if not tail[i] and part[i][0] == part[i + 1][0]]
                held = (*part[-1], own[-1]) if not tail[-1] else None
                if not pairs:
                    continue
                plain = [(part[i][2] or b"").decode() for i in pairs]
                new = [edited(t, (part[i + 1][2] or b"").decode()).encode() for t, i in zip(plain, pairs)]
                theirs = lexicons.signatures(new)
                at = np.array(pairs)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part[i][1] for i in pairs], pa.int64()), pa.array([len(t) for t in plain], pa.int64()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in new]), pa.array(_named(own[at])),
                    pa.array(_named(theirs)), pa.array(likeness(own[at], theirs)),
                    pa.array(likeness(own[at], own[at + 1]))], schema=ROWS)
    return run


def fingerprints(docs: DataFrame, least: float = LEAST, most: float = MOST) -> DataFrame:
    """Per row: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    Rows are ordered by (doc_id, text hash), null ids first; the next one of the last is the first, and a
    lone row is its own next one. A fingerprint has 8 hex digits for each sub-lexicon; texts without words
    (null, empty) share the fingerprint of zeros, and those without a term of the lexicon agree with equal term sets only. An empty table gives no rows.

    Documents are ranged by id; each range also gets the first row of the one after it.
    """
    spark = docs.sparkSession
    docs = documents(docs)
    terms = lexicon(docs, least, most).toPandas()["term"].to_numpy()
    ranges = parts(spark, 1)
    order = F.coalesce("doc_id", F.lit(-(1 << 63)))
    cuts = docs.agg(F.percentile_approx(order, [i / ranges for i in range(1, ranges)] or [0.5], F.lit(10 * ranges + 100))).first()[0] or []
    edges = sorted(set(cuts))
    bucket = F.aggregate(F.array(*[F.lit(e).cast("bigint") for e in edges]), F.lit(0), lambda n, e: n + (order >= e).cast("int")) if edges else F.lit(0)
    heads = (
        docs.select(bucket.alias("bucket"), F.struct(order.alias("o"), "doc_id", "text_hash").alias("row"))
        .groupBy("bucket").agg(F.min("row").alias("row")).orderBy("bucket").collect())
    firsts: dict[tuple, list[int]] = {}
    for before, head in zip([heads[-1], *heads] if heads else [], heads):
        firsts.setdefault((head.row.doc_id, head.row.text_hash), []).append(before.bucket)
    ddl = "bucket int, tail boolean, doc_id bigint, text binary, text_hash bigint"
    dealt = packed(docs).mapInArrow(_dealt(edges, firsts), ddl)
    ordered = dealt.repartition(ranges, "bucket").sortWithinPartitions("bucket", "tail", "doc_id", "text_hash")
    shared = spark.sparkContext.broadcast(terms.view(np.uint64))
    return ordered.mapInArrow(_fingerprints(shared), ROWS_DDL)
