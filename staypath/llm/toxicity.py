"""Toxicity by non-negative positive-unlabelled learning.

A document is read as slots: hashed words and beginnings of words. A slot's evidence is how much more often
it is in confirmed toxic documents than in unlabelled text, which is all training text without a look at its labels. As that
holds toxic documents with the class prior, no slot can be more frequent in the first than 1 / prior times, which sets the
scale of the evidence. How many documents have a slot is counted over the whole corpus. A linear classifier over the shares
of a document's slots above each level of evidence is then fitted to the non-negative PU risk, on a bounded sample. Evidence
and classifier come from different halves of the documents.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from staypath.llm.frames import staged, text_of
from staypath.llm.words import chunks, mix, word_heads

#: evidence comes from at most so many confirmed documents and all unlabelled ones, classifiers are fitted on at most so many of either
POSITIVES, UNLABELLED = 3000, 9000
MODELS = 2
BITS, LEVELS = 20, 16
#: bytes of a word's beginnings that are slots besides the word
HEADS = (3, 4, 5, 6)
#: documents of each kind that a slot is taken to have been seen in beforehand
SMOOTHING = 3.0


def slots(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of a chunk's texts, and where each text's slots start."""
    words, at, heads = word_heads(data, starts, HEADS)
    made = np.stack([words, *[mix(h + np.uint64(k)) for k, h in zip(HEADS, heads)]], axis=1)
    return (made >> np.uint64(64 - BITS)).astype(np.int32).ravel(), at * (len(HEADS) + 1)


def presence(column: pa.Array) -> np.ndarray:
    """In how many texts each slot is."""
    seen = np.zeros(1 << BITS, dtype=np.int32)
    for _, data, starts in chunks(column):
        flat, at = slots(data, starts)
        for a, b in zip(at, at[1:]):
            seen[np.unique(flat[a:b])] += 1
    return seen


def evidence(positive: np.ndarray, unlabelled: np.ndarray, n_positive: int, n_unlabelled: int, prior: float) -> np.ndarray:
    """Level of each slot, 0 to ``LEVELS``: the log ratio of its frequencies in parts of log(1 / prior)."""
    ratio = (positive + SMOOTHING) / (unlabelled * (n_positive / n_unlabelled) + SMOOTHING)
    return np.clip(np.floor(np.log(ratio) / -np.log(prior) * LEVELS), 0, LEVELS).astype(np.uint8)


def shares(column: pa.Array, level: np.ndarray):
    """Per text and level from 1: root of the share of slots at this level or above; 0 for texts without words."""
    out = []
    for _, data, starts in chunks(column):
        flat, at = slots(data, starts)
        size = np.diff(at)
        n = len(size)
        cell = np.repeat(np.arange(n), size) * (LEVELS + 1) + level[flat]
        counts = np.bincount(cell, minlength=n * (LEVELS + 1)).reshape(n, LEVELS + 1)
        above = counts[:, ::-1].cumsum(axis=1)[:, ::-1][:, 1:]
        out.append(np.sqrt(above / np.maximum(size, 1)[:, None]))
    return np.concatenate(out) if out else np.zeros((0, LEVELS))


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def minimise(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 1500, step: float = 0.05, decay: float = 1e-3):
    """Weights (the last one is the bias) of the least non-negative PU risk under the logistic loss.

    The risk is prior * loss(positive, toxic) + max(0, loss(unlabelled, clean) - prior * loss(positive, clean)).
    Where the second term is below zero the model fits the positives among the unlabelled as clean, and its
    gradient is turned round.
    """
    p, u = np.c_[positive, np.ones(len(positive))], np.c_[unlabelled, np.ones(len(unlabelled))]
    w, mean, square = np.zeros(p.shape[1]), np.zeros(p.shape[1]), np.zeros(p.shape[1])
    for n in range(1, steps + 1):
        zp, zu = p @ w, u @ w
        clean = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        slope = u.T @ _sigmoid(zu) / len(u) - prior * (p.T @ _sigmoid(zp)) / len(p)
        slope = prior * (p.T @ (_sigmoid(zp) - 1)) / len(p) + slope if clean >= 0 else -slope
        slope[:-1] += decay * w[:-1]
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope ** 2
        w -= step * (mean / (1 - 0.9 ** n)) / (np.sqrt(square / (1 - 0.999 ** n)) + 1e-8)
    return w


SEEN = pa.schema([("half", pa.int32()), ("part", pa.int32()), ("counts", pa.binary()), ("n", pa.int64())])
SEEN_DDL = "half int, part int, counts binary, n bigint"
#: parts in which the counts of a half travel
SEEN_PARTS = 64


def _seen(batches):
    """How many texts of a task have each slot, for either half."""
    counts, n = np.zeros((2, 1 << BITS), dtype=np.int32), [0, 0]
    for batch in batches:
        half = batch.column("half").to_numpy()
        for h in (0, 1):
            own = batch.column("text").filter(pa.array(half == h))
            counts[h] += presence(own)
            n[h] += len(own)
    for h in (0, 1):
        for i, part in enumerate(np.split(counts[h], SEEN_PARTS)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([h], pa.int32()), pa.array([i], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary()), pa.array([n[h]])], schema=SEEN)


def _total(table):
    total = np.zeros((1 << BITS) // SEEN_PARTS, dtype=np.int64)
    for counts in table.column("counts").to_pylist():
        total += np.frombuffer(zlib.decompress(counts), np.int32)
    return pa.table({"half": table.column("half")[:1], "part": table.column("part")[:1], "counts": pa.array([total.tobytes()], pa.binary()),
                     "n": pa.array([sum(table.column("n").to_pylist())], pa.int64())})


def frequencies(rows: DataFrame) -> tuple[np.ndarray, list[int]]:
    """Of each half of ``text, half`` rows, how many texts have each slot, and how many there are; 2^20 numbers a half."""
    totals = rows.mapInArrow(_seen, SEEN_DDL).groupBy("half", "part").applyInArrow(_total, SEEN_DDL).collect()
    counts, n = np.zeros((2, SEEN_PARTS, (1 << BITS) // SEEN_PARTS), dtype=np.int64), [0, 0]
    for row in totals:
        counts[row["half"], row["part"]] = np.frombuffer(row["counts"], np.int64)
        n[row["half"]] = row["n"]
    return counts.reshape(2, -1), n


MODEL = pa.schema([("model", pa.int32()), ("level", pa.binary()), ("weights", pa.binary())])


def _fit(prior, shared):
    def run(table):
        m = table.column("model")[0].as_py()
        counts, n = shared.value
        toxic = np.array(table.column("toxic").to_pylist(), dtype=bool)
        half = np.array(table.column("half").to_pylist()) == m % 2
        part = lambda chosen: table.column("text").filter(pa.array(chosen)).combine_chunks()
        known, p, u = part(toxic & half), part(toxic & ~half), part(~toxic & ~half)
        if min(len(known), len(p), len(u), n[m % 2]) == 0:
            return MODEL.empty_table()
        level = evidence(presence(known), counts[m % 2], len(known), n[m % 2], prior)
        p, u = shares(p, level), shares(u, level)
        middle, spread = u.mean(axis=0), u.std(axis=0) + 1e-3
        w = minimise((p - middle) / spread, (u - middle) / spread, prior)
        scaled = np.append(w[:-1] / spread, w[-1] - (w[:-1] * middle / spread).sum())
        return pa.table([[m], [level.tobytes()], [scaled.tobytes()]], schema=MODEL)
    return run


def held_out() -> "F.Column":
    """Rows that nothing is learned from: one in five by id, and those without an id."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> list:
    """Classifiers as (levels, weights): an empty list if there are too few examples of either kind.

    Confirmed are documents with a label row that says toxic (the largest of several label rows counts); unlabelled are all
    training documents, labelled or not, as only so they hold toxic ones with the prior, which is the toxic share of
    labelled documents. Slots are counted over all of them. For the rest the documents with the smallest hash of their
    id are taken, up to the given numbers of either kind; ties of the hash go by id. Held-out rows never are, nor rows
    without id; repeated rows count each time.
    """
    spark = docs.sparkSession
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out()))
    prior = known.where("toxic is not null").agg(F.avg("toxic")).first()[0]
    if not prior or prior >= 1:
        return []
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = rows.select("doc_id").where("doc_id is not null").where(~held_out())
    draw = F.xxhash64("doc_id", F.lit(1))
    some = known.where("toxic = 1").select("doc_id").join(ids.distinct(), "doc_id", "left_semi")
    confirmed = some.orderBy(draw, "doc_id").limit(positives).withColumn("toxic", F.lit(True))
    others = ids.distinct().orderBy(draw, "doc_id").limit(unlabelled).withColumn("toxic", F.lit(False))
    chosen = staged(confirmed.unionByName(others))  # at most positives + unlabelled ids
    halved = rows.where("doc_id is not null").withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(2)).cast("int"))
    shared = spark.sparkContext.broadcast(frequencies(halved.where(~held_out()).select("text", "half")))
    sample = halved.join(F.broadcast(chosen), "doc_id")
    copies = sample.withColumn("model", F.explode(F.array(*[F.lit(m) for m in range(MODELS)])))
    fitted = copies.groupBy("model").applyInArrow(_fit(prior, shared), "model int, level binary, weights binary").collect()
    return [(np.frombuffer(r.level, np.uint8), np.frombuffer(r.weights)) for r in sorted(fitted, key=lambda r: r.model)]


def score(column: pa.Array, models: list) -> np.ndarray:
    """Probability of being toxic per text; 0 without models."""
    if not models:
        return np.zeros(len(column))
    z = sum(np.c_[shares(column, level), np.ones(len(column))] @ w for level, w in models)
    return _sigmoid(z / len(models))


def _scored(shared):
    def run(batches):
        for batch in batches:
            scores = score(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])
    return run


def toxicity(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted``. Texts without words get the score of no evidence.

    Equal texts have equal scores, repeated rows and rows without id among them; a score of 0.5 counts as toxic.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, positives, unlabelled))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ddl = "doc_id bigint, held_out boolean, score double, predicted int"
    return rows.withColumn("held_out", held_out()).mapInArrow(_scored(shared), ddl)


def _clean(shared, at):
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(score(text_of(batch.column("row"), at), shared.value) < 0.5))
    return run


def drop_toxic(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, positives, unlabelled))
    rows = docs.select(F.struct("*").alias("row"))
    return rows.mapInArrow(_clean(shared, docs.columns.index("text")), rows.schema).select("row.*")
