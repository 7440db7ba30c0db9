"""Small DataFrame helpers that several corpus operators share."""

import gc
import pickle
import uuid

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from staypath.sources.tables import discard, staged

__all__ = ["discard", "documents", "merged", "packed", "read", "received", "session", "shipped", "staged", "text_of", "unpacked"]


#: setting for the bytes of a batch that goes to a Python worker, its value as Spark comes, and ours
BATCH_BYTES, USUAL, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20, 8 << 20


def session(spark: SparkSession) -> SparkSession:
    """A run on one machine may lack a shared folder; a cluster has to name one.

    Rows are long here, so batches are kept to 8 MB, unless the session has a limit of its own.
    """
    if spark.conf.get(BATCH_BYTES) in (f"{USUAL}b", str(USUAL)):
        spark.conf.set(BATCH_BYTES, str(BATCH))
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        spark.sparkContext.setCheckpointDir(f"/tmp/staypath-{uuid.uuid4().hex}")
    return spark


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return session(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of each row, and ``text_hash``.

    A row is known by id and hash: repeated rows are one document, and rows that share an id, or have
    none, but differ in text are different ones. All other columns are left out, whatever their names.
    """
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def merged(left: DataFrame, right: DataFrame, keys=("doc_id", "text_hash"), how: str = "left") -> DataFrame:
    """Join in which null keys are equal; the columns of ``right`` other than the keys are added.

    ``right`` has one row per key and is small in a partition, so it is hashed and ``left`` is not sorted.
    """
    named = right.withColumnsRenamed({k: f"_{k}" for k in keys}).hint("shuffle_hash")
    on = None
    for k in keys:
        same = left[k].eqNullSafe(named[f"_{k}"])
        on = same if on is None else on & same
    return left.join(named, on, how).drop(*[f"_{k}" for k in keys])


def _pack(batches):
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        at = batch.schema.get_field_index("text")
        column = batch.column(at)
        small = pa.array([None if t is None else squeeze(t) for t in column.cast(pa.binary()).to_pylist()], pa.binary())
        yield batch.set_column(at, pa.field("text", pa.binary()), small)


def packed(docs: DataFrame) -> DataFrame:
    """Texts squeezed to bytes, for frames that are about to be shuffled."""
    fields = [T.StructField(f.name, T.BinaryType()) if f.name == "text" else f for f in docs.schema]
    return docs.mapInArrow(_pack, T.StructType(fields))


def text_of(rows: pa.Array, at: int) -> pa.Array:
    """Inside a task: the text among the columns of whole rows."""
    column = pc.struct_field(rows, at)
    return column if pa.types.is_string(column.type) else column.cast(pa.string())


def unpacked(column: pa.Array) -> pa.Array:
    """Inside a task: the texts that ``packed`` squeezed, as bytes; null stays null."""
    expand = zstandard.ZstdDecompressor().decompress
    return pa.array([None if t is None else expand(t) for t in column.to_pylist()], pa.binary())


def shipped(spark: SparkSession, value):
    """Broadcast of an object of this package, pickled by value, so that executors need not have the package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(shared):
    """Inside a task: the object that :func:`shipped` sent."""
    return pickle.loads(shared.value)


def forget(spark: SparkSession) -> None:
    """Let the session drop shuffle files of finished steps, which go when their plans are collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
