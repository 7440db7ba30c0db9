"""Counting 64-bit keys over a corpus: summed in each task, sent as packed blocks, merged by key range.

A block is one row with the sorted keys of a range that a task has met. A task sends a key once, so a key
that every document holds costs one entry for each task and no reducer sees more of it.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

BLOCK = pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
BLOCK_DDL = "part int, keys binary, counts binary"
#: so many entries are held by a task before it sends what it has
HELD = 3_000_000


def parts(spark: SparkSession, factor: int = 4) -> int:
    """Number of key ranges: it follows the session's shuffle partitions, which follow the input."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))) * factor


def range_starts(sorted_keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each of ``ranges`` equal slices of the key space starts in ``sorted_keys``."""
    edges = np.array([(i << 64) // ranges for i in range(ranges)], dtype=np.uint64)
    return np.append(np.searchsorted(sorted_keys, edges), len(sorted_keys))


def blocks(keys: np.ndarray, counts: np.ndarray, ranges: int) -> pa.RecordBatch:
    at = range_starts(keys, ranges)
    used = np.flatnonzero(np.diff(at))
    return pa.RecordBatch.from_arrays([
        pa.array(used.astype(np.int32)),
        pa.array([keys[at[i]:at[i + 1]].tobytes() for i in used], pa.binary()),
        pa.array([counts[at[i]:at[i + 1]].astype("<u4" if counts.max() < 1 << 32 else "<u8").tobytes() for i in used], pa.binary()),
    ], schema=BLOCK)


def unblocked(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    k = np.frombuffer(keys, np.uint64)
    wide = len(counts) == 8 * len(k)
    return k, np.frombuffer(counts, "<u8" if wide else "<u4").astype(np.int64)


def merge_counts(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a range and their sums over all blocks, in key order."""
    pairs = [unblocked(k, c) for k, c in zip(table.column("keys").to_pylist(), table.column("counts").to_pylist())]
    keys, counts = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


def counted(source: DataFrame, task, reduce, ddl: str, ranges: int | None = None) -> DataFrame:
    """``task`` maps batches to blocks, ``reduce`` a table of a range's blocks to rows of ``ddl``."""
    return source.mapInArrow(task, BLOCK_DDL).groupBy("part").applyInArrow(reduce, ddl)
