"""What several operators share: words, scratch tables, batches, shared keys, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the contracts: the white space that ends a word, and a word.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = "[^\\x20\\x09-\\x0D]+"

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
U64 = np.uint64
#: Odd multipliers of the hash functions (the usual 64-bit mixing constants).
MIX_A, MIX_B = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
BASE = U64(0x9E3779B97F4A7C15)


def scratch(spark: SparkSession) -> str:
    """A new folder name below the folder that the cluster shares.

    That folder is ``spark.checkpoint.dir``. Only a session that has none gets a
    temporary one, which does for a local test.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shelfmark-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/shelfmark-{uuid.uuid4().hex}"


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Within, what an action shuffles goes when the action is done: every later one starts from tables."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def stored(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder and read again: cuts lineage, survives executors."""
    spark, path = df.sparkSession, scratch(df.sparkSession)
    with tidy(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete stored tables that nothing reads any more: whatever was made of them is stored itself."""
    for df in tables:
        if path := getattr(df, "stored_at", None):
            spark = df.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def held_out(doc_id: Column) -> Column:
    """True for the rows that no model may learn from; null ids hash as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h ^ (h >> U64(30))
    h = h * MIX_A
    h = h ^ (h >> U64(27))
    h = h * MIX_B
    return h ^ (h >> U64(31))


def slices(batch: pa.RecordBatch, column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts hold about `limit` bytes each, one row at least."""
    sizes = np.asarray(batch.column(column).cast(pa.large_string()).fill_null("").to_numpy(zero_copy_only=False), object)
    lengths = np.fromiter(map(len, sizes), np.int64, len(sizes))
    parts = np.cumsum(lengths) // limit
    edges = np.concatenate(([0], np.flatnonzero(np.diff(parts)) + 1, [len(parts)])) if len(parts) else [0]
    for lo, hi in zip(edges[:-1], edges[1:]):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def joined_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one array of bytes, and n + 1 offsets. Null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    data = column.buffers()[2]
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = int(offsets[0]) if len(offsets) else 0
    return raw[first : int(offsets[-1])], offsets - first
