"""Helpers that the training-data operators share.

Tables are read with :func:`table`; intermediate results that several jobs read go to
:func:`stored`, a Parquet folder below ``spark.checkpoint.dir`` that every executor can reach, so
a lost executor costs a re-read and not a recomputation.
"""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: At most so many rows of a few dozen bytes are broadcast; beyond it a join shuffles.
BROADCAST_ROWS = 500_000
#: Rows that go to a Python worker at a time.
ROWS_OF_BATCH = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors reach.

    Where it is unset, a session without executors (``local[n]``) gets a folder of its own; on a
    cluster no folder is known to be shared, so there it must be set.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    context = spark.sparkContext
    kept = context._jsc.sc().getCheckpointDir()
    if kept.isDefined():
        return kept.get().rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="pagemill-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


@contextmanager
def small_batches(spark: SparkSession, rows: int = ROWS_OF_BATCH) -> Iterator[None]:
    """What runs inside passes texts to Python in batches of so many rows, which bounds both sides' buffers."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: cuts the lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/pagemill/{name}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def bucketed(df: DataFrame, key: str, name: str) -> tuple[DataFrame, str]:
    """Written once to the shared folder as a table bucketed by ``key`` and read back; its name.

    A task writes at most a file for each row that it has, and rows are blocks of some megabytes.
    :func:`unbucketed` removes it.
    """
    spark = df.sparkSession
    name = f"pagemill_{name}_{uuid.uuid4().hex}"
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8)
    path = f"{shared_dir(spark)}/pagemill/{name}"
    with small_batches(spark):
        df.write.option("compression", "zstd").option("path", path).bucketBy(n, key).saveAsTable(name)
    out = spark.table(name)
    out.stored_at = path
    return out, name


def unbucketed(df: DataFrame, name: str) -> None:
    """Drop a table that :func:`bucketed` has written, and its files."""
    df.sparkSession.sql(f"DROP TABLE {name}")
    discard(df)


def gathered(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until the column's bytes reach the limit."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= limit:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def discard(*tables: DataFrame) -> None:
    """Delete what :func:`stored` has written; nothing that is still to be read may depend on it."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def trim() -> None:
    """Give memory that is free again back to the system.

    Python workers are used again by later tasks and stages; without this each keeps what its
    largest task needed, and an executor's memory only ever rises.
    """
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def crc_mod(column, modulus: int):
    """crc32 of the column's decimal text, modulo; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets into them; null counts as empty.

    Without nulls a column's own bytes are returned, not a copy.
    """
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(lengths: np.ndarray, limit: int):
    """Slices of consecutive rows whose lengths add up to at most ``limit`` (or one longer row)."""
    start, held = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(lengths):
        yield start, len(lengths)


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: well spread hashes of 64-bit keys."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def anti_or_semi(rows: DataFrame, keys: DataFrame, on: list[str], how: str) -> DataFrame:
    """``rows`` joined (left_semi or left_anti) null-safely with ``keys``.

    ``keys`` are broadcast only if they were counted to be few; otherwise both sides shuffle.
    """
    few = keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    renamed = keys.select(*[F.col(k).alias(f"__key_{k}") for k in on])
    condition = [rows[k].eqNullSafe(renamed[f"__key_{k}"]) for k in on]
    return rows.join(F.broadcast(renamed) if few else renamed, condition, how)
