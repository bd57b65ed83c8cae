"""Shared pieces: written intermediate tables, vectorised word hashing, Arrow list building."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_GAMMA = 0x9E3779B97F4A7C15
_RADIX = 0xD1342543DE82EF95
#: Bytes of text that one vectorised step handles; a longer document is a step of its own.
STEP_BYTES = 2 << 20


# --- written tables -----------------------------------------------------------------------


def shared_dir(spark: SparkSession) -> str:
    """The folder that all machines share: ``spark.checkpoint.dir``, or a new one in local tests."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        where = "file://" + tempfile.mkdtemp(prefix="spark-agroplan-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Spark's setting under which a query's shuffle files go once the query is done.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage and survives lost executors.

    The table stands for what made it, so the shuffle files behind it are removed at once.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`written` that nothing will read any more."""
    from .files import delete_folder

    for table in tables:
        delete_folder(table.written_at)


#: Rows of a few numbers each that a join may broadcast; a larger side is shuffled instead.
SMALL_ROWS = 1_000_000


def small_side(df: DataFrame) -> DataFrame:
    """``df`` (a written table of few narrow columns), to be broadcast if its counted rows are few."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- Arrow ----------------------------------------------------------------------------------


def list_array(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.BinaryArray:
    """Slices of a flat uint8 array as binary values."""
    flat = np.ascontiguousarray(data)
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(flat)])


def release() -> None:
    """Give freed memory back to the system: an idle worker stays alive beside the next tasks' workers."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def steps(batches, text: str = "text", limit: int = STEP_BYTES):
    """Cut Arrow batches so that each piece holds about ``limit`` bytes of text (one row at least)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            before = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, before + limit, side="right")))
            yield batch.slice(at, end - at)
            at = end
    release()


# --- words ----------------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_GAMMA))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n + 1:
        size = max(n + 1, STEP_BYTES + 2)
        for name, base in (("up", _RADIX), ("down", pow(_RADIX, -1, 1 << 64))):
            steps_ = np.full(size, base, dtype=np.uint64)
            steps_[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps_)
    return _POWERS["up"], _POWERS["down"]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash over bytes; see :func:`span_hash`."""
    up, _ = _powers(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end); equal bytes give equal hashes anywhere."""
    _, down = _powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(_GAMMA))


def space_words() -> np.ndarray:
    """Word bytes for ``[^\\x20\\x09-\\x0D]+``."""
    is_word = np.ones(256, dtype=bool)
    is_word[[0x20, *range(0x09, 0x0E)]] = False
    return is_word


def alnum_words() -> np.ndarray:
    """Word bytes for ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``: digits, a-z and all beyond ASCII."""
    is_word = np.zeros(256, dtype=bool)
    is_word[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
    return is_word


def word_hashes(texts: list[bytes], is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text, A-Z lower-cased; text i has words [bounds[i], bounds[i+1])."""
    data = np.frombuffer(b"\n".join(texts).lower() + b"\n", dtype=np.uint8)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[1:] = is_word[data]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    bounds = np.concatenate([[0], np.searchsorted(start, np.cumsum(lengths))])
    return span_hash(prefix_hash(data), start, end), bounds


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of ``n`` consecutive words."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.full(count, n, dtype=np.uint64) * np.uint64(_GAMMA)
    for i in range(n):
        total += words[i : i + count] * np.uint64(pow(_RADIX, i + 1, 1 << 64))
    return mix(total)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
