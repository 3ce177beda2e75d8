"""What the text operators share: staged tables, flat Arrow text, word hashes."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64
CHUNK_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a local one where it is unset (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="keelstone-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """df, written once as Parquet to the shared folder and read again: later jobs don't recompute it."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def drop(*tables: DataFrame) -> None:
    """Deletes the files of staged tables that nothing reads any more. Tables that a returned DataFrame reads stay; who set the folder owns them."""
    for df in tables:
        if path := getattr(df, "staged_at", None):
            jvm = df.sparkSession._jvm
            own = jvm.org.apache.hadoop.fs.Path(path)
            own.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(own, True)


def give_back() -> None:
    """Memory no longer used goes back to the system."""
    _powers.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def released(run):
    """run for mapInArrow, and then give_back: Python workers live on from task to task."""

    def own(batches):
        yield from run(batches)
        give_back()

    return own


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary column, its n + 1 offsets, and which rows aren't null (null: no bytes)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n, ok = len(column), np.ones(len(column), bool)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), ok
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    if column.null_count:
        ok = np.asarray(column.is_valid())
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    at = at - at[0]
    if not ok.all() and (at[1:] - at[:-1])[~ok].any():
        column = column.fill_null("" if "string" in str(column.type) else b"")
        return (*flat(column)[:2], ok)
    return raw, at, ok


def pieces(batch: pa.RecordBatch, column: str, most: int = CHUNK_BYTES):
    """Slices of batch whose column holds about most bytes; a longer row is a slice of its own."""
    at = flat(batch.column(column))[1]
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(at, at[a] + most, "right")) - 1)
        yield batch.slice(a, b - a)
        a = b


def _lookup() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    white = np.zeros(256, bool)
    white[[32, *range(9, 14)]] = True
    table = np.random.default_rng(20_240_229).integers(1, 2**63, 256, dtype=np.uint64) | U64(1)
    return lower, white, table[lower]


LOWER, WHITE, BYTE_KEYS = _lookup()
BASE, BASE_INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0, 1 ... modulo 2 ** 64, at least n of them."""
    if base not in _powers or len(_powers[base]) < n:
        out = np.full(max(2 * n, 1 << 16), base, U64)
        out[0] = 1
        np.multiply.accumulate(out, out=out)
        _powers[base] = out
    return _powers[base]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def word_spans(data: np.ndarray, at: np.ndarray, white: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+ of every row, and at each row the number of words before it. white: other bytes between words."""
    dark = ~white[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = ~dark[:-1]
    edge[at] = True
    starts = np.flatnonzero(dark & edge[:-1])
    edge[1:-1] = ~dark[1:]
    edge[at] = True
    ends = np.flatnonzero(dark & edge[1:]) + 1
    return starts, ends, np.searchsorted(starts, at)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words, A-Z as a-z. Equal words have equal hashes in every process."""
    if not len(starts):
        return np.zeros(0, U64)
    total = np.zeros(len(data) + 1, U64)
    np.cumsum(BYTE_KEYS[data] * powers(BASE, len(data))[: len(data)], out=total[1:])
    own = (total[ends] - total[starts]) * powers(BASE_INVERSE, len(data))[starts]
    return mixed(own + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indexes start, start + 1 ... of every run, one run after the other."""
    if not len(sizes):
        return np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    return np.arange(ends[-1]) + np.repeat(starts - ends + sizes, sizes)


def distinct(x: np.ndarray) -> np.ndarray:
    """The sorted distinct values."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def packed(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())
