"""Helpers shared by the operators of this subpackage.

The numpy functions work on whole Arrow batches: the texts of a batch lie in
one byte buffer, so words, n-grams and their hashes are array operations
instead of Python loops.  All hashes are 64-bit polynomials over the bytes,
computed from prefix sums, followed by a bit mixer.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import ensure_checkpoint_dir

U64 = np.uint64
#: Base of the polynomial hashes (odd, so it has an inverse modulo 2**64).
BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


# ---------------------------------------------------------------- Spark side

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files nobody refers to any more.

    The cleaner acts when the driver collects its garbage; between two large
    steps of one job that is worth asking for, as the files of the finished
    step would otherwise stay on the executors' disks.  The first round frees
    the plans, the next ones the shuffles that only those plans held.
    """
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(1)


def ascii_lower(col):
    """Lower-case A-Z only (``lower`` would also change other scripts)."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_crc(col, modulus: int):
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as '')."""
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def join_side(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """A join's narrow side (ids and hashes): broadcast if it is counted to have
    ``rows`` or fewer, else left to a shuffle join.  The count reads a checkpoint."""
    df = checkpointed(df)
    return F.broadcast(df) if df.count() <= rows else df


# ---------------------------------------------------------------- Arrow side

def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def blocks(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of consecutive rows holding at most ``limit`` bytes (or one row)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


_HELD: list[dict] = []


def held() -> dict:
    """A cache that a worker process keeps from task to task, until a task of another operator starts in it."""
    _HELD.append({})
    return _HELD[-1]


def trim() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):      # glibc only
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def trimmed(batches, cache: dict | None = None):
    """The batches; before them other operators' caches go, afterwards freed memory.

    A worker process waits for further tasks and would hold its peak meanwhile,
    beside the memory of the executor that another operator needs.
    """
    for other in _HELD:
        if other is not cache:
            other.clear()
    yield from batches
    trim()


# ---------------------------------------------------------------- hashing

def mix(x: np.ndarray) -> np.ndarray:
    """Bit mixer of 64-bit integers (a bijection)."""
    x = x ^ (x >> U64(31))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(29))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(32))


BYTE_CODE = mix(np.arange(1, 257, dtype=U64) * U64(BASE))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n, modulo 2**64."""
    if len(_POWERS["up"]) < n:
        size = max(n, 1 << 16)
        inverse = pow(BASE, -1, 1 << 64)
        for name, step in (("up", BASE), ("down", inverse)):
            steps = np.full(size, U64(step), U64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=U64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    """H with H[j] - H[i] = sum of code(raw[t]) * BASE**t for i <= t < j."""
    up, _ = powers(len(raw) + 1)
    code = BYTE_CODE.take(raw)
    code *= up[:len(raw)]
    out = np.zeros(len(raw) + 1, U64)
    np.cumsum(code, dtype=U64, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes [start, end); equal bytes hash alike wherever they are."""
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])


def word_spans(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of texts laid end to end: (start, end, row).

    A word never runs over the end of its text.  ``inside`` says of each byte whether
    it belongs to a word, where words are other than these.
    """
    if inside is None:
        inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    n = len(raw)
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | first[:n]))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | first[1:])) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return start, end, row


def lower_bytes(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z, byte by byte."""
    return raw + ((raw - np.uint8(65) < 26).view(np.uint8) << 5)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
