"""Texts as byte arrays: words, word hashes and piecewise work on Arrow columns.

A word is a run of bytes other than space and 0x09-0x0D, which is what ``bytes.split`` yields and,
in UTF-8, equals the same rule on code points. All hashes are 64 bits wide and independent of the
process, so that they agree between executors.
"""

import ctypes
import os
import sys
import types
import uuid
from collections.abc import Callable, Hashable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        grown = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            grown.append(np.multiply.accumulate(steps))
        _powers = (grown[0], grown[1])
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64 bits so that every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with H[e] - H[s] the hash of data[s:e] times the base to the power s."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * up, out=out[1:])
    return out


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows end to end, and the row bounds; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def pieces(bounds: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes, which bounds the memory of array work."""
    start, n = 0, len(bounds) - 1
    while start < n:
        stop = max(start + 1, int(np.searchsorted(bounds, bounds[start] + limit, "right")) - 1)
        yield start, stop
        start = stop


class Words:
    """Word starts, ends, rows and hashes of the texts data[bounds[i]:bounds[i+1]]."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lower: bool = True):
        self.data = _LOWER[data] if lower else data
        self.bounds = bounds
        n = len(data)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = ~_SPACE[data]
        cut = np.zeros(n + 1, bool)
        cut[bounds] = True
        self.starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
        self.ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
        #: the words of row i are first[i]:first[i+1]
        self.first = np.searchsorted(self.starts, bounds)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        whole = prefix_hash(self.data)
        _, down = powers(len(self.data) + 1)
        return mix((whole[self.ends] - whole[self.starts]) * down[self.starts])


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` neighbours."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out += hashes[j : j + n] * np.uint64((_BASE * (2 * j + 1) + 2 * j | 1) % 2**64)
    return mix(out)


def text_batches(spark: SparkSession) -> None:
    """Arrow batches of fewer rows than Spark's default, as whole texts make wide rows; a setting of
    the user's own is left alone."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "2000")


def release() -> None:
    """Give freed memory back: workers serve many groups, and a group's peak would stay with them."""
    pa.default_memory_pool().release_unused()
    if hasattr(trim := ctypes.CDLL(None), "malloc_trim"):
        trim.malloc_trim(0)


def worker_state(key: Hashable, make: Callable[[], object], keep: int = 4) -> object:
    """What ``make`` gives, made once per worker process, at most ``keep`` things at a time.

    Functions travel with the job by value, so a module's own variables end with the task; these do not.
    """
    held = sys.modules.setdefault("zonalis_worker_state", types.ModuleType("zonalis_worker_state")).__dict__
    found = held.setdefault("found", {})
    if key not in found:
        while len(found) >= keep:
            found.pop(next(iter(found)))
        found[key] = make()
    return found[key]


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All start, start+1, ... of each range, end to end."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(before - starts, counts)


def mounted(path: str) -> str:
    """The shared folder as executors open it: memory mapping needs a mounted file system."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return path
    if scheme != "file":
        raise ValueError(f"{path}: memory-mapped models need a shared folder that is mounted on all machines")
    return "/" + rest.lstrip("/")


def write_array(path: str, values: np.ndarray) -> None:
    """Write whole or not at all, so that a task that runs twice leaves one good file."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    draft = f"{path}.{uuid.uuid4().hex}"
    with open(draft, "wb") as out:
        out.write(np.ascontiguousarray(values).data)
    os.replace(draft, path)


def map_array(path: str, dtype: str) -> np.ndarray:
    if not os.path.exists(path) or not os.path.getsize(path):
        return np.empty(0, dtype)
    return np.memmap(path, dtype, mode="r")


def hashed_rank(key: str) -> Column:
    """A fixed pseudo-random order of rows; ties go by the key itself."""
    return F.xxhash64(F.lit(17), F.col(key))


def sum_vectors(df: DataFrame, key: str, vector: str, dtype: str, fan_in: int = 16) -> DataFrame:
    """Sum of the packed vectors of each key, in two levels so that no task reads all of them.

    The vectors must be of one length, fixed by the caller; a key's result is as long.
    """
    kind = df.schema[key].dataType.simpleString()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, name = None, None
        for batch in batches:
            name = batch.column("key")[:1] if len(batch) else name
            for packed in batch.column("vector"):
                part = np.frombuffer(packed.as_py(), dtype)
                total = part.copy() if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([name, pa.array([total.tobytes()], pa.binary())], ["key", "vector"])

    shape = f"key {kind}, vector binary"
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("vector"))
    salted = rows.withColumn("salt", F.spark_partition_id() % fan_in)
    some = salted.groupBy("key", "salt").applyInArrow(add, shape)
    return some.groupBy("key").applyInArrow(add, shape).toDF(key, vector)
