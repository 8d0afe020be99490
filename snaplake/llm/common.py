"""What the operators share: tables, stored intermediates, and text as arrays of bytes, words and hashes.

Texts reach Python as Arrow batches. They are cut into blocks of a megabyte, so that the arrays made of a block stay
small however many rows a batch has; one text is never cut.
"""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.workspace import shared_dir

BLOCK_BYTES = 1 << 20
#: Key, Spark's default, ours.
BATCH_SETTINGS = (
    ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"),
    ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m"),
)
#: Are shuffle files removed as soon as a query is over?
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows up to which a table of ids, or of ids and a few numbers, is sent to every executor: some tens of megabytes.
BROADCAST_ROWS = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written to the cluster's shared folder and read back: what follows doesn't compute it again, and
    losing an executor loses none of it. Nor does it need the shuffle files again, which else stay until the driver
    happens to collect its garbage."""
    spark = frame.sparkSession
    bound_batches(spark)
    folder, before = shared_dir(spark, "llm", name), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        frame.write.parquet(folder)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(frame.schema).parquet(folder)


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of fewer rows and bytes than Spark's defaults, which a user's own settings override: the JVM and
    the workers hold a batch each, and ten thousand texts would take more of an executor than its tasks' arrays."""
    for key, default, value in BATCH_SETTINGS:
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, value)


def new_name() -> str:
    """A column name that no table has."""
    return f"own_{uuid.uuid4().hex}"


def small_enough(ids: DataFrame, *lists: str) -> DataFrame:
    """A stored table of ids, to be broadcast if it is counted to be small; else the join shuffles. What ``lists`` hold
    counts too, four entries as much as a row."""
    entries = sum((F.coalesce(F.size(c), F.lit(0)) for c in lists), F.lit(0))
    rows, held = ids.agg(F.count("*"), F.coalesce(F.sum(entries), F.lit(0))).first()
    return F.broadcast(ids) if rows + held // 4 <= BROADCAST_ROWS else ids


def few(ids: DataFrame, parts: int) -> bool:
    """Is a table of about ``parts`` times as many rows as ``ids`` small enough to be broadcast?"""
    return ids.count() * parts <= BROADCAST_ROWS


def offsets_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each text begins and the last one ends. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), bounds


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, bounds) of runs of whole texts; a run has ``limit`` bytes or one text."""
    data, bounds = offsets_of(column)
    row, rows = 0, len(bounds) - 1
    while row < rows:
        last = max(row + 1, int(np.searchsorted(bounds, bounds[row] + limit, "right")) - 1)
        yield row, data[bounds[row] : bounds[last]], bounds[row : last + 1] - bounds[row]
        row = last
    give_back()


def give_back() -> None:
    """Hands freed memory back to the system. Workers live on between tasks and several share an executor's memory, so
    what one has used at its peak must not stay with it."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


@functools.cache
def _trim() -> Callable[[int], int] | None:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # another C library
        return None


def mix(h: np.ndarray) -> np.ndarray:
    """The finalizer of the public splitmix64 generator."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def stream(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + _U(seed << 32)) * _U(0x9E3779B97F4A7C15))


_FACTORS = stream(1 << 12, 1)


def _factors(n: int) -> np.ndarray:
    global _FACTORS
    if n > len(_FACTORS):
        _FACTORS = stream(1 << int(n).bit_length(), 1)
    return _FACTORS


def hash_pieces(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each piece; the pieces lie end to end in ``data`` and none is empty.

    Bytes times a random number per place, added up modulo 2^64 and mixed with the length.
    """
    if not len(lengths):
        return np.zeros(0, np.uint64)
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(len(data)) - np.repeat(firsts, lengths)
    terms = (data.astype(np.uint64) + _U(1)) * _factors(int(lengths.max()))[place]
    return mix(np.add.reduceat(terms, firsts) + lengths.astype(np.uint64) * _U(0xD1B54A32D192ED03))


def words(data: np.ndarray, bounds: np.ndarray, lower: bool = True, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, first bytes, end bytes, first word of each text and the total) of the words of a block.

    A word is a run of bytes other than 0x20 and 0x09 to 0x0D, or those of ``space``; ``lower`` puts A-Z in lower case.
    """
    folded = _LOWER[data] if lower else data
    solid = ~space[data]
    cut = np.ones(len(data) + 1, bool)
    cut[1:-1] = ~solid[1:] | ~solid[:-1]
    cut[bounds] = True
    starts = np.flatnonzero(solid & cut[:-1])
    ends = np.flatnonzero(solid & cut[1:]) + 1
    return hash_pieces(folded[solid], ends - starts), starts, ends, np.searchsorted(starts, bounds)


def shingles(hashes: np.ndarray, width: int = 5, seed: int = 2) -> np.ndarray:
    """A hash of each run of ``width`` words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factors, total = stream(width, seed), np.zeros(n, np.uint64)
    for k in range(width):
        total += hashes[k : k + n] * (factors[k] | _U(1))
    return mix(total)


def shingle_set(hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """The sorted distinct shingles of one text; fewer than ``width`` words make one shingle, none make none."""
    if 0 < len(hashes) < width:
        return shingles(hashes, len(hashes), seed=3 + len(hashes))
    return np.unique(shingles(hashes, width))


def int64(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64) if a.dtype == np.uint64 else a.astype(np.int64))


def lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """A list column of ``counts`` values each."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)
