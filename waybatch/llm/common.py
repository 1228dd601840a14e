"""Shared helpers: written intermediate tables, size-checked broadcasts, and
word hashing over Arrow text columns."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybatch.session import scratch_path, ship_package

#: Largest id list that is broadcast (8 bytes a row); beyond it the join shuffles.
BROADCAST_IDS = 500_000
#: Text bytes that one vectorised step looks at.
STEP_BYTES = 500_000
#: Bytes of an Arrow batch between the JVM and a Python worker, at most (and a
#: row): both hold a batch whole, and Spark's default of 64 MB is the whole
#: input of a task.
BATCH_BYTES = 4 << 20

_MASK = 0xFFFFFFFFFFFFFFFF
_BASE = 0x9E3779B97F4A7C15


def table(spark: SparkSession, df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder as Parquet and read back: lineage
    ends here, and a lost executor loses nothing that was written."""
    path = scratch_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_IDS) -> DataFrame:
    """Broadcast hint if a count shows at most ``rows`` rows, else ``df``."""
    return F.broadcast(df) if df.count() <= rows else df


def prepared(spark: SparkSession) -> None:
    """Ships the package, and bounds the session's Arrow batches by
    ``BATCH_BYTES`` unless the session has a bound of its own."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if key not in spark.conf.getAll:
        spark.conf.set(key, str(BATCH_BYTES))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and ``n + 1`` offsets of a text column; null counts as empty."""
    a = pc.cast(pc.fill_null(column, ""), pa.large_binary())
    if isinstance(a, pa.ChunkedArray):
        a = a.combine_chunks()
    offsets = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]
    if a.buffers()[2] is None or len(offsets) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(a) + 1, np.int64)
    data = np.frombuffer(a.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def release() -> None:
    """Gives memory that a task has freed back to the system: workers live on
    from task to task, and an executor's workers share its memory."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def steps(batches: Iterator[pa.RecordBatch], text: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices with about ``limit`` text bytes (a longer text is one slice)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes.astype(np.int64)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield batch.slice(a, b - a)
    release()


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the hash base and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(n + 1, STEP_BYTES + 1)
        with np.errstate(over="ignore"):
            _POWERS[:] = [
                np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, b, np.uint64))])
                for b in (_BASE, pow(_BASE, -1, 1 << 64))
            ]
    return _POWERS[0], _POWERS[1]


#: Byte classes: white space (space and 0x09-0x0D), and all ASCII but letters and digits.
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte spans ``[start, end)`` of all words, and the number of words
    before each text (``n + 1`` numbers)."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    gap = separator[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = True, gap[:-1]
    starts = np.flatnonzero(~gap & (before | edge[:-1]))
    before[:-1], before[-1] = gap[1:], True
    ends = np.flatnonzero(~gap & (before | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes with A-Z lower-cased: a polynomial
    in a fixed odd base, from prefix sums over stretches of bounded size."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            low = starts[at]
            to = max(at + 1, int(np.searchsorted(ends, low + STEP_BYTES, "right")))
            piece = data[low:ends[to - 1]]
            power, inverse = _powers(len(piece))
            sums = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum((FOLD[piece].astype(np.uint64) + np.uint64(1)) * power[:len(piece)], out=sums[1:])
            s, e = starts[at:to] - low, ends[at:to] - low
            out[at:to] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
            at = to
    return out


def ragged(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of the given lengths: each element's group and its place in it."""
    group = np.repeat(np.arange(len(lengths)), lengths)
    first = np.cumsum(lengths) - lengths
    return group, np.arange(len(group)) - first[group]


def gather(flat: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces ``which`` of a ragged array, joined, and their lengths."""
    lengths = offsets[which + 1] - offsets[which]
    group, place = ragged(lengths)
    return flat[offsets[which][group] + place], lengths


def binaries(parts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary column from joined fixed-width elements and element counts."""
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64) * parts.dtype.itemsize
    buffer = pa.py_buffer(np.ascontiguousarray(parts).tobytes())
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends.tobytes()), buffer]).cast(pa.binary())
