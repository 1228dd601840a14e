"""Document fingerprints by winnowing: hashes of all k-grams of code points,
of which each window keeps its least (the rightmost of equal ones), with
positions. Texts that share a stretch of ``GRAM + WINDOW - 1`` code points
share a fingerprint element."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybatch.llm.common import mix, prepared, steps, table

#: Code points of a gram (a power of two), grams of a window.
GRAM, WINDOW = 16, 48
#: Low bits of a gram's key hold its position, so that of equal hashes the last is least.
POSITION_BITS = 24
#: Text bytes of a range, on average, where the session has fewer partitions.
RANGE_BYTES = 64_000_000


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each window, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        keys = np.minimum(keys[:len(keys) - step], keys[step:])
        done += step
    return keys


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (40 bits) and positions of the grams kept, by position. Of fewer
    grams than a window has, the least is kept; a text shorter than a gram is
    one gram; an empty one has none."""
    points = _code_points(text)
    if len(points) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = points.astype(np.uint64)
    with np.errstate(over="ignore"):
        if len(h) < gram:
            h = mix(np.array([np.bitwise_xor.reduce(mix(h * np.uint64(0x9E3779B97F4A7C15) + np.arange(len(h), dtype=np.uint64)))], np.uint64))
        else:
            width, base = 1, np.uint64(0x9E3779B97F4A7C15)
            while width < gram:  # a gram's hash from those of its halves
                h = mix(h[:len(h) - width] * base + h[width:])
                width *= 2
        h = h >> np.uint64(POSITION_BITS)
        hashes, places = [], []
        limit = 1 << POSITION_BITS
        for low in range(0, len(h), limit - window):  # stretches that overlap by a window less one
            part = h[low:low + limit - 1]
            if low and len(part) < window:
                break
            keys = (part << np.uint64(POSITION_BITS)) | (np.uint64(limit - 1) - np.arange(len(part), dtype=np.uint64))
            kept = _least(keys, min(window, len(keys)))
            kept = kept[np.concatenate([[True], kept[1:] != kept[:-1]])]
            hashes.append(kept >> np.uint64(POSITION_BITS))
            places.append((limit - 1 - (kept & np.uint64(limit - 1)).astype(np.int64)) + low)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return np.concatenate(hashes)[first], place


def fingerprint(hashes: np.ndarray, places: np.ndarray) -> str:
    """``hash:position`` pairs in base 16, hashes of 10 digits, by position."""
    return " ".join([f"{h:010x}:{p:x}" for h, p in zip(hashes.tolist(), places.tolist(), strict=True)])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of the sets of hashes; 1 for two empty ones."""
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    either = len(a) + len(b) - both
    return both / either if either else 1.0


def edited(text: str, other: str) -> str:
    """The last third of the code points replaced by as many of ``other``'s first (or all)."""
    cut = len(text) // 3
    return text[:len(text) - cut] + other[:cut]


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_FIELDS = [c.split()[0] for c in _OUT.split(", ")]
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _row(doc_id, text, own, other, next_own) -> tuple:
    changed = edited(text, other)
    theirs = winnow(changed)
    return (doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), fingerprint(*own), fingerprint(*theirs),
            likeness(own[0], theirs[0]), likeness(own[0], next_own[0]))


def _record(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(_KINDS)], _FIELDS)


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range, descending, each with its successor; the last one's
    is the copy of the next range's first row, which comes behind."""
    held, ended = None, False
    rows: list[tuple] = []
    size = 0
    for b in steps(batches, "text"):
        for doc_id, text, copy in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "copy")), strict=True):
            if ended:
                break
            text, ended = text or "", copy
            own = winnow(text)
            if held is not None:
                rows.append(_row(*held, text, own))
                size += len(text)
            held = (doc_id, text, own)
        if size > 4_000_000 or len(rows) >= 2000:
            yield _record(rows)
            rows, size = [], 0
    if rows:
        yield _record(rows)


def _placed(firsts: list[tuple]):
    """For the first row of each range, descending: twice a row's range, plus
    1 if the row is its range's first. Null ids are below all others."""
    upward = firsts[::-1]
    nulls = sum(i is None for i, _ in upward)
    ids = np.array([i for i, _ in upward if i is not None], np.int64)
    ties = np.array([t for _, t in upward], np.int64)

    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for null_id, doc_id, tie in batches:
            missing, own, t = null_id.to_numpy(bool), doc_id.to_numpy(np.int64), tie.to_numpy(np.int64)
            low = np.where(missing, 0, nulls + np.searchsorted(ids, own, "left"))
            high = np.where(missing, nulls, nulls + np.searchsorted(ids, own, "right"))
            below = low.copy()
            for a, z in set(zip(low[low < high].tolist(), high[low < high].tolist(), strict=True)):
                here = (low == a) & (high == z)
                below[here] = a + np.searchsorted(ties[a:z], t[here], "left")
            first = (below < high) & (ties[np.minimum(below, len(ties) - 1)] == t)
            yield pd.Series((len(upward) - 1 - below) * 2 + first)
    return run


def fingerprints(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next)`` for each row of ``docs``.

    The next document is that with the next lower id, of the last one the
    first. Of rows with one id the order is that of their texts' hashes, so
    repeated rows give repeated results. Null ids come last. Null texts count
    as empty; whole texts of any length are used. An empty table gives no
    rows. Other columns are ignored.

    Ids and hashes alone are cut into ranges first; of each range one row, its
    first, reaches the driver. Then texts are shuffled once, each to its range,
    and each range's first also to the end of the range before.
    """
    prepared(spark)
    slim = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .withColumn("tie", F.xxhash64("text")))
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie").desc()]
    keys = table(spark, slim.select("doc_id", "tie", F.octet_length("text").alias("size")), "winnow-keys")
    bytes_ = keys.agg(F.sum(F.col("size").cast("long"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), bytes_ // RANGE_BYTES + 1)
    firsts = [(r["k"]["doc_id"], r["k"]["tie"]) for r in
              keys.select("doc_id", "tie").repartitionByRange(ranges, *order).groupBy(F.spark_partition_id().alias("part"))
              .agg(F.max(F.struct("doc_id", "tie")).alias("k")).orderBy("part").collect()]
    if not firsts:
        return spark.createDataFrame([], _OUT)
    n = len(firsts)
    code = F.pandas_udf(_placed(firsts), "long")(F.isnull("doc_id"), F.coalesce("doc_id", F.lit(0)), "tie")
    part, first = F.shiftright("code", 1), F.col("code") % 2 == 1
    own = F.struct(part.cast("int").alias("part"), F.lit(False).alias("copy"))
    before = F.struct(((part + F.lit(n - 1)) % n).cast("int").alias("part"), F.lit(True).alias("copy"))
    dealt = (slim.withColumn("code", code).withColumn("to", F.explode(F.when(first, F.array(own, before)).otherwise(F.array(own))))
             .select("doc_id", "text", "tie", "to.part", "to.copy")
             .repartitionById(n, F.col("part")).sortWithinPartitions("copy", *order))
    return dealt.select("doc_id", "text", "copy").mapInArrow(_chained, _OUT)
