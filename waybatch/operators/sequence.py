"""Distributed dense sequence 1..n, head and page, without moving all rows
into one task.

Two forms:

* ``with_sequence`` orders by explicit columns with a unique key. Rows are
  range-partitioned by the key and sorted in their range; rows are counted
  per range (a handful of numbers reach the driver), and the counts are
  prefix-summed.
* ``with_file_order_sequence`` numbers rows in the order they sit in their
  files (file name, then position). Each file split is read by one task in
  file order, so the row id given at scan time is consecutive inside a
  split; only the per-split counts are prefix-summed.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybatch.session import broadcast_if_small, ship_package

FILE_COL = "_wb_file"
BLOCK_COL = "_wb_block"
ROW_COL = "_wb_row"


def _order_columns(order_by) -> list[str]:
    cols = [order_by] if isinstance(order_by, str) else list(order_by)
    if not cols:
        raise ValueError("order_by needs at least one column")
    return cols


def _default_buckets(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _not_unique(cols: list[str], detail: str) -> ValueError:
    return ValueError(f"order_by {cols} is not unique: {detail}; add columns or use file order")


def _all_different(df: DataFrame, col: str, lo: int, n: int) -> bool:
    """Whether the ``n`` integers of ``col``, all within ``lo .. lo + n - 1``, are
    different: one bit for each, put together map-side in bitmaps of 32,768."""
    at = F.col(col).cast("long") - F.lit(lo) + F.lit(1)
    bits = df.select(F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit"))
    maps = bits.groupBy("bucket").agg(F.bitmap_count(F.bitmap_construct_agg("bit")).alias("set"))
    return (maps.agg(F.sum("set")).first()[0] or 0) == n


def _neighbours(cols: list[str]):
    """For each partition of sorted rows: its number, its rows, and whether two
    neighbours have one key (null equals null, NaN equals NaN)."""
    def same(x: pa.Array, y: pa.Array) -> np.ndarray:
        if pa.types.is_nested(x.type):
            return np.array([a == b for a, b in zip(x.to_pylist(), y.to_pylist(), strict=True)], bool)
        equal = pc.fill_null(pc.equal(x, y), False)
        equal = pc.or_(equal, pc.and_(pc.is_null(x, nan_is_null=pa.types.is_floating(x.type)), pc.is_null(y, nan_is_null=pa.types.is_floating(y.type))))
        if pa.types.is_floating(x.type):  # null and NaN are two keys
            equal = pc.and_(equal, pc.equal(pc.is_null(x), pc.is_null(y)))
        return equal.to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, repeated, last = None, 0, False, None
        for b in batches:
            if b.num_rows == 0:
                continue
            part, n = b.column("_wb_p")[0].as_py(), n + b.num_rows
            keys = [b.column(c) for c in cols]
            if not repeated:
                here = [k if last is None else pa.concat_arrays([e, k]) for k, e in zip(keys, last or keys, strict=True)]
                equal = np.ones(max(len(here[0]) - 1, 0), bool)
                for k in here:
                    equal &= same(k[:-1], k[1:])
                repeated = bool(equal.any())
            last = [k[-1:] for k in keys]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([n]), pa.array([repeated])], ["p", "n", "repeated"])
    return run


def _sorted_ranges(df: DataFrame, cols: list[str], ranges: int) -> tuple[DataFrame, list[int]]:
    """Rows in ranges of the whole key tuple, sorted in each and checkpointed,
    with their range as ``_wb_p``; and the rows of each range. Equal keys share
    a range, so neighbours show whether a key repeats. One row a range reaches
    the driver."""
    from waybatch.session import checkpoint_root

    checkpoint_root(df.sparkSession)
    ship_package(df.sparkSession)
    order = [F.col(c).asc_nulls_first() for c in cols]
    ranged = df.repartitionByRange(max(1, ranges), *order).sortWithinPartitions(*order).withColumn("_wb_p", F.spark_partition_id()).checkpoint()
    found = ranged.select(*cols, "_wb_p").mapInArrow(_neighbours(cols), "p int, n long, repeated boolean").collect()
    if any(r["repeated"] for r in found):
        raise _not_unique(cols, "two rows share a key")
    counts = {r["p"]: r["n"] for r in found}
    return ranged, [counts.get(p, 0) for p in range(ranged.rdd.getNumPartitions())]


def with_sequence(
    df: DataFrame,
    order_by,
    name: str = "seq",
    start: int = 1,
    num_buckets: int | None = None,
) -> tuple[DataFrame, int]:
    """Adds ``name`` = start, start+1, ... in the order of ``order_by``.

    ``order_by`` must be unique (nulls equal nulls); repeated keys raise
    :class:`ValueError`, as their order would depend on the run. Nulls come
    first, NaN after all numbers. Returns the frame and the row count.

    A single integral key that is dense (``max - min + 1`` is the row count,
    and a bitmap shows all keys different) is numbered by a projection. All
    other keys go through Spark's range partitioner, which cuts the whole key
    tuple (so a repeated leading value is split by the next column). Rows are
    sorted inside each range and checkpointed to the shared folder, which
    fixes which row sits where even if tasks are recomputed later. One pass
    over the keys counts each range (one row per range reaches the driver) and
    compares neighbours; rows are numbered by range offset + scan position.
    There is no window, and no shuffle of the keys besides the ranges.
    """
    cols = _order_columns(order_by)
    lead = cols[0]
    integral = len(cols) == 1 and isinstance(
        df.schema[lead].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    )
    if integral:
        stats = df.agg(F.count(F.lit(1)).alias("n"), F.count(lead).alias("nk"), F.min(lead).alias("lo"), F.max(lead).alias("hi")).first()
        n = stats["n"]
        if n > 0 and stats["nk"] == n and stats["hi"] - stats["lo"] + 1 <= n:
            if stats["hi"] - stats["lo"] + 1 < n or not _all_different(df, lead, int(stats["lo"]), n):
                raise _not_unique(cols, f"{n} rows between {stats['lo']} and {stats['hi']}")
            seq = F.col(lead).cast("long") - F.lit(int(stats["lo"])) + F.lit(start)
            return df.withColumn(name, seq.cast("long")), n
    ranged, counts = _sorted_ranges(df, cols, num_buckets or _default_buckets(df))
    offsets = [0, *accumulate(counts)][:-1]
    if not offsets:
        return ranged.drop("_wb_p").withColumn(name, F.lit(None).cast("long")), 0
    tagged = ranged.withColumn("_wb_m", F.monotonically_increasing_id())
    local = F.col("_wb_m") - F.shiftleft(F.col("_wb_p").cast("long"), 33)
    seq = F.element_at(F.lit(offsets), F.col("_wb_p") + F.lit(1)) + local + F.lit(start)
    return tagged.withColumn(name, seq.cast("long")).drop("_wb_p", "_wb_m"), sum(counts)


def with_file_order(df: DataFrame) -> DataFrame:
    """Tags rows of a file scan with file, split start and scan row id.

    Call directly on ``spark.read...`` output, before any filter.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(FILE_COL),
        F.col("_metadata.file_block_start").alias(BLOCK_COL),
        F.monotonically_increasing_id().alias(ROW_COL),
    )


def with_file_order_sequence(df: DataFrame, name: str = "seq", start: int = 1) -> DataFrame:
    """``name`` = position in (file name, position in file) order.

    The split table has one row per file split (metadata sized); its prefix
    sum is one small window, joined back behind a size check.
    """
    splits = df.groupBy(FILE_COL, BLOCK_COL).agg(
        F.count(F.lit(1)).alias("_wb_n"), F.min(ROW_COL).alias("_wb_r0")
    )
    w = Window.orderBy(FILE_COL, BLOCK_COL).rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select(
        FILE_COL,
        BLOCK_COL,
        "_wb_r0",
        F.coalesce(F.sum("_wb_n").over(w), F.lit(0)).alias("_wb_off"),
    )
    # one row per file split with its path: broadcast below 200k splits
    joined = df.join(broadcast_if_small(offsets, 200_000), [FILE_COL, BLOCK_COL])
    seq = F.col("_wb_off") + (F.col(ROW_COL) - F.col("_wb_r0")) + F.lit(start)
    return joined.withColumn(name, seq.cast("long")).drop("_wb_off", "_wb_r0")


def _first(df: DataFrame, cols: list[str], n: int) -> DataFrame:
    """The first ``n`` rows, a top-k; a key that repeats among the first ``n + 1`` is an error."""
    top = df.select(*cols).orderBy(*cols).limit(n + 1)
    if not top.groupBy(*cols).count().filter("count > 1").isEmpty():
        raise _not_unique(cols, f"a key repeats among the first {n + 1} rows")
    return df.orderBy(*cols).limit(n)


def head_rows(df: DataFrame, order_by, n: int, small_limit: int = 100_000) -> DataFrame:
    """First ``n`` rows in ``order_by`` order.

    A key that repeats among the first ``n + 1`` rows raises
    :class:`ValueError`, as which rows are the first would depend on the run.
    Small ``n``: a top-k (``TakeOrderedAndProject``); later keys are not looked
    at. Large ``n``: sequence and filter, so no task holds ``n`` rows; there
    any repeated key is an error.
    """
    if n < 0:
        raise ValueError("n must be >= 0")
    cols = _order_columns(order_by)
    if n <= small_limit:
        return _first(df, cols, n)
    seq, _ = with_sequence(df, cols, name="_wb_seq")
    return seq.filter(F.col("_wb_seq") <= F.lit(n)).drop("_wb_seq")


def page_rows(df: DataFrame, order_by, offset: int, size: int, small_limit: int = 100_000) -> DataFrame:
    """Rows ``offset+1 .. offset+size`` in ``order_by`` order; keys as in
    ``head_rows``. For pages deep in a large table, or many of them, write it
    once in order (:func:`write_ordered`) and read pages from that."""
    if offset < 0 or size < 0:
        raise ValueError("offset and size must be >= 0")
    cols = _order_columns(order_by)
    if offset + size <= small_limit:
        return _first(df, cols, offset + size).orderBy(*cols).offset(offset)
    seq, _ = with_sequence(df, cols, name="_wb_seq")
    keep = (F.col("_wb_seq") > F.lit(offset)) & (F.col("_wb_seq") <= F.lit(offset + size))
    return seq.filter(keep).drop("_wb_seq")


def write_ordered(df: DataFrame, order_by, path: str, rows_per_file: int = 1_000_000, num_buckets: int | None = None) -> int:
    """Writes ``df`` in ``order_by`` order under ``path``, with an index.

    ``rows``: Parquet files, each a stretch of the order, of at most
    ``rows_per_file`` rows. ``index``: a row a file with its name, the
    position of its first row, its row count and its least and largest first
    key. Keys must be unique. Returns the row count. :func:`read_page` reads
    the files that it needs only.
    """
    cols = _order_columns(order_by)
    spark = df.sparkSession
    ranged, counts = _sorted_ranges(df, cols, num_buckets or _default_buckets(df))
    ranged.drop("_wb_p").write.option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/rows")
    name = F.col("_metadata.file_name")
    files = spark.read.schema(df.schema).parquet(f"{path}/rows").select(name.alias("file"), F.col(cols[0]).alias("key"))
    files = files.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
    # part-<range>-<id>-c<file>: the numbers of a range and of its file
    number = lambda p: F.regexp_extract("file", p, 1).cast("int")
    files = files.withColumn("range", number("^part-([0-9]+)-")).withColumn("part", number("-c([0-9]+)[.]"))
    starts = F.map_from_arrays(F.lit(list(range(len(counts) + 1))), F.lit([0, *accumulate(counts)]))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("range").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    index = files.select("file", (F.element_at(starts, F.col("range")) + before).cast("long").alias("start"), "n", "low", "high")
    index.coalesce(1).write.parquet(f"{path}/index")
    return sum(counts)


def read_page(spark: SparkSession, path: str, offset: int, size: int) -> DataFrame:
    """Rows ``offset+1 .. offset+size`` of a table written by
    :func:`write_ordered`, with their position as ``seq`` (from 1). Only files
    that hold such rows are listed and read."""
    if offset < 0 or size < 0:
        raise ValueError("offset and size must be >= 0")
    index = spark.read.parquet(f"{path}/index")
    wanted = index.filter((F.col("start") < offset + size) & (F.col("start") + F.col("n") > offset)).select("file", "start").collect()
    schema = spark.read.parquet(f"{path}/rows").schema
    if not wanted:
        return spark.createDataFrame([], schema).withColumn("seq", F.lit(None).cast("long"))
    rows = spark.read.schema(schema).parquet(*(f"{path}/rows/{r['file']}" for r in wanted))
    starts = F.create_map(*(F.lit(x) for r in wanted for x in (r["file"], r["start"])))  # as many as the page needs
    seq = F.element_at(starts, F.col("_metadata.file_name")) + F.col("_metadata.row_index") + 1
    return rows.select("*", seq.cast("long").alias("seq")).filter((F.col("seq") > offset) & (F.col("seq") <= offset + size))
