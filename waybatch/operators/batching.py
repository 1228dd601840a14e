"""Fixed-size batches of consecutive rows and per-batch helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybatch.functions.geo import utm_crs, utm_south, utm_zone
from waybatch.operators.sequence import with_file_order_sequence, with_sequence

FILE_ORDER = "file_order"


def check_batch_size(batch_size: int) -> None:
    if not isinstance(batch_size, int) or isinstance(batch_size, bool) or batch_size <= 0:
        raise ValueError(f"batch_size must be a positive integer, got {batch_size!r}")


def batch_columns(seq, batch_size: int):
    """(batch_id, rn): batch of a 1-based position and 0-based row in it."""
    pos = F.col(seq) - F.lit(1) if isinstance(seq, str) else seq - F.lit(1)
    batch_id = F.floor(pos / F.lit(batch_size)).cast("long")
    rn = (pos - batch_id * F.lit(batch_size)).cast("int")
    return batch_id, rn


def assign_batches(df: DataFrame, order_by, batch_size: int, keep_seq: bool = True) -> DataFrame:
    """Adds ``seq`` (1..n), ``batch_id`` and ``rn`` (0-based row in batch).

    ``order_by`` is a unique key, or ``"file_order"`` for rows tagged by
    ``with_file_order`` at scan time.
    """
    check_batch_size(batch_size)
    if order_by == FILE_ORDER:
        seq = with_file_order_sequence(df, name="seq")
    else:
        seq, _ = with_sequence(df, order_by, name="seq")
    batch_id, rn = batch_columns("seq", batch_size)
    out = seq.withColumn("batch_id", batch_id).withColumn("rn", rn)
    return out if keep_seq else out.drop("seq")


def batch_count(n_rows: int, batch_size: int) -> int:
    """Number of batches, rounded up."""
    check_batch_size(batch_size)
    return (n_rows + batch_size - 1) // batch_size


def batch_crs(batched: DataFrame) -> DataFrame:
    """CRS of each batch, decided by its first row (rn = 0)."""
    first = batched.filter(F.col("rn") == F.lit(0))
    return first.select(
        "batch_id",
        utm_crs("pickup_lon", "pickup_lat").alias("crs"),
        utm_zone("pickup_lon").alias("utm_zone"),
        utm_south("pickup_lat").alias("utm_south"),
    )


def by_batch(batched: DataFrame, spread: int = 1) -> DataFrame:
    """Hash-partitions by ``batch_id`` into ``spread`` times ``spark.sql.shuffle.partitions``.

    The explicit count keeps AQE from merging partitions by input size:
    per-batch work (pairs, walks) grows far beyond its input. A larger
    ``spread`` keeps few long batches from meeting in one task.
    """
    n = int(batched.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return batched.repartition(n * spread, "batch_id")


def with_batch_zone(batched: DataFrame, spread: int = 1) -> DataFrame:
    """Adds the batch's UTM zone, hemisphere and CRS (from its first row).

    Uses an unordered window on ``batch_id`` after :func:`by_batch`; later
    operators on ``batch_id`` reuse that partitioning.
    """
    batched = by_batch(batched, spread)
    w = Window.partitionBy("batch_id")
    first = F.min_by(F.struct(F.col("pickup_lon").alias("lon"), F.col("pickup_lat").alias("lat")), F.col("rn")).over(w)
    out = batched.withColumn("_wb_first", first)
    return (
        out.withColumn("utm_zone", utm_zone(F.col("_wb_first.lon")))
        .withColumn("utm_south", utm_south(F.col("_wb_first.lat")))
        .withColumn("crs", utm_crs(F.col("_wb_first.lon"), F.col("_wb_first.lat")))
        .drop("_wb_first")
    )


def dedup_first(batched: DataFrame, key: str = "delivery_id", order: str = "rn", scope: str = "batch") -> DataFrame:
    """Keeps the first row of each ``key`` per batch (``scope="batch"``),
    or over the whole input (``scope="all"``, ``order`` then must be
    unique over the input, e.g. ``seq``).

    Per batch, a window on ``(batch_id, key)`` sees at most ``batch_size``
    rows. Over all rows one id may have any number of copies, so the first
    position per id is found by an aggregate (combined map-side, so a hot
    id never gathers in one task) and joined back on the unique position.
    """
    if scope == "batch":
        w = Window.partitionBy("batch_id", key).orderBy(F.col(order).asc())
        return batched.withColumn("_wb_k", F.row_number().over(w)).filter(F.col("_wb_k") == 1).drop("_wb_k")
    if scope != "all":
        raise ValueError("scope must be 'batch' or 'all'")
    first = batched.groupBy(key).agg(F.min(order).alias(order))
    return batched.join(first, [key, order], "left_semi")


def batch_metrics(batched: DataFrame, key: str = "delivery_id") -> DataFrame:
    """Rows in and rows out (first of each id kept) per batch."""
    per_id = batched.groupBy("batch_id", key).agg(F.count(F.lit(1)).alias("_wb_n"))
    return per_id.groupBy("batch_id").agg(
        F.sum("_wb_n").cast("long").alias("rows_in"),
        F.count(F.lit(1)).alias("rows_out"),
    )
