"""Trips to deliveries: head, ids, zone lookup, clean-up, box, year shift."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybatch.functions.timefn import shift_year
from waybatch.operators.lookup import zone_lookup
from waybatch.operators.sequence import with_file_order_sequence, with_sequence
from waybatch.schema import (
    COORD_COLUMNS,
    DEFAULT_LAT_BOUNDS,
    DEFAULT_LON_BOUNDS,
    DELIVERY_COLUMNS,
)


def check_row_params(max_rows: int | None, sample_rows: int) -> None:
    """``max_rows`` is a cap that the caller asks for; ``None`` means all rows."""
    if sample_rows < 0 or (max_rows is not None and max_rows < 0):
        raise ValueError("row numbers must not be negative")
    if max_rows is not None and sample_rows > max_rows:
        raise ValueError(f"a sample of {sample_rows} rows cannot exceed the cap of {max_rows} rows")


def bbox_filter(df: DataFrame, lat_bounds=DEFAULT_LAT_BOUNDS, lon_bounds=DEFAULT_LON_BOUNDS) -> DataFrame:
    """Pickup and dropoff inside the box, both ends inclusive."""
    (la0, la1), (lo0, lo1) = lat_bounds, lon_bounds
    lat = lambda c: F.col(c).between(F.lit(float(la0)), F.lit(float(la1)))
    lon = lambda c: F.col(c).between(F.lit(float(lo0)), F.lit(float(lo1)))
    return df.filter(lat("pickup_lat") & lon("pickup_lon") & lat("dropoff_lat") & lon("dropoff_lon"))


def prepare_deliveries(
    trips: DataFrame,
    zones: DataFrame,
    order_by="file_order",
    max_rows: int | None = None,
    sample_rows: int = 0,
    lat_bounds=DEFAULT_LAT_BOUNDS,
    lon_bounds=DEFAULT_LON_BOUNDS,
    shift_policy: str = "clamp",
    pickup_col: str = "PULocationID",
    dropoff_col: str = "DOLocationID",
    time_col: str = "tpep_pickup_datetime",
    drop_invalid: bool = False,
) -> DataFrame:
    """Trips to the six delivery columns.

    All trips, or the first ``max_rows`` if given, get ids 1..n in ``order_by``
    order (or file order) before any filter, so filtered rows leave gaps. One sequence
    gives both the head and the ids. Coordinates come from the zone lookup
    with its default; rows with a missing coordinate or outside the box
    are dropped; timestamps move to 2025 (``shift_policy`` for 29 Feb);
    missing or unparsable timestamps are kept (counted by
    ``quality.invalid_timestamps``) unless ``drop_invalid``.
    """
    check_row_params(max_rows, sample_rows)
    if order_by == "file_order":
        seq = with_file_order_sequence(trips, name="delivery_id")
    else:
        seq, _ = with_sequence(trips, order_by, name="delivery_id")
    head = seq if max_rows is None else seq.filter(F.col("delivery_id") <= F.lit(max_rows))
    looked = zone_lookup(head, zones, pickup_col, dropoff_col)
    out = looked.select(
        "delivery_id",
        *COORD_COLUMNS,
        F.col(time_col).try_cast("timestamp_ntz").alias("timestamp"),
    ).dropna(subset=COORD_COLUMNS)
    out = bbox_filter(out, lat_bounds, lon_bounds)
    out = out.withColumn("timestamp", shift_year("timestamp", shift_policy)).select(*DELIVERY_COLUMNS)
    return out.filter(F.col("timestamp").isNotNull()) if drop_invalid else out
