"""Schemas, column names and fixed values shared by the whole package."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must match the studied behaviour.
DELIVERY_COLUMNS = [
    "delivery_id",
    "pickup_lat",
    "pickup_lon",
    "dropoff_lat",
    "dropoff_lon",
    "timestamp",
]
COORD_COLUMNS = ["pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon"]
TRIP_COLUMNS = ["tpep_pickup_datetime", "PULocationID", "DOLocationID"]
DEFAULT_ZONE_LAT = 40.75
DEFAULT_ZONE_LON = -73.98
DEFAULT_LAT_BOUNDS = (40.5, 41.0)
DEFAULT_LON_BOUNDS = (-74.3, -73.7)
DEFAULT_SAMPLE_ROWS = 10_000
DEFAULT_PIPELINE_BATCH_SIZE = 50_000
TARGET_YEAR = 2025
YIELD_RATIO = 0.9
TIMESTAMP_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
# Text values pandas' CSV reader turns into a missing value.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]
DELIVERY_SCHEMA = T.StructType(
    [
        T.StructField("delivery_id", T.LongType(), True),
        T.StructField("pickup_lat", T.DoubleType(), True),
        T.StructField("pickup_lon", T.DoubleType(), True),
        T.StructField("dropoff_lat", T.DoubleType(), True),
        T.StructField("dropoff_lon", T.DoubleType(), True),
        T.StructField("timestamp", T.TimestampNTZType(), True),
    ]
)

# Every required column read as text; types are tested, then cast.
DELIVERY_TEXT_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in DELIVERY_COLUMNS]
)

# Stored route table: surrogate key, the delivery id it came from,
# four coordinates, timestamp as text and WKT geometry.
ROUTES_SCHEMA = T.StructType(
    [
        T.StructField("route_key", T.LongType(), False),
        T.StructField("delivery_id", T.LongType(), True),
        T.StructField("pickup_lat", T.DoubleType(), True),
        T.StructField("pickup_lon", T.DoubleType(), True),
        T.StructField("dropoff_lat", T.DoubleType(), True),
        T.StructField("dropoff_lon", T.DoubleType(), True),
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("geometry", T.StringType(), True),
    ]
)
