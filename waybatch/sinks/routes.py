"""Delivery CSV output and the stored route table.

The route table is a folder with a commit manifest (``manifest``): an append
becomes visible by one rename, and a batch id that was appended already is not
appended again. It can also be a catalog table, which Spark's own commit
protocol appends to. A new surrogate key ``route_key`` continues above the
largest stored one, numbered in route order with the distributed sequence.
One writer at a time per table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from waybatch.functions.geo import is_wkt_point, with_wkt_in_wgs84, wkt_point
from waybatch.operators.sequence import with_sequence
from waybatch.schema import DELIVERY_COLUMNS, ROUTES_SCHEMA, TIMESTAMP_TEXT_FORMAT
from waybatch.session import checkpoint_root
from waybatch.sinks import manifest

NATURAL_KEY = ["pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon", "timestamp"]


def write_delivery_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header, no index; a folder of part files written by the executors."""
    out = df.select(*DELIVERY_COLUMNS) if set(DELIVERY_COLUMNS) <= set(df.columns) else df
    (
        out.write.mode(mode)
        .option("header", "true")
        .option("timestampNTZFormat", TIMESTAMP_TEXT_FORMAT)
        .option("timestampFormat", TIMESTAMP_TEXT_FORMAT)
        .csv(path)
    )


def write_sample_csv(df: DataFrame, path: str, order_by="delivery_id", n: int = 10_000) -> bool:
    """First ``n`` rows in ``order_by`` order; skipped (False) if empty."""
    from waybatch.operators.sequence import head_rows

    sample = head_rows(df, order_by, n)
    if sample.isEmpty():
        return False
    write_delivery_csv(sample, path)
    return True


def repair_geometry(df: DataFrame) -> DataFrame:
    """Geometry that is null or not a WKT point becomes the pickup point if
    both pickup coordinates are there, else null. Adds ``geometry_fixed``."""
    for c in ("geometry", "pickup_lon", "pickup_lat"):
        if c not in df.columns:
            raise ValueError(f"Missing required column {c!r}")
    bad = ~is_wkt_point("geometry")
    have = F.col("pickup_lon").isNotNull() & F.col("pickup_lat").isNotNull()
    fixed = F.when(~bad, F.col("geometry")).when(have, wkt_point("pickup_lon", "pickup_lat"))
    return df.withColumn("geometry_fixed", bad).withColumn("geometry", fixed)


def to_stored(routes: DataFrame, crs_col: str | None = None) -> DataFrame:
    """Route rows in stored form: timestamp as text, geometry repaired and, where
    ``crs_col`` names the column with the CRS code of each row's geometry,
    converted to longitude and latitude (a code that isn't known is an error)."""
    if "geometry" not in routes.columns:
        routes = routes.withColumn("geometry", F.lit(None).cast("string"))
    elif crs_col is not None:
        routes = with_wkt_in_wgs84(routes, "geometry", crs_col)
    r = repair_geometry(routes)
    return r.withColumn("timestamp", F.date_format("timestamp", TIMESTAMP_TEXT_FORMAT))


def is_table_name(target: str) -> bool:
    """A catalog table name (``db.routes``) rather than a folder path."""
    return "/" not in target and ":" not in target


def create_routes_table(spark: SparkSession, target: str) -> None:
    """Creates an empty route table with the fixed schema if none is there:
    a folder with a manifest, or a catalog table (``USING parquet``)."""
    if not is_table_name(target):
        manifest.create(spark, target)
    elif not spark.catalog.tableExists(target):
        spark.createDataFrame([], ROUTES_SCHEMA).write.format("parquet").mode("ignore").saveAsTable(target)


def read_routes(spark: SparkSession, target: str) -> DataFrame:
    """The stored routes: of a folder, those of committed appends."""
    table = spark.table(target) if is_table_name(target) else manifest.read(spark, target, ROUTES_SCHEMA)
    return table.select(*ROUTES_SCHEMA.names)


def _without(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows whose natural key is not in ``known``; null equals null. The known
    keys are made distinct first: copies of one key collapse map-side, so a
    much-repeated key cannot skew the anti join."""
    t = known.select(*[F.col(c).alias(f"_wb_t_{c}") for c in NATURAL_KEY]).distinct()
    return rows.join(t, [rows[c].eqNullSafe(t[f"_wb_t_{c}"]) for c in NATURAL_KEY], "left_anti")


def _not_stored(spark: SparkSession, rows: DataFrame, path: str, done) -> DataFrame:
    """Rows whose natural key no committed append has. The filters of the rows'
    months rule out nearly all that are new; only keys that they leave open,
    and of the table only their months, reach the exact join."""
    if not any(c["rows"] for c in done):
        return rows
    open_ = manifest.possible_repeats(spark, path, rows, NATURAL_KEY, done).checkpoint()
    months = [r[0] for r in open_.select(manifest.MONTH).distinct().collect()]
    if not months:
        return rows
    t = manifest.read(spark, path, ROUTES_SCHEMA, done).filter(F.col(manifest.MONTH).isin(months))
    asked = open_.select(*[F.col(c).alias(f"_wb_o_{c}") for c in NATURAL_KEY])
    return _without(rows, t.join(asked, [t[c].eqNullSafe(asked[f"_wb_o_{c}"]) for c in NATURAL_KEY], "left_semi"))


def _numbered(stored: DataFrame, order_by, start: int) -> tuple[DataFrame, int]:
    if tuple(order_by) != ("batch_id", "visit_seq"):
        return with_sequence(stored, list(order_by), name="route_key", start=start)
    # one numeric key in the same order; dense when batches are full,
    # and then the key needs no shuffle at all
    m = stored.agg(F.max("visit_seq")).first()[0] or 1
    stored = stored.withColumn(
        "_wb_order", F.col("batch_id").cast("long") * F.lit(int(m)) + F.col("visit_seq").cast("long") - F.lit(1)
    )
    keyed, n = with_sequence(stored, "_wb_order", name="route_key", start=start)
    return keyed.drop("_wb_order"), n


def append_routes(
    spark: SparkSession,
    routes: DataFrame,
    path: str,
    order_by=("batch_id", "visit_seq"),
    dedupe: bool = False,
    parity: bool = False,
    batch_id: str | None = None,
    crs_col: str | None = None,
) -> int:
    """Appends routes with ``route_key`` continuing above the largest stored key.
    ``path`` is a folder or a catalog table name.

    ``batch_id`` names the append: if the folder's manifest has it already,
    nothing is appended (0), so that a job can be run again after any
    failure. Without one, each call is an append of its own. ``dedupe`` drops
    rows whose natural key (coordinates, timestamp) is already stored; a
    folder table keeps Bloom filters of them by month, so the work grows with
    the rows appended. ``parity`` stores a null ``delivery_id``, as a table
    that replaces the id by its own key. ``crs_col``: see :func:`to_stored`. Returns the number of rows appended.
    """
    catalog = is_table_name(path)
    if batch_id is not None:
        if catalog:
            raise ValueError("a batch id needs a folder table; a catalog table has no manifest")
        manifest.check_batch_id(batch_id)
    create_routes_table(spark, path)
    checkpoint_root(spark)
    month = F.coalesce(F.substring("timestamp", 1, 7), F.lit("none"))
    stored = to_stored(routes, crs_col).withColumn(manifest.MONTH, month)
    done = []
    if catalog:
        target = read_routes(spark, path)
        base = target.agg(F.coalesce(F.max("route_key"), F.lit(0)).alias("m")).first()["m"]
        stored = _without(stored, target) if dedupe else stored
    else:
        done = manifest.commits(spark, path)
        if batch_id in {c["batch_id"] for c in done}:
            return 0
        base = max((c["last_key"] for c in done), default=0)
        if dedupe:
            stored = _not_stored(spark, stored.checkpoint(), path, done)
    # The numbering reads its input three times (bounds, counts, rows):
    # run the route plan once into the shared checkpoint folder.
    keyed, n = _numbered(stored.checkpoint(), order_by, base + 1)
    delivery_id = F.lit(None).cast("long") if parity else F.col("delivery_id").cast("long")
    out = keyed.select(
        F.col("route_key"),
        delivery_id.alias("delivery_id"),
        *[F.col(c).cast(ROUTES_SCHEMA[c].dataType) for c in ROUTES_SCHEMA.names[2:]],
        manifest.MONTH,
    )
    if catalog:
        if n:
            out.drop(manifest.MONTH).write.format("parquet").mode("append").saveAsTable(path)
        return n
    batch_id = batch_id or uuid.uuid4().hex
    n_blocks = 0
    if n:
        folder = f"{path}/batch={batch_id}"  # what a killed append left there is replaced
        out.hint("rebalance", manifest.MONTH).write.mode("overwrite").partitionBy(manifest.MONTH).parquet(folder)
        own = [Row(version=0, batch_id=batch_id, rows=n)]
        n_blocks = manifest.write_filters(spark, path, batch_id, manifest.read(spark, path, ROUTES_SCHEMA, own), NATURAL_KEY, n)
    manifest.commit(spark, path, done, batch_id, n, base + n, n_blocks)
    return n
