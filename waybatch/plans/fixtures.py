"""Fixture views over the driver's tables.

The driver's data has no coordinates, so zones, trips and deliveries are
derived from ``nation``, ``orders`` and ``customer`` by integer arithmetic
(then one division), which gives the same doubles in every engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybatch.operators.lookup import zone_lookup


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ratio(num, den: int):
    return num.cast("double") / F.lit(den)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone centroids per nation; nation 24 is left out (unknown zone)."""
    n = F.col("n_nationkey")
    return (
        table(spark, sf_dir, "nation")
        .filter(n < F.lit(24))
        .select(
            n.alias("locationid"),
            _ratio(F.lit(40450) + F.lit(25) * n, 1000).alias("lat"),
            _ratio(F.lit(-74350) + F.lit(30) * ((n * F.lit(7)) % F.lit(25)), 1000).alias("lon"),
        )
    )


def zones_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zones as a list in which every fifth id has an earlier entry elsewhere."""
    z = zones(spark, sf_dir)
    early = z.filter(F.col("locationid") % F.lit(5) == F.lit(0))
    early = early.select("locationid", (F.col("lat") + F.lit(1.0)).alias("lat"), F.lit(-70.0).alias("lon"), F.lit(0).alias("entry"))
    return early.unionByName(z.withColumn("entry", F.lit(1)))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("trip_id"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("c_nationkey").alias("pulocationid"),
        ((F.col("o_orderkey") * F.lit(7) + F.lit(3)) % F.lit(26)).cast("int").alias("dolocationid"),
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup with the default plus a small offset per trip."""
    t = trips(spark, sf_dir)
    looked = zone_lookup(t, zones(spark, sf_dir), "pulocationid", "dolocationid")
    tid = F.col("trip_id")

    def off(mult: int):
        return _ratio((tid * F.lit(mult)) % F.lit(1000), 100000)

    return looked.select(
        (tid + F.lit(1)).alias("delivery_id"),
        (F.col("pickup_lat") + off(37)).alias("pickup_lat"),
        (F.col("pickup_lon") + off(53)).alias("pickup_lon"),
        (F.col("dropoff_lat") + off(71)).alias("dropoff_lat"),
        (F.col("dropoff_lon") + off(89)).alias("dropoff_lon"),
        F.col("tpep_pickup_datetime").alias("timestamp"),
    )


def deliveries_times(spark: SparkSession, sf_dir: str, copies: int) -> DataFrame:
    """``copies`` shifted copies of the deliveries (bench scale-up); key
    ``delivery_id * copies + k``."""
    d = deliveries(spark, sf_dir).withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    return d.withColumn("delivery_id", F.col("delivery_id") * F.lit(copies) + F.col("_k")).drop("_k")


def deliveries_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth row repeats the id before it, in the same batch of 100."""
    d = deliveries(spark, sf_dir)
    i = F.col("delivery_id")
    return d.select(
        F.when(i % F.lit(10) == F.lit(0), i - F.lit(1)).otherwise(i).alias("delivery_id"),
        i.alias("row_no"),
        "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon", "timestamp",
    )


def deliveries_far_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids repeat only in other batches of 100."""
    d = deliveries(spark, sf_dir)
    i = F.col("delivery_id")
    return d.select(
        ((i - F.lit(1)) % F.lit(500) + F.lit(1)).alias("delivery_id"),
        i.alias("row_no"),
        "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon", "timestamp",
    )


def zone_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One closed trapezoid per nation, UTM 18N metres."""
    n = F.col("n_nationkey")
    s = F.col("seq")
    x = F.lit(560000) + F.lit(1500) * n + F.when(s == 1, F.lit(1000)).when(s == 2, F.lit(500)).otherwise(F.lit(0))
    y = F.lit(4490000) + F.lit(900) * n + F.when(s.isin(2, 3), F.lit(1000)).otherwise(F.lit(0))
    return (
        table(spark, sf_dir, "nation")
        .select("n_nationkey", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("seq"))
        .select(
            n.cast("int").alias("zone_id"), F.lit(0).alias("ring"), s,
            x.cast("double").alias("x"), y.cast("double").alias("y"),
        )
    )


def zone_vertices_feet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trapezoids in New York feet (EPSG:2263)."""
    n = F.col("zone_id")
    x = F.col("x") + F.lit(340000.0) + F.lit(18500.0) * n
    return zone_vertices(spark, sf_dir).withColumn("x", x).withColumn("y", F.col("y") - F.lit(4300000.0))


def zone_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One polygon per nation as WKT text, New York feet: a trapezoid, every
    third one with a hole, every fourth (n % 4 = 1) with a second part;
    odd ones wind clockwise. Nation 24 has no polygon."""
    n = F.col("n_nationkey")

    def ring(points, way):
        at = [F.concat_ws(" ", (F.lit(980000 + dx) + F.lit(1500) * n).cast("string"), (F.lit(190000 + dy) + F.lit(900) * n).cast("string"))
              for dx, dy in (points if way else points[::-1])]
        return F.concat(F.lit("("), F.concat_ws(", ", *at), F.lit(")"))

    def wound(points):
        return F.when(n % 2 == 0, ring(points, True)).otherwise(ring(points, False))

    body = wound([(0, 0), (1000, 0), (500, 1000), (0, 1000), (0, 0)])
    hole = F.when(n % 3 == 0, F.concat(F.lit(", "), wound([(300, 300), (400, 300), (400, 400), (300, 400), (300, 300)]))).otherwise(F.lit(""))
    second = wound([(2000, 0), (2500, 0), (2500, 500), (2000, 500), (2000, 0)])
    first = F.concat(F.lit("("), body, hole, F.lit(")"))
    wkt = (F.when(n % 4 == 1, F.concat(F.lit("MULTIPOLYGON ("), first, F.lit(", ("), second, F.lit("))")))
           .when(n == 24, F.lit("POLYGON EMPTY")).otherwise(F.concat(F.lit("POLYGON "), first)))
    return table(spark, sf_dir, "nation").select(n.alias("zone_id"), wkt.alias("wkt"))


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries as text with seeded faults, for the quality report."""
    d = deliveries(spark, sf_dir)
    i = F.col("delivery_id")

    def every(k: int):
        return i % F.lit(k) == F.lit(0)

    return d.select(
        i.cast("string").alias("delivery_id"),
        F.when(every(101), F.lit("invalid")).when(every(103), F.lit(None).cast("string"))
        .when(every(107), F.lit("91")).otherwise(F.lit("40.7")).alias("pickup_lat"),
        F.when(every(109), F.lit("181")).otherwise(F.lit("-74.0")).alias("pickup_lon"),
        F.lit("40.71").alias("dropoff_lat"),
        F.lit("-74.01").alias("dropoff_lon"),
        F.when(every(113), F.lit("not a date")).otherwise(F.lit("2025-02-20 10:00:00")).alias("timestamp"),
    )
