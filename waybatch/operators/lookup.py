"""Zone lookup with a default, unknown-zone audit and polygon centroids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybatch.functions.geo import lcc_inverse, utm_inverse, wkt_rings, NY_LONG_ISLAND_FTUS
from waybatch.schema import DEFAULT_ZONE_LAT, DEFAULT_ZONE_LON
from waybatch.session import broadcast_if_small


def one_row_per_zone(zones: DataFrame) -> DataFrame:
    """``(locationid, lat, lon)``, one row an id: where an id is listed several
    times, the last entry wins, by ``entry`` if the table has such a column (a
    number that grows with the place in the list), else the entry of largest
    ``(lat, lon)``. Entries without a place don't count. A list without
    repeated ids (one small count shows it) is taken as it is."""
    order = ["entry", "lat", "lon"] if "entry" in zones.columns else ["lat", "lon"]
    known = zones.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("locationid").isNotNull())
    n = known.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("locationid").alias("ids")).first()
    if n["rows"] == n["ids"]:
        return known.select("locationid", "lat", "lon")
    last = F.max(F.struct(*order)).alias("last")
    return known.groupBy("locationid").agg(last).select("locationid", F.col("last.lat").alias("lat"), F.col("last.lon").alias("lon"))


def zone_lookup(
    trips: DataFrame,
    zones: DataFrame,
    pickup_col: str = "PULocationID",
    dropoff_col: str = "DOLocationID",
    default: tuple[float, float] = (DEFAULT_ZONE_LAT, DEFAULT_ZONE_LON),
) -> DataFrame:
    """Pickup and dropoff coordinates from ``zones(locationid, lat, lon)``.

    Unknown ids take ``default``; the row count is kept, also where a zone id
    is listed several times (``one_row_per_zone``). Zones with a null
    centroid count as unknown. The zone table is broadcast behind a row
    check; a larger one falls back to a shuffle join.
    """
    z = broadcast_if_small(one_row_per_zone(zones))
    pz = z.select(F.col("locationid").alias("_wb_pid"), F.col("lat").alias("_wb_plat"), F.col("lon").alias("_wb_plon"))
    dz = z.select(F.col("locationid").alias("_wb_did"), F.col("lat").alias("_wb_dlat"), F.col("lon").alias("_wb_dlon"))
    out = trips.join(pz, F.col(pickup_col) == F.col("_wb_pid"), "left").join(
        dz, F.col(dropoff_col) == F.col("_wb_did"), "left"
    )
    lat0, lon0 = F.lit(float(default[0])), F.lit(float(default[1]))
    return (
        out.withColumn("pickup_lat", F.coalesce("_wb_plat", lat0))
        .withColumn("pickup_lon", F.coalesce("_wb_plon", lon0))
        .withColumn("dropoff_lat", F.coalesce("_wb_dlat", lat0))
        .withColumn("dropoff_lon", F.coalesce("_wb_dlon", lon0))
        .drop("_wb_pid", "_wb_plat", "_wb_plon", "_wb_did", "_wb_dlat", "_wb_dlon")
    )


def unknown_zones(
    trips: DataFrame,
    zones: DataFrame,
    pickup_col: str = "PULocationID",
    dropoff_col: str = "DOLocationID",
) -> DataFrame:
    """Location ids that took the default, with trip counts per role."""
    z = zones.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select("locationid")
    z = broadcast_if_small(z)
    roles = trips.select(
        F.inline(
            F.array(
                F.struct(F.lit("pickup").alias("role"), F.col(pickup_col).cast("int").alias("locationid")),
                F.struct(F.lit("dropoff").alias("role"), F.col(dropoff_col).cast("int").alias("locationid")),
            )
        )
    )
    missing = roles.join(z, "locationid", "left_anti")
    return missing.groupBy("locationid", "role").agg(F.count(F.lit(1)).alias("n_trips"))


def polygon_vertices(zones: DataFrame, id_col: str = "zone_id", wkt_col: str = "wkt") -> DataFrame:
    """Zone polygons as WKT text (``geo.wkt_rings``) to vertex rows ``(zone_id, ring, seq, x, y)``.

    Zones whose text is null, empty or no polygon give no rows (they count as
    unknown zones later). Several rows of one zone are parts of it: rings are
    told apart by a hash of the part's text, and equal parts count once, so
    the place of a row in the table doesn't matter."""
    parts = zones.select(F.col(id_col).cast("int").alias("zone_id"), F.col(wkt_col).alias("_wb_wkt")).distinct()
    rings = parts.select("zone_id", F.xxhash64("_wb_wkt").alias("_wb_part"), F.posexplode(wkt_rings("_wb_wkt")).alias("_wb_r", "_wb_ring"))
    points = rings.select(
        "zone_id", F.xxhash64("_wb_part", "_wb_r").alias("ring"), F.posexplode("_wb_ring.points").alias("seq", "_wb_p"))
    return points.select("zone_id", "ring", "seq", F.col("_wb_p.x").alias("x"), F.col("_wb_p.y").alias("y"))


_TERM = "decimal(28,20)"  # one edge's share, in units of the zone's frame; a sum holds 1e18 of them


def zone_centroid(vertices: DataFrame, decimals: int = 3) -> DataFrame:
    """Area-weighted centroid per zone from ``(zone_id, ring, seq, x, y)``.

    Rings are closed (first vertex repeated last) and numbered by ``seq``.
    Edges come from an equi-join of each vertex with the next one, so a
    large ring is spread over tasks. Holes wind the other way, so signed
    sums subtract them. Zero area gives null; a zone without an edge gives no row.

    Sums are taken in exact decimals, in a frame of the zone's own: its least
    x and y as origin, its extent (as a power of two) as unit. They don't
    depend on the order or the partitions of the rows, nor on how far the
    zone lies from the origin.
    """
    v = vertices.select("zone_id", "ring", "seq", "x", "y")
    extent = F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y"))
    unit = F.when(extent > F.lit(0.0), F.pow(F.lit(2.0), F.ceil(F.log2(extent)))).otherwise(F.lit(1.0))
    frame = broadcast_if_small(v.groupBy("zone_id").agg(
        F.min("x").alias("_wb_x0"), F.min("y").alias("_wb_y0"), unit.alias("_wb_u")))
    a = v.join(frame, "zone_id").select(
        "zone_id", "ring", "seq", "_wb_x0", "_wb_y0", "_wb_u",
        ((F.col("x") - F.col("_wb_x0")) / F.col("_wb_u")).alias("x"), ((F.col("y") - F.col("_wb_y0")) / F.col("_wb_u")).alias("y"))
    b = a.select("zone_id", "ring", (F.col("seq") - F.lit(1)).alias("seq"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    cross = F.col("x") * F.col("y2") - F.col("x2") * F.col("y")
    edges = a.join(b, ["zone_id", "ring", "seq"])
    agg = edges.groupBy("zone_id").agg(
        F.sum(cross.cast(_TERM)).cast("double").alias("_wb_c"),
        F.sum(((F.col("x") + F.col("x2")) * cross).cast(_TERM)).cast("double").alias("_wb_sx"),
        F.sum(((F.col("y") + F.col("y2")) * cross).cast(_TERM)).cast("double").alias("_wb_sy"),
        *[F.min(c).alias(c) for c in ("_wb_x0", "_wb_y0", "_wb_u")],
    )
    den = F.lit(3.0) * F.col("_wb_c")
    ok = F.col("_wb_c") != F.lit(0.0)
    return agg.select(
        "zone_id",
        F.round(F.when(ok, F.col("_wb_x0") + F.col("_wb_u") * (F.col("_wb_sx") / den)), decimals).alias("cx"),
        F.round(F.when(ok, F.col("_wb_y0") + F.col("_wb_u") * (F.col("_wb_sy") / den)), decimals).alias("cy"),
    )


def centroid_to_wgs84(centroids: DataFrame, crs: str) -> DataFrame:
    """Centroids ``(zone_id, cx, cy)`` in ``crs`` to ``(locationid, lat, lon)``.

    ``crs``: ``EPSG:326zz`` / ``EPSG:327zz`` (UTM), ``EPSG:2263`` (New York
    Long Island, US feet) or ``EPSG:4326`` (passes through).
    """
    if crs == "EPSG:4326":
        lat, lon = F.col("cy"), F.col("cx")
    elif crs == "EPSG:2263":
        lat, lon = lcc_inverse("cx", "cy", NY_LONG_ISLAND_FTUS)
    elif crs.startswith("EPSG:326") or crs.startswith("EPSG:327"):
        zone = int(crs[-2:])
        lat, lon = utm_inverse("cx", "cy", F.lit(zone), F.lit(crs.startswith("EPSG:327")))
    else:
        raise ValueError(f"unsupported CRS {crs!r}")
    return centroids.select(F.col("zone_id").alias("locationid"), lat.alias("lat"), lon.alias("lon"))
