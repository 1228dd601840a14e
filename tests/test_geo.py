import math

import pytest
from pyspark.sql import functions as F

from waybatch.functions import geo
from waybatch.functions.geo import (
    NY_LONG_ISLAND_FTUS, lcc_inverse, utm_crs, utm_forward, utm_inverse, utm_south, utm_zone, wkt_point,
)


def _utm_reference(lon, lat, zone, south=False):
    """Sixth-order Krueger series in plain Python, an independent check."""
    a, f = 6378137.0, 1 / 298.257223563
    n = f / (2 - f)
    A = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64 + n**6 / 256)
    al = [
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180 - 127 * n**5 / 288 + 7891 * n**6 / 37800,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440 + 281 * n**5 / 630 - 1983433 * n**6 / 1935360,
        61 * n**3 / 240 - 103 * n**4 / 140 + 15061 * n**5 / 26880 + 167603 * n**6 / 181440,
        49561 * n**4 / 161280 - 179 * n**5 / 168 + 6601661 * n**6 / 7257600,
        34729 * n**5 / 80640 - 3418889 * n**6 / 1995840,
        212378941 * n**6 / 319334400,
    ]
    e = math.sqrt(f * (2 - f))
    phi, lam = math.radians(lat), math.radians(lon - (zone * 6 - 183))
    t = math.sinh(math.atanh(math.sin(phi)) - e * math.atanh(e * math.sin(phi)))
    xi1, eta1 = math.atan2(t, math.cos(lam)), math.atanh(math.sin(lam) / math.sqrt(1 + t * t))
    xi = xi1 + sum(al[j] * math.sin(2 * (j + 1) * xi1) * math.cosh(2 * (j + 1) * eta1) for j in range(6))
    eta = eta1 + sum(al[j] * math.cos(2 * (j + 1) * xi1) * math.sinh(2 * (j + 1) * eta1) for j in range(6))
    return 500000 + 0.9996 * A * eta, (10000000 if south else 0) + 0.9996 * A * xi


def test_utm_zone_and_crs(spark):
    rows = [(-74.006, 40.7128), (180.0, 10.0), (-180.0, -33.9), (151.2, -33.87), (3.0, 0.0)]
    df = spark.createDataFrame(rows, "lon double, lat double")
    out = df.select(utm_zone("lon").alias("z"), utm_crs("lon", "lat").alias("c")).collect()
    assert [(r.z, r.c) for r in out] == [
        (18, "EPSG:32618"), (61, "EPSG:32661"), (1, "EPSG:32701"), (56, "EPSG:32756"), (31, "EPSG:32631"),
    ]


@pytest.mark.parametrize("lon,lat", [(-74.0060, 40.7128), (-73.7, 40.5), (151.2093, -33.8688), (2.35, 48.85), (-77.9, 0.1)])
def test_utm_forward_matches_sixth_order(spark, lon, lat):
    df = spark.createDataFrame([(lon, lat)], "lon double, lat double")
    z = utm_zone("lon")
    e, n = utm_forward("lon", "lat", z, utm_south("lat"))
    r = df.select(z.alias("z"), e.alias("e"), n.alias("n")).first()
    re, rn = _utm_reference(lon, lat, r.z, lat < 0)
    assert abs(r.e - re) < 0.002 and abs(r.n - rn) < 0.002


def test_utm_new_york_value(spark):
    df = spark.createDataFrame([(-74.0060, 40.7128)], "lon double, lat double")
    e, n = utm_forward("lon", "lat", F.lit(18), F.lit(False))
    r = df.select(e.alias("e"), n.alias("n")).first()
    assert abs(r.e - 583959.372) < 0.002 and abs(r.n - 4507350.998) < 0.002


def test_utm_roundtrip(spark):
    pts = [(-74.0060, 40.7128), (-75.9, 45.0), (151.2093, -33.8688), (-72.1, -10.0)]
    df = spark.createDataFrame(pts, "lon double, lat double")
    z, s = utm_zone("lon"), utm_south("lat")
    e, n = utm_forward("lon", "lat", z, s)
    df = df.select("lon", "lat", z.alias("z"), s.alias("s"), e.alias("e"), n.alias("n"))
    lat2, lon2 = utm_inverse("e", "n", "z", "s")
    for r in df.select("lon", "lat", lat2.alias("lat2"), lon2.alias("lon2")).collect():
        assert abs(r.lat - r.lat2) < 2e-8 and abs(r.lon - r.lon2) < 2e-8


def test_lcc_inverse_roundtrip(spark):
    pts = [(-74.0060, 40.7128), (-73.78, 40.64), (-74.17, 40.58), (-73.9, 40.87)]
    xy = [NY_LONG_ISLAND_FTUS.forward_py(lon, lat) + (lon, lat) for lon, lat in pts]
    df = spark.createDataFrame(xy, "x double, y double, lon double, lat double")
    lat2, lon2 = lcc_inverse("x", "y")
    for r in df.select("lon", "lat", lat2.alias("lat2"), lon2.alias("lon2")).collect():
        assert abs(r.lat - r.lat2) < 1e-7 and abs(r.lon - r.lon2) < 1e-7
    # the origin maps to the false easting (984250 US feet) and 0
    x0, y0 = NY_LONG_ISLAND_FTUS.forward_py(-74.0, 40.0 + 10 / 60)
    assert abs(x0 - 984250.0) < 1e-6 and abs(y0) < 1e-6


def test_wkt_text(spark):
    rows = [(-74.0, 40.0), (0.0005, -0.00001), (-74.006, 40.7128), (None, 1.0)]
    df = spark.createDataFrame(rows, "lon double, lat double")
    got = [r.g for r in df.select(wkt_point("lon", "lat").alias("g")).collect()]
    assert got == ["POINT (-74 40)", "POINT (0.0005 -0.00001)", "POINT (-74.006 40.7128)", None]


def test_constants_are_fixed():
    assert geo.UTM_K0 == 0.9996 and geo.WGS84_A == 6378137.0


def test_points_in_the_crs_of_their_row(spark):
    x, y = geo.NY_LONG_ISLAND_FTUS.forward_py(-73.98, 40.75)
    places = [(-73.98, 40.75, 18, False), (151.2, -33.9, 56, True), (179.9, 10.0, 60, False)]
    df = spark.createDataFrame(places, "lon double, lat double, zone int, south boolean")
    e, n = geo.utm_forward("lon", "lat", "zone", "south")
    code = F.format_string("EPSG:%d%02d", F.when(F.col("south"), 327).otherwise(326), F.col("zone"))
    rows = [tuple(r) for r in df.select(e, n, code, "lon", "lat").collect()]
    rows += [(x, y, "EPSG:2263", -73.98, 40.75), (-73.98, 40.75, "EPSG:4326", -73.98, 40.75), (1.5, 2.5, None, 1.5, 2.5)]
    out = spark.createDataFrame(rows, "x double, y double, code string, lon double, lat double")
    lat, lon = geo.point_to_wgs84("x", "y", "code")
    for r in out.select(lat.alias("la"), lon.alias("lo"), "lat", "lon").collect():
        assert abs(r.la - r.lat) < 2e-8 and abs(r.lo - r.lon) < 2e-8
    texts = [("POINT (585000 4511000)", "EPSG:32618"), ("POINT (-74 40.7)", "EPSG:4326"), (None, "EPSG:32618"),
             ("LINESTRING (0 0, 1 1)", "EPSG:32618"), ("POINT (-74 40.7)", None)]
    got = [r[0] for r in spark.createDataFrame(texts, "g string, c string").select(geo.wkt_point_to_wgs84("g", "c")).collect()]
    assert got[0].startswith("POINT (-73.99") and got[1:] == ["POINT (-74 40.7)", None, "LINESTRING (0 0, 1 1)", "POINT (-74 40.7)"]
    with pytest.raises(Exception, match="unsupported CRS EPSG:3857"):
        spark.createDataFrame([("POINT (1 2)", "EPSG:3857")], "g string, c string").select(geo.wkt_point_to_wgs84("g", "c")).collect()


def test_texts_of_a_table_are_converted_in_steps(spark):
    x, y = geo.NY_LONG_ISLAND_FTUS.forward_py(-73.98, 40.75)
    texts = ["POINT (585000.123 4511000.5)", f"POINT ({x} {y})", "POINT Z (-74 40.7 3)", "point (1 2)", "POINT (1 x)", "POINT (NaN 1)",
             "POINT (1e300 4511000)", "POINT EMPTY", "LINESTRING (0 0, 1 1)", "", None]
    codes = ["EPSG:32618", "EPSG:32761", "EPSG:32600", "EPSG:2263", "EPSG:4326", None]
    rows = [(i, g, c) for i, (g, c) in enumerate((g, c) for g in texts for c in codes)]
    rows += [(1000, None, "EPSG:3857"), (1001, "POINT EMPTY", "EPSG:3857"), (1002, None, None)]
    df = spark.createDataFrame(rows, "id long, geometry string, crs string").repartition(3)
    got = geo.with_wkt_in_wgs84(df, "geometry", "crs")
    assert got.columns == df.columns
    want = df.select("id", geo.wkt_point_to_wgs84("geometry", "crs").alias("geometry"), "crs")
    assert sorted(got.collect()) == sorted(want.collect())
    assert got.filter("id in (0, 9)").orderBy("id").collect()[1].geometry == "POINT (-73.98 40.75)"
    # in both forms a code that isn't known is an error as soon as there is a point
    bad = spark.createDataFrame([(1, "POINT (1 2)", "EPSG:3857")], df.schema).repartition(2)
    with pytest.raises(Exception, match="unsupported CRS EPSG:3857"):
        geo.with_wkt_in_wgs84(bad, "geometry", "crs").collect()
