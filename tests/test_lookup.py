import pytest

from waybatch.functions.geo import NY_LONG_ISLAND_FTUS
from waybatch.operators import lookup


def _ring(zone, ring, pts):
    pts = list(pts) + [pts[0]]
    return [(zone, ring, i, float(x), float(y)) for i, (x, y) in enumerate(pts)]


def test_centroid_square_hole_and_zero_area(spark):
    rows = _ring(1, 0, [(0, 0), (4, 0), (4, 4), (0, 4)])                      # square, centroid (2, 2)
    rows += _ring(2, 0, [(0, 0), (10, 0), (10, 10), (0, 10)])                 # square with a hole
    rows += _ring(2, 1, [(6, 6), (6, 9), (9, 9), (9, 6)])                     # hole winds the other way
    rows += _ring(3, 0, [(0, 0), (1, 1), (2, 2)])                             # degenerate: zero area
    df = spark.createDataFrame(rows, "zone_id int, ring int, seq int, x double, y double")
    got = {r.zone_id: (r.cx, r.cy) for r in lookup.zone_centroid(df).collect()}
    assert got[1] == (2.0, 2.0)
    # (100 * 5 - 9 * 7.5) / 91
    assert got[2] == (round((500 - 67.5) / 91, 3), round((500 - 67.5) / 91, 3))
    assert got[3] == (None, None)


def test_centroid_to_wgs84_paths(spark):
    x, y = NY_LONG_ISLAND_FTUS.forward_py(-73.98, 40.75)
    df = spark.createDataFrame([(1, x, y)], "zone_id int, cx double, cy double")
    r = lookup.centroid_to_wgs84(df, "EPSG:2263").first()
    assert abs(r.lat - 40.75) < 1e-7 and abs(r.lon + 73.98) < 1e-7
    r = lookup.centroid_to_wgs84(spark.createDataFrame([(1, -73.98, 40.75)], "zone_id int, cx double, cy double"), "EPSG:4326").first()
    assert (r.locationid, r.lat, r.lon) == (1, 40.75, -73.98)
    with pytest.raises(ValueError):
        lookup.centroid_to_wgs84(df, "EPSG:3857")


def test_zone_lookup_default_and_unknown(spark):
    trips = spark.createDataFrame([(1, 2), (999, 2), (2, None)], "PULocationID int, DOLocationID int")
    zones = spark.createDataFrame([(1, 40.75, -73.98), (2, 40.76, -73.99), (5, None, None)], "locationid int, lat double, lon double")
    got = [tuple(r) for r in lookup.zone_lookup(trips, zones).select(
        "PULocationID", "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon").orderBy("PULocationID").collect()]
    assert got == [(1, 40.75, -73.98, 40.76, -73.99), (2, 40.76, -73.99, 40.75, -73.98), (999, 40.75, -73.98, 40.76, -73.99)]
    unk = {(r.locationid, r.role): r.n_trips for r in lookup.unknown_zones(trips, zones).collect()}
    assert unk == {(999, "pickup"): 1, (None, "dropoff"): 1}


def test_a_zone_listed_twice_keeps_the_rows(spark):
    trips = spark.createDataFrame([(1, 56, 56), (2, 56, 7), (3, None, 99)], "trip_id int, p int, d int")
    zones = spark.createDataFrame([(56, 1.0, 1.0, 0), (56, 2.0, -2.0, 1), (56, None, 3.0, 2), (7, 5.0, 5.0, 3)], "locationid int, lat double, lon double, entry int")
    got = {r.trip_id: (r.pickup_lat, r.pickup_lon, r.dropoff_lat) for r in lookup.zone_lookup(trips, zones, "p", "d", (0.0, 0.5)).collect()}
    assert got == {1: (2.0, -2.0, 2.0), 2: (2.0, -2.0, 5.0), 3: (0.0, 0.5, 0.0)}
    unordered = lookup.zone_lookup(trips, zones.drop("entry"), "p", "d")
    assert unordered.count() == 3 and unordered.filter("trip_id = 1").first().pickup_lat == 2.0


WKT = [
    (1, "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))"),
    (2, "polygon((0 0, 0 10, 10 10, 10 0, 0 0), (6 6, 6 9, 9 9, 9 6, 6 6))"),   # outer ring clockwise, hole too
    (3, "MULTIPOLYGON (((0 0, 2 0, 2 2, 0 2, 0 0)), ((10 0, 10 2, 12 2, 12 0, 10 0)))"),
    (4, "POLYGON Z ((0 0 7, 3 0 7, 0 3 7))"),                                   # not closed, third coordinate
    (5, None), (6, ""), (7, "POLYGON EMPTY"), (8, "LINESTRING (0 0, 1 1)"), (9, "POLYGON ((0 0, a 1, 1 1, 0 0))"),
    (10, "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))"), (10, "POLYGON ((4 0, 6 0, 6 2, 4 2, 4 0))"),  # a zone in two rows
    (11, "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))"), (11, "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))"),  # a repeated row
    (12, "POLYGON ((5 5))"), (13, "POLYGON ((1 1, 1 1, 1 1))"),
]


def test_polygon_text_to_centroids(spark):
    zones = spark.createDataFrame([(z, w, 0.5, "r") for z, w in WKT], "zone_id int, wkt string, x double, ring string")
    v = lookup.polygon_vertices(zones)
    got = {r.zone_id: (r.cx, r.cy) for r in lookup.zone_centroid(v).collect()}
    hole = round((500 - 67.5) / 91, 3)
    assert got == {1: (2.0, 2.0), 2: (hole, hole), 3: (6.0, 1.0), 4: (1.0, 1.0), 10: (3.0, 1.0), 11: (1.0, 1.0),
                   13: (None, None)}  # 12 has no edge at all
    assert lookup.polygon_vertices(zones.limit(0)).count() == 0


def test_a_long_ring_and_a_polygon_file(spark, tmp_dir):
    import math

    from waybatch.sources.files import read_zone_polygons

    n = 50_000
    ring = [f"{5 + 3 * math.cos(2 * math.pi * i / n):.9f} {7 + 3 * math.sin(2 * math.pi * i / n):.9f}" for i in range(n)]
    spark.createDataFrame([(1, f"POLYGON (({', '.join(ring + ring[:1])}))")], "zone_id int, wkt string").write.parquet(f"{tmp_dir}/z")
    v = read_zone_polygons(spark, f"{tmp_dir}/z")
    assert v.count() == n + 1
    assert tuple(lookup.zone_centroid(v).first()) == (1, 5.0, 7.0)


def test_centroid_sums_do_not_depend_on_order_or_place(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    rows, near = [], []
    for z in range(12):
        angle = np.sort(rng.uniform(0, 2 * np.pi, 900))
        far = 0.0 if z % 2 else 6.0e6
        pts = list(zip(np.cos(angle) * rng.uniform(90, 110, 900), np.sin(angle) * 100))
        rows += _ring(z, 0, [(far + round(x, 3), far + round(y, 3)) for x, y in pts])
        near += _ring(z, 0, [(round(x, 3), round(y, 3)) for x, y in pts])
    schema = "zone_id int, ring int, seq int, x double, y double"
    results = []
    for parts, order in ((1, 1), (7, -1), (200, 1)):
        spark.conf.set("spark.sql.shuffle.partitions", str(min(parts, 40)))
        df = spark.createDataFrame(rows[::order], schema).repartition(parts)
        results.append({r.zone_id: (r.cx, r.cy) for r in lookup.zone_centroid(df, decimals=9).collect()})
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]
    base = {r.zone_id: (r.cx, r.cy) for r in lookup.zone_centroid(spark.createDataFrame(near, schema), decimals=9).collect()}
    for z, (x, y) in results[0].items():
        far = 0.0 if z % 2 else 6.0e6
        assert abs(x - far - base[z][0]) < 1e-8 and abs(y - far - base[z][1]) < 1e-8


def test_centroid_of_degrees_keeps_its_digits(spark):
    df = spark.createDataFrame(_ring(1, 0, [(-73.98, 40.75), (-73.97, 40.75), (-73.97, 40.76), (-73.98, 40.76)]), "zone_id int, ring int, seq int, x double, y double")
    r = lookup.zone_centroid(df, decimals=8).first()
    assert (r.cx, r.cy) == (-73.975, 40.755)
