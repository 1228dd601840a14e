"""Points, WKT, UTM and Lambert conformal conic projections as Column
expressions.

Projected coordinates are rounded to millimetres. Distances computed from
them only use subtraction, multiplication and a square root, which are
exactly rounded in IEEE arithmetic, so every engine and the pandas walk
see the same distances and break ties the same way.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# WGS 84 ellipsoid and the UTM grid.
WGS84_A = 6378137.0
WGS84_INV_F = 298.257223563
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_FALSE_NORTHING_SOUTH = 10000000.0
PROJECTED_DECIMALS = 3
GEOGRAPHIC_DECIMALS = 8
DEG_TO_RAD = math.pi / 180.0
RAD_TO_DEG = 180.0 / math.pi


def _krueger_coefficients(inv_f: float):
    """Third-order Krueger series (Karney 2011) for a given flattening."""
    f = 1.0 / inv_f
    n = f / (2.0 - f)
    big_a = WGS84_A / (1.0 + n) * (1.0 + n**2 / 4.0 + n**4 / 64.0)
    alpha = (
        n / 2.0 - 2.0 * n**2 / 3.0 + 5.0 * n**3 / 16.0,
        13.0 * n**2 / 48.0 - 3.0 * n**3 / 5.0,
        61.0 * n**3 / 240.0,
    )
    beta = (
        n / 2.0 - 2.0 * n**2 / 3.0 + 37.0 * n**3 / 96.0,
        n**2 / 48.0 + n**3 / 15.0,
        17.0 * n**3 / 480.0,
    )
    delta = (
        2.0 * n - 2.0 * n**2 / 3.0 - 2.0 * n**3,
        7.0 * n**2 / 3.0 - 8.0 * n**3 / 5.0,
        56.0 * n**3 / 15.0,
    )
    ecc = 2.0 * math.sqrt(n) / (1.0 + n)
    return UTM_K0 * big_a, alpha, beta, delta, ecc


UTM_KA, UTM_ALPHA, UTM_BETA, UTM_DELTA, UTM_E = _krueger_coefficients(WGS84_INV_F)


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


#: Takes values that a formula uses several times, and returns what to use for them.
Keep = Callable[..., tuple[Column, ...]]


def _in_place(**values: Column) -> tuple[Column, ...]:
    """Each use repeats the expression. Spark evaluates it once where the whole
    result is always needed, but not inside ``CASE``."""
    return tuple(values.values())


class _Steps:
    """Each value becomes a column of ``df``, in a projection of its own, and is evaluated once a row."""

    def __init__(self, df: DataFrame):
        self.df, self.added = df, []

    def __call__(self, **values: Column) -> tuple[Column, ...]:
        named = {f"_wb_{len(self.added) + i}_{k}": c for i, (k, c) in enumerate(values.items())}
        self.df = self.df.withColumns(named)
        self.added += named
        return tuple(F.col(c) for c in named)


def utm_zone(lon) -> Column:
    """``int((lon + 180) / 6) + 1``; lon = 180 gives 61, as studied."""
    return (F.floor((_col(lon) + F.lit(180.0)) / F.lit(6.0)) + F.lit(1)).cast("int")


def utm_south(lat) -> Column:
    return _col(lat) < F.lit(0.0)


def utm_crs(lon, lat) -> Column:
    """``EPSG:326zz`` north of the equator (lat >= 0), ``EPSG:327zz`` south."""
    prefix = F.when(_col(lat) >= F.lit(0.0), F.lit("EPSG:326")).otherwise(F.lit("EPSG:327"))
    return F.concat(prefix, F.lpad(utm_zone(lon).cast("string"), 2, "0"))


def projection_zone(zone) -> Column:
    """Zone used for the projection: the CRS code keeps 61, the math clamps to 60."""
    return F.least(_col(zone), F.lit(60))


def utm_forward(lon, lat, zone, south) -> tuple[Column, Column]:
    """(easting, northing) in metres, rounded to millimetres."""
    lon, lat = _col(lon), _col(lat)
    lam0 = (projection_zone(zone) * F.lit(6.0) - F.lit(183.0)) * F.lit(DEG_TO_RAD)
    phi = lat * F.lit(DEG_TO_RAD)
    dlam = lon * F.lit(DEG_TO_RAD) - lam0
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - F.lit(UTM_E) * F.atanh(F.lit(UTM_E) * s))
    xi1 = F.atan2(t, F.cos(dlam))
    eta1 = F.atanh(F.sin(dlam) / F.sqrt(F.lit(1.0) + t * t))
    xi, eta = xi1, eta1
    for j, a in enumerate(UTM_ALPHA, start=1):
        k = F.lit(2.0 * j)
        xi = xi + F.lit(a) * F.sin(k * xi1) * F.cosh(k * eta1)
        eta = eta + F.lit(a) * F.cos(k * xi1) * F.sinh(k * eta1)
    easting = F.lit(UTM_FALSE_EASTING) + F.lit(UTM_KA) * eta
    northing = F.lit(UTM_KA) * xi
    northing = F.when(_col(south), F.lit(UTM_FALSE_NORTHING_SOUTH) + northing).otherwise(northing)
    return F.round(easting, PROJECTED_DECIMALS), F.round(northing, PROJECTED_DECIMALS)


def utm_inverse(easting, northing, zone, south, keep: Keep = _in_place) -> tuple[Column, Column]:
    """(lat, lon) in degrees from UTM metres, rounded to 1e-8 degree."""
    e, n = _col(easting), _col(northing)
    n = F.when(_col(south), n - F.lit(UTM_FALSE_NORTHING_SOUTH)).otherwise(n)
    xi, eta = keep(xi=n / F.lit(UTM_KA), eta=(e - F.lit(UTM_FALSE_EASTING)) / F.lit(UTM_KA))
    xi1, eta1 = xi, eta
    for j, b in enumerate(UTM_BETA, start=1):
        k = F.lit(2.0 * j)
        xi1 = xi1 - F.lit(b) * F.sin(k * xi) * F.cosh(k * eta)
        eta1 = eta1 - F.lit(b) * F.cos(k * xi) * F.sinh(k * eta)
    xi1, eta1 = keep(xi1=xi1, eta1=eta1)
    (chi,) = keep(chi=F.asin(F.sin(xi1) / F.cosh(eta1)))
    phi = chi
    for j, d in enumerate(UTM_DELTA, start=1):
        phi = phi + F.lit(d) * F.sin(F.lit(2.0 * j) * chi)
    lam0 = (projection_zone(zone) * F.lit(6.0) - F.lit(183.0)) * F.lit(DEG_TO_RAD)
    lam = lam0 + F.atan2(F.sinh(eta1), F.cos(xi1))
    return (
        F.round(phi * F.lit(RAD_TO_DEG), GEOGRAPHIC_DECIMALS),
        F.round(lam * F.lit(RAD_TO_DEG), GEOGRAPHIC_DECIMALS),
    )


@dataclass(frozen=True)
class LambertConic:
    """Lambert conformal conic, two standard parallels (Snyder 1987, ch. 15)."""

    lat1: float
    lat2: float
    lat0: float
    lon0: float
    false_easting_m: float
    false_northing_m: float
    unit_m: float
    a: float
    inv_f: float

    def constants(self):
        f = 1.0 / self.inv_f
        e2 = f * (2.0 - f)
        e = math.sqrt(e2)

        def m(phi):
            return math.cos(phi) / math.sqrt(1.0 - e2 * math.sin(phi) ** 2)

        def t(phi):
            es = e * math.sin(phi)
            return math.tan(math.pi / 4.0 - phi / 2.0) / ((1.0 - es) / (1.0 + es)) ** (e / 2.0)

        p1, p2, p0 = (math.radians(v) for v in (self.lat1, self.lat2, self.lat0))
        n = (math.log(m(p1)) - math.log(m(p2))) / (math.log(t(p1)) - math.log(t(p2)))
        big_f = m(p1) / (n * t(p1) ** n)
        rho0 = self.a * big_f * t(p0) ** n
        return e, e2, n, big_f, rho0

    def forward_py(self, lon: float, lat: float) -> tuple[float, float]:
        """Plain-Python forward projection, used to check the inverse."""
        e, _e2, n, big_f, rho0 = self.constants()
        phi = math.radians(lat)
        es = e * math.sin(phi)
        t = math.tan(math.pi / 4.0 - phi / 2.0) / ((1.0 - es) / (1.0 + es)) ** (e / 2.0)
        rho = self.a * big_f * t**n
        theta = n * math.radians(lon - self.lon0)
        x = self.false_easting_m + rho * math.sin(theta)
        y = self.false_northing_m + rho0 - rho * math.cos(theta)
        return x / self.unit_m, y / self.unit_m


# NAD83 / New York Long Island (US survey feet), the CRS of
# the public taxi zone polygons. NAD83 is taken as WGS 84 (under 2 m here).
NY_LONG_ISLAND_FTUS = LambertConic(
    lat1=41.0 + 2.0 / 60.0,
    lat2=40.0 + 40.0 / 60.0,
    lat0=40.0 + 10.0 / 60.0,
    lon0=-74.0,
    false_easting_m=300000.0,
    false_northing_m=0.0,
    unit_m=1200.0 / 3937.0,
    a=6378137.0,
    inv_f=298.257222101,
)


def lcc_inverse(x, y, proj: LambertConic = NY_LONG_ISLAND_FTUS, keep: Keep = _in_place) -> tuple[Column, Column]:
    """(lat, lon) in degrees from Lambert conformal conic coordinates.

    Latitude comes from the conformal latitude by its series in e^2, so
    there is no iteration in the expression.
    """
    e, e2, n, big_f, rho0 = proj.constants()
    xm = _col(x) * F.lit(proj.unit_m) - F.lit(proj.false_easting_m)
    ym = F.lit(rho0) - (_col(y) * F.lit(proj.unit_m) - F.lit(proj.false_northing_m))
    xm, ym = keep(xm=xm, ym=ym)
    sign = 1.0 if n > 0 else -1.0
    rho = F.lit(sign) * F.sqrt(xm * xm + ym * ym)
    theta = F.atan2(F.lit(sign) * xm, F.lit(sign) * ym)
    t = F.pow(rho / F.lit(proj.a * big_f), F.lit(1.0 / n))
    (chi,) = keep(chi=F.lit(math.pi / 2.0) - F.lit(2.0) * F.atan(t))
    e4, e6, e8 = e2 * e2, e2**3, e2**4
    c2 = e2 / 2 + 5 * e4 / 24 + e6 / 12 + 13 * e8 / 360
    c4 = 7 * e4 / 48 + 29 * e6 / 240 + 811 * e8 / 11520
    c6 = 7 * e6 / 120 + 81 * e8 / 1120
    c8 = 4279 * e8 / 161280
    phi = chi
    for k, c in ((2.0, c2), (4.0, c4), (6.0, c6), (8.0, c8)):
        phi = phi + F.lit(c) * F.sin(F.lit(k) * chi)
    lon = theta / F.lit(n) * F.lit(RAD_TO_DEG) + F.lit(proj.lon0)
    return (
        F.round(phi * F.lit(RAD_TO_DEG), GEOGRAPHIC_DECIMALS),
        F.round(lon, GEOGRAPHIC_DECIMALS),
    )


def planar_distance(x1, y1, x2, y2) -> Column:
    """Euclidean distance in the plane of the coordinates."""
    dx = _col(x2) - _col(x1)
    dy = _col(y2) - _col(y1)
    return F.sqrt(dx * dx + dy * dy)


def wkt_number(x) -> Column:
    """Plain decimal text of a coordinate: no exponent, no trailing zeros."""
    text = _col(x).try_cast("decimal(18,10)").cast("string")  # out of range: null
    return F.regexp_replace(text, r"\.?0+$", "")


def wkt_point(lon, lat) -> Column:
    """``POINT (lon lat)``; null if either coordinate is null."""
    return F.concat(F.lit("POINT ("), wkt_number(lon), F.lit(" "), wkt_number(lat), F.lit(")"))


def is_wkt_point(geometry) -> Column:
    return F.coalesce(_col(geometry).rlike(r"^POINT \("), F.lit(False))


def point_to_wgs84(x, y, crs, keep: Keep = _in_place) -> tuple[Column, Column]:
    """(lat, lon) in degrees of a point in the CRS that each row names.

    ``EPSG:326zz`` / ``EPSG:327zz`` (UTM) and ``EPSG:2263`` (US feet) are
    converted, ``EPSG:4326`` and null pass. Any other code is an error: a
    point must not be taken for degrees that it isn't."""
    x, y, code = _col(x), _col(y), _col(crs)
    utm, feet = keep(utm=code.rlike("^EPSG:32[67][0-9]{2}$"), feet=code == F.lit("EPSG:2263"))
    # null for rows of another CRS, whose formulas then cost nothing
    utm_lat, utm_lon = utm_inverse(
        F.when(utm, x), F.when(utm, y), F.substring(code, 9, 2).try_cast("int"), code.startswith("EPSG:327"), keep)
    feet_lat, feet_lon = lcc_inverse(F.when(feet, x), F.when(feet, y), NY_LONG_ISLAND_FTUS, keep)
    unknown = F.raise_error(F.concat(F.lit("unsupported CRS "), code)).cast("double")

    def pick(projected, in_feet, degrees):
        passes = code.isNull() | (code == F.lit("EPSG:4326"))
        return (F.when(passes, degrees).when(utm, projected).when(feet, in_feet).otherwise(unknown))

    return pick(utm_lat, feet_lat, y), pick(utm_lon, feet_lon, x)


_WKT_POINT = r"^\s*POINT\s*(?:ZM?\s*|M\s*)?\(\s*(\S+)\s+([^\s()]+)"


def wkt_point_to_wgs84(geometry, crs, keep: Keep = _in_place) -> Column:
    """``POINT`` text in the row's CRS as ``POINT (lon lat)``; other text stays as it is.
    For tables of many rows: :func:`with_wkt_in_wgs84`."""
    g = _col(geometry)
    x, y = keep(**{c: F.regexp_extract(g, _WKT_POINT, k).try_cast("double") for c, k in (("x", 1), ("y", 2))})
    lat, lon = point_to_wgs84(x, y, crs, keep)
    known = _col(crs).isNotNull() & (_col(crs) != F.lit("EPSG:4326")) & x.isNotNull() & y.isNotNull()
    return F.when(known, wkt_point(lon, lat)).otherwise(g)


def with_wkt_in_wgs84(df: DataFrame, geometry: str, crs: str) -> DataFrame:
    """``df`` with its column ``geometry`` as :func:`wkt_point_to_wgs84` gives it. The text is parsed once a
    row, and each value that the series use several times is a column of a projection below them."""
    steps = _Steps(df)
    converted = wkt_point_to_wgs84(geometry, crs, steps)
    return steps.df.withColumn(geometry, converted).drop(*steps.added)


def wkt_rings(wkt) -> Column:
    """Rings of ``POLYGON`` or ``MULTIPOLYGON`` text as
    ``array<struct<hole boolean, points array<struct<x double, y double>>>>``.

    Rings come closed, outer ones counterclockwise and holes clockwise,
    however they were written, so signed sums take holes off. A third
    coordinate is ignored. Null, empty polygons, other geometry and text with
    a coordinate that is no number give null."""
    text = _col(wkt)
    # a ring with a parenthesis before it opens a polygon; the rings after it are its holes
    rings = F.regexp_extract_all(text, F.lit(r"((?:\(\s*)?\([^()]*\))"), F.lit(1))

    def point(pair):
        parts = F.split(F.trim(pair), r"\s+")
        return F.struct(F.get(parts, F.lit(0)).try_cast("double").alias("x"), F.get(parts, F.lit(1)).try_cast("double").alias("y"))

    def ring(r):
        body = F.regexp_replace(r, r"[()]", "")
        return F.struct((~r.rlike(r"^\(\s*\(")).alias("hole"), F.transform(F.split(body, ","), point).alias("points"))

    def closed(r):
        p = r["points"]
        first, last = F.get(p, F.lit(0)), F.get(p, F.size(p) - F.lit(1))
        return F.struct(r["hole"].alias("hole"), F.when(first == last, p).otherwise(F.concat(p, F.array(first))).alias("points"))

    def wound(r):
        p = r["points"]
        x0, y0 = p[0]["x"], p[0]["y"]  # about the first point: no digits lost far from the origin
        after = F.slice(p, F.lit(2), F.size(p) - F.lit(1))
        before = F.slice(p, F.lit(1), F.size(p) - F.lit(1))
        cross = F.zip_with(before, after, lambda a, b: (a["x"] - x0) * (b["y"] - y0) - (b["x"] - x0) * (a["y"] - y0))
        area = F.aggregate(cross, F.lit(0.0), lambda acc, c: acc + c)
        turn = F.when(r["hole"], area > F.lit(0.0)).otherwise(area < F.lit(0.0))
        return F.struct(r["hole"].alias("hole"), F.when(turn, F.reverse(p)).otherwise(p).alias("points"))

    parsed = F.transform(rings, ring)
    numbers = F.forall(parsed, lambda r: F.forall(r["points"], lambda p: p["x"].isNotNull() & p["y"].isNotNull() & ~F.isnan(p["x"]) & ~F.isnan(p["y"])))
    is_polygon = text.rlike(r"(?i)^\s*(MULTI)?POLYGON\b") & (F.size(parsed) > F.lit(0))
    return F.when(is_polygon & numbers, F.transform(F.transform(parsed, closed), wound))
