"""Reference SQL for every registered query, run by DuckDB on the same
Parquet tables (the driver registers the base tables as views).

The fixture views are inlined as CTEs. Constants are written in exponent
form so DuckDB reads them as DOUBLE (a plain ``0.9996`` is a DECIMAL
there). The projection formulas repeat the operation order of
``waybatch.functions.geo`` so both engines round to the same millimetre.
"""

from __future__ import annotations

from waybatch.schema import NULL_TOKENS


def L(x: float) -> str:
    """A DOUBLE literal that both engines parse to the same value."""
    return format(float(x), ".17e")


# Transverse Mercator on WGS 84, Krueger series of third order,
# written out here so that a wrong coefficient in the library shows.
DEG_TO_RAD = 0.017453292519943295
RAD_TO_DEG = 57.29577951308232
UTM_E = 0.08181919084262149
UTM_KA = 6364902.166165086
UTM_FALSE_EASTING = 500000.0
UTM_FALSE_NORTHING_SOUTH = 10000000.0
UTM_ALPHA = (0.0008377318188192541, 7.608496958699166e-07, 1.2034877875966646e-09)
UTM_BETA = (0.000837732164082144, 5.906110863719917e-08, 1.6769911794379754e-10)
UTM_DELTA = (0.003356551448628875, 6.571913193172695e-06, 1.76774599620756e-08)

# ---------------------------------------------------------------- fixtures
FIXTURES = {
    "zones": """zones AS (
  SELECT n_nationkey AS locationid,
         CAST(40450 + 25*n_nationkey AS DOUBLE)/1000 AS lat,
         CAST(-74350 + 30*((n_nationkey*7)%25) AS DOUBLE)/1000 AS lon
  FROM nation WHERE n_nationkey < 24)""",
    "trips": """trips AS (
  SELECT o_orderkey AS trip_id, o_orderdate AS tpep_pickup_datetime,
         c_nationkey AS pulocationid,
         CAST((o_orderkey*7+3)%26 AS INTEGER) AS dolocationid
  FROM orders JOIN customer ON o_custkey = c_custkey)""",
    "deliveries": """deliveries AS (
  SELECT trip_id + 1 AS delivery_id,
         COALESCE(p.lat, CAST(4075 AS DOUBLE)/100) + CAST((trip_id*37)%1000 AS DOUBLE)/100000 AS pickup_lat,
         COALESCE(p.lon, CAST(-7398 AS DOUBLE)/100) + CAST((trip_id*53)%1000 AS DOUBLE)/100000 AS pickup_lon,
         COALESCE(d.lat, CAST(4075 AS DOUBLE)/100) + CAST((trip_id*71)%1000 AS DOUBLE)/100000 AS dropoff_lat,
         COALESCE(d.lon, CAST(-7398 AS DOUBLE)/100) + CAST((trip_id*89)%1000 AS DOUBLE)/100000 AS dropoff_lon,
         tpep_pickup_datetime AS "timestamp"
  FROM trips LEFT JOIN zones p ON pulocationid = p.locationid
             LEFT JOIN zones d ON dolocationid = d.locationid)""",
    "deliveries_dup": """deliveries_dup AS (
  SELECT CASE WHEN delivery_id % 10 = 0 THEN delivery_id - 1 ELSE delivery_id END AS delivery_id,
         delivery_id AS row_no, pickup_lat, pickup_lon, dropoff_lat, dropoff_lon, "timestamp"
  FROM deliveries)""",
    "deliveries_far_dup": """deliveries_far_dup AS (
  SELECT (delivery_id - 1) % 500 + 1 AS delivery_id,
         delivery_id AS row_no, pickup_lat, pickup_lon, dropoff_lat, dropoff_lon, "timestamp"
  FROM deliveries)""",
    "zone_vertices": """zone_vertices AS (
  SELECT n_nationkey AS zone_id, 0 AS ring, seq,
         CAST(560000 + 1500*n_nationkey + CASE seq WHEN 1 THEN 1000 WHEN 2 THEN 500 ELSE 0 END AS DOUBLE) AS x,
         CAST(4490000 + 900*n_nationkey + CASE seq WHEN 2 THEN 1000 WHEN 3 THEN 1000 ELSE 0 END AS DOUBLE) AS y
  FROM nation CROSS JOIN (VALUES (0),(1),(2),(3),(4)) s(seq))""",
    "raw_text": """raw_text AS (
  SELECT CAST(delivery_id AS VARCHAR) AS delivery_id,
         CASE WHEN delivery_id % 101 = 0 THEN 'invalid' WHEN delivery_id % 103 = 0 THEN NULL
              WHEN delivery_id % 107 = 0 THEN '91' ELSE '40.7' END AS pickup_lat,
         CASE WHEN delivery_id % 109 = 0 THEN '181' ELSE '-74.0' END AS pickup_lon,
         '40.71' AS dropoff_lat, '-74.01' AS dropoff_lon,
         CASE WHEN delivery_id % 113 = 0 THEN 'not a date' ELSE '2025-02-20 10:00:00' END AS "timestamp"
  FROM deliveries)""",
}
_DEPS = {
    "trips": [],
    "zones": [],
    "deliveries": ["zones", "trips"],
    "deliveries_dup": ["deliveries"],
    "deliveries_far_dup": ["deliveries"],
    "zone_vertices": [],
    "raw_text": ["deliveries"],
}


def _closure(names):
    out: list[str] = []

    def visit(n):
        for d in _DEPS[n]:
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_fixtures(names, *ctes: str) -> str:
    """``WITH [RECURSIVE]`` clause holding the fixtures and extra CTEs."""
    parts = [FIXTURES[n] for n in _closure(names)] + list(ctes)
    return "WITH " + ",\n".join(parts) + "\n"


# ------------------------------------------------------- projection in SQL
def utm_zone_sql(lon: str) -> str:
    return f"CAST(floor(({lon} + {L(180)}) / {L(6)}) + 1 AS INTEGER)"


def utm_crs_sql(lon: str, lat: str) -> str:
    return (f"concat(CASE WHEN {lat} >= {L(0)} THEN 'EPSG:326' ELSE 'EPSG:327' END, "
            f"lpad(CAST({utm_zone_sql(lon)} AS VARCHAR), 2, '0'))")


def _lam0(zone: str) -> str:
    return f"((least({zone}, 60) * {L(6)} - {L(183)}) * {L(DEG_TO_RAD)})"


def utm_forward_sql(lon: str, lat: str, zone: str, south: str) -> tuple[str, str]:
    phi = f"({lat} * {L(DEG_TO_RAD)})"
    dlam = f"({lon} * {L(DEG_TO_RAD)} - {_lam0(zone)})"
    s = f"sin({phi})"
    t = f"sinh(atanh({s}) - {L(UTM_E)} * atanh({L(UTM_E)} * {s}))"
    xi1 = f"atan2({t}, cos({dlam}))"
    eta1 = f"atanh(sin({dlam}) / sqrt({L(1)} + {t} * {t}))"
    xi, eta = xi1, eta1
    for j, a in enumerate(UTM_ALPHA, start=1):
        k = L(2.0 * j)
        xi = f"({xi} + {L(a)} * sin({k} * {xi1}) * cosh({k} * {eta1}))"
        eta = f"({eta} + {L(a)} * cos({k} * {xi1}) * sinh({k} * {eta1}))"
    e = f"({L(UTM_FALSE_EASTING)} + {L(UTM_KA)} * {eta})"
    n = f"({L(UTM_KA)} * {xi})"
    n = f"(CASE WHEN {south} THEN {L(UTM_FALSE_NORTHING_SOUTH)} + {n} ELSE {n} END)"
    return f"round({e}, 3)", f"round({n}, 3)"


def utm_inverse_sql(e: str, n: str, zone: str, south: str) -> tuple[str, str]:
    n = f"(CASE WHEN {south} THEN {n} - {L(UTM_FALSE_NORTHING_SOUTH)} ELSE {n} END)"
    xi = f"({n} / {L(UTM_KA)})"
    eta = f"(({e} - {L(UTM_FALSE_EASTING)}) / {L(UTM_KA)})"
    xi1, eta1 = xi, eta
    for j, b in enumerate(UTM_BETA, start=1):
        k = L(2.0 * j)
        xi1 = f"({xi1} - {L(b)} * sin({k} * {xi}) * cosh({k} * {eta}))"
        eta1 = f"({eta1} - {L(b)} * cos({k} * {xi}) * sinh({k} * {eta}))"
    chi = f"asin(sin({xi1}) / cosh({eta1}))"
    phi = chi
    for j, d in enumerate(UTM_DELTA, start=1):
        phi = f"({phi} + {L(d)} * sin({L(2.0 * j)} * {chi}))"
    lam = f"({_lam0(zone)} + atan2(sinh({eta1}), cos({xi1})))"
    return f"round({phi} * {L(RAD_TO_DEG)}, 8)", f"round({lam} * {L(RAD_TO_DEG)}, 8)"


def ny_feet_inverse_sql(x: str, y: str) -> tuple[str, str]:
    """EPSG:2263 to degrees. Fixed values, worked out apart from the library
    (Snyder 1987, ch. 15, GRS 80): cone constant, its radius factor, radius of
    the origin, and the series of the latitude."""
    xm = f"({x} * 1.2e3 / 3.937e3 - 3e5)"
    ym = f"(7.462536301142713e6 - {y} * 1.2e3 / 3.937e3)"
    t = f"pow(sqrt({xm} * {xm} + {ym} * {ym}) / 1.2287232615120316e7, 1e0 / 6.540820912038099e-1)"
    chi = f"(pi() / 2e0 - 2e0 * atan({t}))"
    series = ((2, "3.3565514853511422e-3"), (4, "6.571872775293961e-6"), (6, "1.7645643646781633e-8"), (8, "5.3284785490533954e-11"))
    phi = " + ".join([chi] + [f"{c} * sin({k}e0 * {chi})" for k, c in series])
    return f"round(degrees({phi}), 8)", f"round(degrees(atan2({xm}, {ym}) / 6.540820912038099e-1) - 7.4e1, 8)"


def dist_sql(x1: str, y1: str, x2: str, y2: str) -> str:
    return f"sqrt(({x2} - {x1}) * ({x2} - {x1}) + ({y2} - {y1}) * ({y2} - {y1}))"


def wkt_sql(lon: str, lat: str) -> str:
    def num(x):
        return f"regexp_replace(CAST(CAST({x} AS DECIMAL(18,10)) AS VARCHAR), '\\.?0+$', '')"

    return f"concat('POINT (', {num(lon)}, ' ', {num(lat)}, ')')"


def ts_text_sql(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


# ------------------------------------------------------------ shared CTEs
def batched_cte(source: str, order: str, size: int = 100, name: str = "bt") -> str:
    return f"""{name}_s AS (SELECT *, row_number() OVER (ORDER BY {order}) AS seq FROM {source}),
{name} AS (SELECT *, (seq - 1) // {size} AS batch_id,
               CAST((seq - 1) - ((seq - 1) // {size}) * {size} AS INTEGER) AS rn FROM {name}_s)"""


def projected_cte(src: str = "bt", name: str = "pr") -> str:
    pe, pn = utm_forward_sql("b.pickup_lon", "b.pickup_lat", "f.utm_zone", "f.utm_south")
    de, dn = utm_forward_sql("b.dropoff_lon", "b.dropoff_lat", "f.utm_zone", "f.utm_south")
    return f"""{name}_f AS (SELECT batch_id, {utm_zone_sql('pickup_lon')} AS utm_zone,
                  pickup_lat < {L(0)} AS utm_south FROM {src} WHERE rn = 0),
{name} AS (SELECT b.*, {pe} AS pe, {pn} AS pn, {de} AS de, {dn} AS dn
         FROM {src} b JOIN {name}_f f USING (batch_id))"""


def input_route_cte(src: str = "bt", name: str = "ro") -> str:
    return f"""{name}_k AS (SELECT *, row_number() OVER (PARTITION BY batch_id, delivery_id ORDER BY rn) AS k FROM {src}),
{name} AS (SELECT *, CAST(row_number() OVER (PARTITION BY batch_id ORDER BY rn) AS INTEGER) AS visit_seq
         FROM {name}_k WHERE k = 1)"""


ROUTE_SELECT = """batch_id, visit_seq, rn, delivery_id, pickup_lat, pickup_lon, dropoff_lat, dropoff_lon, "timestamp",
       {wkt} AS geometry""".format(wkt=wkt_sql("pickup_lon", "pickup_lat"))


def nearest_walk_cte(src: str = "pr", name: str = "wk") -> str:
    d = dist_sql("p.pe", "p.pn", "c.de", "c.dn")
    return f"""{name}(batch_id, step, cur, visited) AS (
  SELECT batch_id, 1, 0, [0] FROM {src} WHERE rn = 0
  UNION ALL
  SELECT batch_id, step, cur, list_append(visited, cur) FROM (
    SELECT w.batch_id, w.step + 1 AS step, arg_min(p.rn, ({d}, p.rn)) AS cur,
           any_value(w.visited) AS visited
    FROM {name} w JOIN {src} c ON c.batch_id = w.batch_id AND c.rn = w.cur
                  JOIN {src} p ON p.batch_id = w.batch_id AND NOT list_contains(w.visited, p.rn)
    GROUP BY w.batch_id, w.step))"""


def nearest_route_cte(src: str = "pr", walk: str = "wk", name: str = "rn_route") -> str:
    return f"""{name} AS (SELECT p.*, CAST(w.step AS INTEGER) AS visit_seq
         FROM {walk} w JOIN {src} p ON p.batch_id = w.batch_id AND p.rn = w.cur)"""


def route_length_select(route: str, mode: str) -> str:
    loaded = f"CAST(round({dist_sql('pe', 'pn', 'de', 'dn')} * {L(1000)}) AS BIGINT)"
    nxt_e = "lead(pe) OVER (PARTITION BY batch_id ORDER BY visit_seq)"
    nxt_n = "lead(pn) OVER (PARTITION BY batch_id ORDER BY visit_seq)"
    empty = f"CAST(round({dist_sql('de', 'dn', nxt_e, nxt_n)} * {L(1000)}) AS BIGINT)"
    return f"""SELECT batch_id, '{mode}' AS mode, count(*) AS n_stops,
       CAST(sum(loaded_mm) AS BIGINT) AS loaded_mm, CAST(COALESCE(sum(empty_mm), 0) AS BIGINT) AS empty_mm,
       CAST(sum(loaded_mm) + COALESCE(sum(empty_mm), 0) AS BIGINT) AS total_mm
FROM (SELECT batch_id, {loaded} AS loaded_mm, {empty} AS empty_mm FROM {route}) GROUP BY batch_id"""


def _nulls(c: str) -> str:
    toks = ", ".join("'" + t.replace("'", "''") + "'" for t in NULL_TOKENS)
    return f"CASE WHEN {c} IN ({toks}) THEN NULL ELSE {c} END"


def _stored_select(route: str, key: str) -> str:
    return f"""SELECT CAST({key} AS BIGINT) AS route_key, delivery_id, pickup_lat, pickup_lon, dropoff_lat, dropoff_lon,
       {ts_text_sql('"timestamp"')} AS "timestamp", {wkt_sql('pickup_lon', 'pickup_lat')} AS geometry
FROM {route}"""


# ------------------------------------------------------------- the queries
def build() -> dict[str, str]:
    q: dict[str, str] = {}
    deliv = '"timestamp", pickup_lat, pickup_lon, dropoff_lat, dropoff_lon, delivery_id'

    q["trips_scan"] = with_fixtures(["trips"]) + "SELECT * FROM trips"
    q["zone_lookup"] = with_fixtures(["trips", "zones"]) + """SELECT trip_id,
  COALESCE(p.lat, CAST(4075 AS DOUBLE)/100) AS pickup_lat, COALESCE(p.lon, CAST(-7398 AS DOUBLE)/100) AS pickup_lon,
  COALESCE(d.lat, CAST(4075 AS DOUBLE)/100) AS dropoff_lat, COALESCE(d.lon, CAST(-7398 AS DOUBLE)/100) AS dropoff_lon
FROM trips LEFT JOIN zones p ON pulocationid = p.locationid LEFT JOIN zones d ON dolocationid = d.locationid"""
    box = ("pickup_lat BETWEEN CAST(405 AS DOUBLE)/10 AND CAST(410 AS DOUBLE)/10 AND "
           "pickup_lon BETWEEN CAST(-743 AS DOUBLE)/10 AND CAST(-737 AS DOUBLE)/10 AND "
           "dropoff_lat BETWEEN CAST(405 AS DOUBLE)/10 AND CAST(410 AS DOUBLE)/10 AND "
           "dropoff_lon BETWEEN CAST(-743 AS DOUBLE)/10 AND CAST(-737 AS DOUBLE)/10")
    q["bbox_filter"] = q["zone_lookup"].replace("SELECT trip_id,", "SELECT * FROM (SELECT trip_id,", 1) + f") WHERE {box}"
    prepared = with_fixtures(["trips", "zones"], """h AS (SELECT *, row_number() OVER (ORDER BY trip_id) AS delivery_id FROM trips)""",
                             """l AS (SELECT delivery_id,
  COALESCE(p.lat, CAST(4075 AS DOUBLE)/100) AS pickup_lat, COALESCE(p.lon, CAST(-7398 AS DOUBLE)/100) AS pickup_lon,
  COALESCE(d.lat, CAST(4075 AS DOUBLE)/100) AS dropoff_lat, COALESCE(d.lon, CAST(-7398 AS DOUBLE)/100) AS dropoff_lon,
  tpep_pickup_datetime AS ts
  FROM h LEFT JOIN zones p ON pulocationid = p.locationid LEFT JOIN zones d ON dolocationid = d.locationid)""")
    prepared += f"""SELECT delivery_id, pickup_lat, pickup_lon, dropoff_lat, dropoff_lon,
       ts + (2025 - year(ts)) * INTERVAL 1 YEAR AS "timestamp"
FROM l WHERE {box}"""
    q["prepare_deliveries"] = prepared
    q["yield_check"] = with_fixtures(["trips"]) + f"""SELECT n_rows, expected, n_rows < expected * {L(9)} / 10 AS warn FROM
  (SELECT count(*) AS n_rows, (SELECT count(*) FROM trips) AS expected FROM ({prepared}) x)"""
    q["sequence_sparse"] = "SELECT o_orderkey * 7 AS k, row_number() OVER (ORDER BY o_orderkey) AS seq FROM orders"
    q["sequence_composite"] = "SELECT o_custkey, o_orderkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS seq FROM orders"
    q["unknown_zones"] = with_fixtures(["trips", "zones"]) + """SELECT locationid, role, count(*) AS n_trips FROM (
  SELECT 'pickup' AS role, CAST(pulocationid AS INTEGER) AS locationid FROM trips
  UNION ALL SELECT 'dropoff', CAST(dolocationid AS INTEGER) FROM trips) r
WHERE locationid NOT IN (SELECT locationid FROM zones) OR locationid IS NULL
GROUP BY locationid, role"""
    q["shift_year"] = with_fixtures(["trips"]) + """SELECT trip_id,
  tpep_pickup_datetime + (2025 - year(tpep_pickup_datetime)) * INTERVAL 1 YEAR AS ts_2025 FROM trips"""
    q["sequence_ids"] = with_fixtures(["trips"]) + "SELECT trip_id, row_number() OVER (ORDER BY trip_id) AS seq FROM trips"
    q["head_rows"] = with_fixtures(["trips"]) + "SELECT * FROM trips ORDER BY trip_id LIMIT 10000"
    q["page_rows"] = with_fixtures(["deliveries"]) + "SELECT * FROM deliveries ORDER BY delivery_id LIMIT 100 OFFSET 300"
    q["delivery_count"] = with_fixtures(["deliveries"]) + "SELECT count(*) AS n_rows FROM deliveries"
    q["batch_count"] = with_fixtures(["deliveries"]) + """SELECT count(*) AS n_rows, 100 AS batch_size,
       CAST((count(*) + 99) // 100 AS BIGINT) AS n_batches FROM deliveries"""
    q["geometry_wkt"] = with_fixtures(["deliveries"]) + f"SELECT delivery_id, {wkt_sql('pickup_lon', 'pickup_lat')} AS geometry FROM deliveries"
    q["utm_crs"] = with_fixtures(["deliveries"]) + f"SELECT delivery_id, {utm_crs_sql('pickup_lon', 'pickup_lat')} AS crs FROM deliveries"
    e, n = utm_forward_sql("pickup_lon", "pickup_lat", utm_zone_sql("pickup_lon"), f"(pickup_lat < {L(0)})")
    q["utm_project"] = with_fixtures(["deliveries"]) + f"SELECT delivery_id, {e} AS easting, {n} AS northing FROM deliveries"
    for key in ("sql_view", "csv_roundtrip", "source_fallback", "source_full_with_sample"):
        q[key] = with_fixtures(["deliveries"]) + f"SELECT {deliv} FROM deliveries"
    q["csv_quoted_newlines"] = with_fixtures(["deliveries"]) + f"""SELECT {deliv},
  CASE WHEN delivery_id % 3 = 0 THEN 'gate ' || delivery_id || chr(10) || 'say "hi", twice' ELSE 'plain' END AS note FROM deliveries"""
    q["csv_quoted_report"] = with_fixtures(["deliveries"]) + """SELECT 'plain' AS source, 'ok' AS status, false AS quoted_breaks, count(*) AS n_records FROM deliveries
UNION ALL SELECT 'quoted', 'ok', true, count(*) FROM deliveries"""
    q["page_deep"] = with_fixtures(["deliveries"]) + """SELECT seq, delivery_id, "timestamp" FROM (
  SELECT row_number() OVER (ORDER BY "timestamp" NULLS FIRST, delivery_id) AS seq, delivery_id, "timestamp", count(*) OVER () AS n FROM deliveries)
WHERE seq > n * 3 // 5 AND seq <= n * 3 // 5 + 1000"""
    q["sample_csv"] = with_fixtures(["deliveries"]) + f"SELECT {deliv} FROM deliveries ORDER BY delivery_id LIMIT 10000"
    q["union_files"] = with_fixtures(["deliveries"]) + f"SELECT {deliv} FROM deliveries UNION ALL SELECT {deliv} FROM deliveries"
    q["csv_file_report"] = with_fixtures(["deliveries"]) + """SELECT 'good' AS source, 'ok' AS status, count(*) AS n_data_lines FROM deliveries
UNION ALL SELECT 'wrong_columns', 'missing_columns', count(*) FROM deliveries
UNION ALL SELECT 'malformed', 'malformed', count(*) FROM deliveries
UNION ALL SELECT 'header_only', 'header_only', CAST(0 AS BIGINT)"""

    # quality
    rules = []
    for c in ("pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon"):
        num = f"TRY_CAST({c} AS DOUBLE)"
        rules.append(("numeric", c, f"{c} IS NOT NULL AND {num} IS NULL"))
        rules.append(("not_null", c, f"{c} IS NULL"))
        lo, hi, r = (-90, 90, "lat_range") if c.endswith("lat") else (-180, 180, "lon_range")
        rules.append((r, c, f"{num} IS NOT NULL AND NOT ({num} BETWEEN {L(lo)} AND {L(hi)})"))
    rules.append(("integer", "delivery_id", "delivery_id IS NULL OR NOT regexp_matches(delivery_id, '^[+-]?[0-9]+$')"))
    rules.append(("not_null", "delivery_id", "delivery_id IS NULL"))
    rules.append(("timestamp", "timestamp", '"timestamp" IS NOT NULL AND TRY_CAST("timestamp" AS TIMESTAMP) IS NULL'))
    norm = "nt AS (SELECT " + ", ".join(
        f'{_nulls(c)} AS {c}' for c in ("delivery_id", "pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon", '"timestamp"')
    ) + " FROM raw_text)"
    parts = [
        "SELECT 'input' AS source, 'empty' AS rule, CAST(NULL AS VARCHAR) AS \"column\", CAST(count(*) = 0 AS BIGINT) AS n_bad FROM nt",
        "SELECT 'input', 'required_columns', NULL, CAST(0 AS BIGINT)",
        "SELECT 'input', 'duplicate_id', 'delivery_id', count(*) FROM (SELECT delivery_id FROM nt GROUP BY delivery_id HAVING count(*) > 1)",
    ] + [f"SELECT 'input', '{r}', '{c}', CAST(count_if({p}) AS BIGINT) FROM nt" for r, c, p in rules]
    q["quality_report"] = with_fixtures(["raw_text"], norm) + "SELECT *, n_bad = 0 AS passed FROM (\n" + "\nUNION ALL ".join(parts) + ") x"
    q["invalid_timestamps"] = with_fixtures(["raw_text"]) + f"""SELECT count(*) AS n_rows,
       CAST(count_if(TRY_CAST({_nulls('"timestamp"')} AS TIMESTAMP) IS NULL) AS BIGINT) AS n_invalid FROM raw_text"""
    q["timestamp_parse"] = with_fixtures(["raw_text"]) + f"""SELECT delivery_id, TRY_CAST({_nulls('"timestamp"')} AS TIMESTAMP) AS ts FROM raw_text"""
    q["duplicate_ids"] = with_fixtures(["deliveries_dup"]) + """SELECT 'input' AS source, delivery_id, count(*) AS n_rows
FROM deliveries_dup GROUP BY delivery_id HAVING count(*) > 1"""

    # centroids
    cen = with_fixtures(["zone_vertices"], """e AS (SELECT a.zone_id, a.x, a.y, b.x AS x2, b.y AS y2,
  a.x * b.y - b.x * a.y AS c FROM zone_vertices a JOIN zone_vertices b
  ON a.zone_id = b.zone_id AND a.ring = b.ring AND b.seq - 1 = a.seq)""", f"""cen AS (SELECT zone_id,
  round(CASE WHEN sum(c) <> 0 THEN sum((x + x2) * c) / ({L(3)} * sum(c)) END, 3) AS cx,
  round(CASE WHEN sum(c) <> 0 THEN sum((y + y2) * c) / ({L(3)} * sum(c)) END, 3) AS cy
  FROM e GROUP BY zone_id)""")
    q["zone_centroid"] = cen + "SELECT * FROM cen"
    lat, lon = utm_inverse_sql("cx", "cy", "18", "false")
    q["zone_centroid_wgs84"] = cen + f"SELECT zone_id AS locationid, {lat} AS lat, {lon} AS lon FROM cen"

    lat, lon = ny_feet_inverse_sql("cx", "cy")
    # area and centroid of the trapezoid as a rectangle and a triangle, of holes and second parts as squares
    trapezoid = "CAST(125000000 AS DOUBLE) + 500000000e0 / 3"
    q["zone_centroid_2263"] = f"""WITH cen AS (SELECT n_nationkey AS zone_id,
  round(9e5 + 2e4 * n_nationkey + ({trapezoid}) / 7.5e5, 3) AS cx,
  round(1.9e5 + 9e2 * n_nationkey + (25e7 + 25e7 / 3) / 7.5e5, 3) AS cy FROM nation)
SELECT zone_id AS locationid, {lat} AS lat, {lon} AS lon FROM cen"""
    polygons = f"""part AS (SELECT n_nationkey AS n, CAST(n_nationkey % 3 = 0 AS INTEGER) AS hole, CAST(n_nationkey % 4 = 1 AS INTEGER) AS more FROM nation WHERE n_nationkey < 24),
cen AS (SELECT n,
  round(9.8e5 + 1.5e3 * n + ({trapezoid} - 3.5e6 * hole + 5.625e8 * more) / (7.5e5 - 1e4 * hole + 2.5e5 * more), 3) AS cx,
  round(1.9e5 + 9e2 * n + (25e7 + 25e7 / 3 - 3.5e6 * hole + 6.25e7 * more) / (7.5e5 - 1e4 * hole + 2.5e5 * more), 3) AS cy FROM part),
zones AS (SELECT n AS locationid, {lat} AS lat, {lon} AS lon FROM cen)"""
    q["prepare_from_polygons"] = prepared.replace(FIXTURES["zones"], polygons)

    # batches over deliveries ordered by delivery_id
    bt = with_fixtures(["deliveries"], batched_cte("deliveries", "delivery_id"))
    q["batch_assign"] = bt + "SELECT delivery_id, seq, batch_id, rn FROM bt"
    q["batch_crs"] = bt + f"""SELECT batch_id, {utm_crs_sql('pickup_lon', 'pickup_lat')} AS crs,
       {utm_zone_sql('pickup_lon')} AS utm_zone, pickup_lat < {L(0)} AS utm_south FROM bt WHERE rn = 0"""
    stops = """SELECT batch_id, rn, delivery_id, "timestamp", 'pickup' AS point_type, 'p_' || CAST(rn AS VARCHAR) AS stop_key,
       pickup_lat AS lat, pickup_lon AS lon FROM bt
UNION ALL SELECT batch_id, rn, delivery_id, "timestamp", 'dropoff', 'd_' || CAST(rn AS VARCHAR), dropoff_lat, dropoff_lon FROM bt"""
    q["stops_unpivot"] = bt + stops
    q["pickup_stops"] = bt + f"SELECT * FROM ({stops}) s WHERE point_type = 'pickup'"
    q["stop_key_prefix"] = bt + f"""SELECT *, CAST(substring(stop_key, 3) AS INTEGER) AS key_rn FROM ({stops}) s
WHERE starts_with(stop_key, 'p_')"""
    q["stop_path"] = bt + f"""SELECT *, CAST(rn * 2 + CASE WHEN point_type = 'pickup' THEN 1 ELSE 2 END AS INTEGER) AS visit_seq
FROM ({stops}) s"""
    prj = with_fixtures(["deliveries"], batched_cte("deliveries", "delivery_id"), projected_cte())
    lat, lon = utm_inverse_sql("pe", "pn", utm_zone_sql("zlon"), "false")
    q["routes_append_crs"] = prj + f"""SELECT delivery_id, {wkt_sql('glon', 'glat')} AS geometry FROM (
  SELECT delivery_id, {lat} AS glat, {lon} AS glon FROM (
    SELECT *, first_value(pickup_lon) OVER (PARTITION BY batch_id ORDER BY rn) AS zlon FROM pr)) x"""
    q["delivery_edges"] = prj + f"""SELECT batch_id, 'p_' || CAST(rn AS VARCHAR) AS src, 'd_' || CAST(rn AS VARCHAR) AS dst, {L(0)} AS weight FROM pr
UNION ALL SELECT p.batch_id, 'p_' || CAST(p.rn AS VARCHAR), 'd_' || CAST(c.rn AS VARCHAR), {dist_sql('p.pe', 'p.pn', 'c.de', 'c.dn')}
FROM pr p JOIN pr c ON p.batch_id = c.batch_id AND p.rn <> c.rn"""
    near = prj + f""", cand AS (SELECT p.batch_id, p.rn, c.rn AS nearest_rn, {dist_sql('p.pe', 'p.pn', 'c.de', 'c.dn')} AS dist
  FROM pr p JOIN pr c ON p.batch_id = c.batch_id AND p.rn <> c.rn)
SELECT batch_id, rn, nearest_rn, dist FROM (
  SELECT *, row_number() OVER (PARTITION BY batch_id, rn ORDER BY dist, nearest_rn) AS k FROM cand) x WHERE k = 1"""
    q["nearest_dropoff"] = near
    q["nearest_dropoff_grid"] = near
    walk = prj.replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + ",\n" + nearest_walk_cte() + ",\n" + nearest_route_cte() + "\n"
    q["route_nearest"] = walk + f"SELECT {ROUTE_SELECT} FROM rn_route"
    lengths = walk.rstrip() + ",\n" + input_route_cte("pr", "ro") + "\n"
    q["route_length"] = lengths + route_length_select("ro", "input_order") + "\nUNION ALL\n" + route_length_select("rn_route", "nearest")

    # routes in input order and the stored table
    q["route_input_order"] = with_fixtures(["deliveries_dup"], batched_cte("deliveries_dup", "row_no"), input_route_cte()) + f"SELECT {ROUTE_SELECT} FROM ro"
    q["optimize_routes"] = with_fixtures(["deliveries_far_dup"], batched_cte("deliveries_far_dup", "row_no"), input_route_cte()) + f"SELECT {ROUTE_SELECT} FROM ro"
    q["leg_distance"] = with_fixtures(["deliveries_dup"], batched_cte("deliveries_dup", "row_no"), input_route_cte()) + f"""SELECT * FROM (
  SELECT batch_id, visit_seq, {dist_sql('pickup_lon', 'pickup_lat', 'lead(pickup_lon) OVER (PARTITION BY batch_id ORDER BY visit_seq)', 'lead(pickup_lat) OVER (PARTITION BY batch_id ORDER BY visit_seq)')} AS leg_deg
  FROM ro) x WHERE leg_deg IS NOT NULL"""
    q["dedup_first"] = with_fixtures(["deliveries_dup"], batched_cte("deliveries_dup", "row_no")) + """SELECT batch_id, rn, delivery_id, row_no FROM (
  SELECT *, row_number() OVER (PARTITION BY batch_id, delivery_id ORDER BY rn) AS k FROM bt) x WHERE k = 1"""
    q["batch_metrics"] = with_fixtures(["deliveries_dup"], batched_cte("deliveries_dup", "row_no")) + """SELECT batch_id, CAST(count(*) AS BIGINT) AS rows_in,
       count(DISTINCT delivery_id) AS rows_out FROM bt GROUP BY batch_id"""
    stored = with_fixtures(["deliveries"], batched_cte("deliveries", "delivery_id"), input_route_cte(),
                           "rk AS (SELECT *, row_number() OVER (ORDER BY batch_id, visit_seq) AS route_k FROM ro)")
    q["routes_readback"] = stored + _stored_select("rk", "route_k")
    q["ingest_route_store"] = q["routes_readback"]
    q["ingest_nearest_files"] = (walk.rstrip() + ",\nrk AS (SELECT *, row_number() OVER (ORDER BY batch_id, visit_seq) AS route_k FROM rn_route)\n"
                                 + _stored_select("rk", "route_k"))
    q["routes_append_dedup"] = q["routes_readback"]
    q["routes_append_key"] = stored + """SELECT CAST(route_k AS BIGINT) AS route_key, delivery_id FROM rk
UNION ALL SELECT CAST(route_k + (SELECT count(*) FROM rk) AS BIGINT), delivery_id FROM rk"""
    one = _stored_select("rk", "route_k").replace("SELECT CAST(route_k AS BIGINT) AS route_key, ", "SELECT ")
    q["routes_append"] = stored + one + "\nUNION ALL\n" + one
    q["routes_append_twice"] = q["routes_readback"]
    q["routes_append_overlap"] = stored + one
    q["geometry_repair"] = with_fixtures(["deliveries"], f"""g AS (SELECT delivery_id, pickup_lat,
  CASE WHEN delivery_id % 13 = 0 THEN NULL ELSE pickup_lon END AS pickup_lon,
  CASE WHEN delivery_id % 7 = 0 THEN NULL WHEN delivery_id % 11 = 0 THEN 'LINESTRING (0 0, 1 1)'
       ELSE {wkt_sql('pickup_lon', 'pickup_lat')} END AS geometry FROM deliveries)""") + f"""SELECT delivery_id,
  CASE WHEN COALESCE(regexp_matches(geometry, '^POINT \\('), false) THEN geometry
       WHEN pickup_lon IS NOT NULL AND pickup_lat IS NOT NULL THEN {wkt_sql('pickup_lon', 'pickup_lat')} END AS geometry,
  NOT COALESCE(regexp_matches(geometry, '^POINT \\('), false) AS geometry_fixed FROM g"""
    return q
