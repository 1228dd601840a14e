"""Column expressions (geometry, projection, time) built from Spark
built-in functions only, so they stay inside whole-stage codegen."""

from waybatch.functions.geo import (  # noqa: F401
    lcc_inverse,
    planar_distance,
    utm_crs,
    utm_forward,
    utm_inverse,
    utm_south,
    utm_zone,
    wkt_number,
    wkt_point,
    is_wkt_point,
)
from waybatch.functions.timefn import parse_timestamp, shift_year, normalize_nulls  # noqa: F401
