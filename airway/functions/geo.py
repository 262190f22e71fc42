"""Great-circle distance and the WGS-84 to GCJ-02 shift as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Earth radius in metres used for every distance.
EARTH_RADIUS_M = 6371393

# GCJ-02 ellipsoid and the box outside of which points stay unshifted.
GCJ_SEMI_MAJOR = 6378245.0
GCJ_ECCENTRICITY_SQ = 0.00669342162296594323
GCJ_LON_RANGE = (72.004, 137.8347)
GCJ_LAT_RANGE = (0.8293, 55.8271)

# The published GCJ-02 offset series. A polynomial in
# (1, x, y, x*x or y*y, x*y, sqrt|x|) and sine terms (amplitude, frequency).
GCJ_LAT_POLY = (-100.0, 2.0, 3.0, 0.2, 0.1, 0.2)
GCJ_LON_POLY = (300.0, 1.0, 2.0, 0.1, 0.1, 0.1)
GCJ_COMMON_SINES = ((20.0, 6.0), (20.0, 2.0))
GCJ_LAT_SINES = ((20.0, 1.0), (40.0, 1.0 / 3.0), (160.0, 1.0 / 12.0), (320.0, 1.0 / 30.0))
GCJ_LON_SINES = ((20.0, 1.0), (40.0, 1.0 / 3.0), (150.0, 1.0 / 12.0), (300.0, 1.0 / 30.0))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _rad(c: Column) -> Column:
    return c * F.lit(math.pi) / F.lit(180.0)


def haversine_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """SQL text for whole metres between two points: kept to 0.1 mm, then cut off."""
    deg = "(pi() / 180.0D)"
    chord = (
        f"pow(sin(({lat1} - {lat2}) * {deg} / 2.0D), 2.0D)"
        f" + cos({lat1} * {deg}) * cos({lat2} * {deg}) * pow(sin(({lon1} - {lon2}) * {deg} / 2.0D), 2.0D)"
    )
    return f"floor(floor(2.0D * asin(sqrt({chord})) * {EARTH_RADIUS_M}.0D * 10000.0D + 0.5D) / 10000.0D)"


def haversine_m(lon1: str, lat1: str, lon2: str, lat2: str) -> Column:
    """Whole metres (bigint). Arguments are column names or SQL expressions; one
    parsed text costs the driver far less than some sixty Column calls."""
    return F.expr(haversine_sql(lon1, lat1, lon2, lat2))


def haversine_sq_m(lon1: str, lat1: str, lon2: str, lat2: str) -> Column:
    d = haversine_m(lon1, lat1, lon2, lat2)
    return d * d


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``distance`` and ``dis2`` callable from SQL text, as SQL functions
    that Catalyst inlines."""
    args = "(lon1 DOUBLE, lat1 DOUBLE, lon2 DOUBLE, lat2 DOUBLE)"
    metres = haversine_sql("lon1", "lat1", "lon2", "lat2")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION distance{args} RETURNS BIGINT RETURN {metres}")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION dis2{args} RETURNS BIGINT "
        "RETURN distance(lon1, lat1, lon2, lat2) * distance(lon1, lat1, lon2, lat2)"
    )


def _poly(coef, x: Column, y: Column, square_of: Column) -> Column:
    c0, cx, cy, csq, cxy, croot = map(F.lit, coef)
    return c0 + cx * x + cy * y + csq * square_of * square_of + cxy * x * y + croot * F.sqrt(F.abs(x))


def _sines(terms, t: Column) -> Column:
    total = F.lit(0.0)
    for amplitude, frequency in terms:
        total = total + F.lit(amplitude) * F.sin(t * F.lit(frequency * math.pi))
    return total * F.lit(2.0 / 3.0)


def wgs84_to_gcj02(lon, lat) -> tuple[Column, Column]:
    """Shifted ``(lon, lat)`` as doubles; points outside the box are unchanged."""
    lon, lat = _col(lon), _col(lat)
    x, y = lon - F.lit(105.0), lat - F.lit(35.0)
    wobble = _sines(GCJ_COMMON_SINES, x)
    north = _poly(GCJ_LAT_POLY, x, y, y) + wobble + _sines(GCJ_LAT_SINES, y)
    east = _poly(GCJ_LON_POLY, x, y, x) + wobble + _sines(GCJ_LON_SINES, x)

    phi = _rad(lat)
    curve = F.lit(1.0) - F.lit(GCJ_ECCENTRICITY_SQ) * F.sin(phi) * F.sin(phi)
    meridian_m = F.lit(GCJ_SEMI_MAJOR * (1 - GCJ_ECCENTRICITY_SQ)) / (curve * F.sqrt(curve))
    parallel_m = F.lit(GCJ_SEMI_MAJOR) / F.sqrt(curve) * F.cos(phi)
    inside = lon.between(*GCJ_LON_RANGE) & lat.between(*GCJ_LAT_RANGE)
    return (
        F.when(inside, lon + F.degrees(east / parallel_m)).otherwise(lon),
        F.when(inside, lat + F.degrees(north / meridian_m)).otherwise(lat),
    )


def six_decimals(c) -> Column:
    """Coordinate as text with six decimals; null stays null."""
    c = _col(c)
    return F.when(c.isNotNull(), F.format_string("%.6f", c))
