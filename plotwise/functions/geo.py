"""Geodesy as column expressions (no UDFs): haversine, planar degrees,
transverse Mercator (UTM) forward projection, grid cells.

Each formula is written once as SQL text over named inputs, so the Spark
column (``F.expr``, JVM codegen) and the DuckDB oracle evaluate the same
arithmetic. Radians are formed by multiplying with one constant on both sides.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from plotwise.config import EARTH_RADIUS_KM

DEG2RAD = math.pi / 180.0
KM_PER_DEG_LAT = EARTH_RADIUS_KM * DEG2RAD  # 111.19492664455873 on the sphere

# WGS84 ellipsoid and UTM constants (published values)
WGS84_A = 6378137.0
WGS84_F = 1.0 / 298.257223563
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_FALSE_NORTHING_S = 10000000.0


def _fmt(v: float) -> str:
    # exponent form: both Spark SQL and DuckDB parse it as DOUBLE, not DECIMAL
    return f"{float(v):.17e}"


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str, radius: float = EARTH_RADIUS_KM) -> str:
    """Great-circle distance, atan2 form, in the unit of ``radius``."""
    k = _fmt(DEG2RAD)
    a = (
        f"(sin(({lat2} - {lat1}) * {k} / 2) * sin(({lat2} - {lat1}) * {k} / 2)"
        f" + cos({lat1} * {k}) * cos({lat2} * {k})"
        f" * sin(({lon2} - {lon1}) * {k} / 2) * sin(({lon2} - {lon1}) * {k} / 2))"
    )
    return f"({_fmt(radius)} * 2 * atan2(sqrt({a}), sqrt(1 - {a})))"


def haversine_km(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    return F.expr(haversine_sql(lat1, lon1, lat2, lon2))


def degree_dist_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Planar distance in degrees (EPSG:4326 treated as a plane)."""
    return f"sqrt(({lat2} - {lat1}) * ({lat2} - {lat1}) + ({lon2} - {lon1}) * ({lon2} - {lon1}))"


def degree_dist(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    return F.expr(degree_dist_sql(lat1, lon1, lat2, lon2))


def utm_sql(lat: str, lon: str, zone: int = 48) -> tuple[str, str]:
    """UTM easting / northing in metres (Snyder's series, WGS84)."""
    e2 = WGS84_F * (2 - WGS84_F)
    ep2 = e2 / (1 - e2)
    lon0 = zone * 6 - 183
    phi = f"({lat} * {_fmt(DEG2RAD)})"
    n = f"({_fmt(WGS84_A)} / sqrt(1 - {_fmt(e2)} * sin({phi}) * sin({phi})))"
    t = f"(tan({phi}) * tan({phi}))"
    c = f"({_fmt(ep2)} * cos({phi}) * cos({phi}))"
    a = f"(cos({phi}) * (({lon}) - {lon0}) * {_fmt(DEG2RAD)})"
    m1 = 1 - e2 / 4 - 3 * e2 ** 2 / 64 - 5 * e2 ** 3 / 256
    m2 = 3 * e2 / 8 + 3 * e2 ** 2 / 32 + 45 * e2 ** 3 / 1024
    m3 = 15 * e2 ** 2 / 256 + 45 * e2 ** 3 / 1024
    m4 = 35 * e2 ** 3 / 3072
    m = (
        f"({_fmt(WGS84_A)} * ({_fmt(m1)} * {phi} - {_fmt(m2)} * sin(2 * {phi})"
        f" + {_fmt(m3)} * sin(4 * {phi}) - {_fmt(m4)} * sin(6 * {phi})))"
    )
    x = (
        f"({_fmt(UTM_K0)} * {n} * ({a} + (1 - {t} + {c}) * pow({a}, 3) / 6"
        f" + (5 - 18 * {t} + {t} * {t} + 72 * {c} - {_fmt(58 * ep2)}) * pow({a}, 5) / 120)"
        f" + {_fmt(UTM_FALSE_EASTING)})"
    )
    y0 = (
        f"({_fmt(UTM_K0)} * ({m} + {n} * tan({phi}) * (pow({a}, 2) / 2"
        f" + (5 - {t} + 9 * {c} + 4 * {c} * {c}) * pow({a}, 4) / 24"
        f" + (61 - 58 * {t} + {t} * {t} + 600 * {c} - {_fmt(330 * ep2)}) * pow({a}, 6) / 720)))"
    )
    y = f"(CASE WHEN {lat} < 0 THEN {y0} + {_fmt(UTM_FALSE_NORTHING_S)} ELSE {y0} END)"
    return x, y


def utm_xy(lat: str, lon: str, zone: int = 48) -> tuple[Column, Column]:
    x, y = utm_sql(lat, lon, zone)
    return F.expr(x), F.expr(y)


def lon_cell_width_deg(cell_deg: float, row: Column) -> Column:
    """Longitude width of the cells in lat-row ``row`` so that one cell spans
    at least the search radius for any pair whose rows differ by ≤1."""
    lo = F.abs((row - 1) * cell_deg)
    hi = F.abs((row + 2) * cell_deg)
    bound = F.least(F.greatest(lo, hi), F.lit(89.0))
    return F.least(F.lit(cell_deg * 1.001) / F.cos(bound * DEG2RAD), F.lit(360.0))
