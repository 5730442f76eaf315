"""Longitude/latitude to Tennessee State Plane feet (EPSG:2274) as plain column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Public EPSG definition of the projection (degrees, metres, US survey feet per metre).
LAT_1, LAT_2, LAT_0, LON_0 = 35.25, 36.41666666666666, 34.33333333333334, -86.0
FALSE_EAST, FALSE_NORTH = 600000.0, 0.0
SEMI_MAJOR, INV_FLATTENING = 6378137.0, 298.257222101
FEET_PER_METRE = 3937.0 / 1200.0

_F = 1 / INV_FLATTENING
ECC = math.sqrt(2 * _F - _F * _F)


def _scale(lat: float) -> float:
    return math.cos(lat) / math.sqrt(1 - (ECC * math.sin(lat)) ** 2)


def _conformal(lat: float) -> float:
    s = ECC * math.sin(lat)
    return math.tan(math.pi / 4 - lat / 2) / ((1 - s) / (1 + s)) ** (ECC / 2)


_m1, _m2 = _scale(math.radians(LAT_1)), _scale(math.radians(LAT_2))
_t1, _t2 = _conformal(math.radians(LAT_1)), _conformal(math.radians(LAT_2))
CONE = (math.log(_m1) - math.log(_m2)) / (math.log(_t1) - math.log(_t2))
RADIUS = SEMI_MAJOR * _m1 / (CONE * _t1**CONE)
RHO_0 = RADIUS * _conformal(math.radians(LAT_0)) ** CONE


def to_state_plane(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Projected x and y in feet; null where either coordinate is null or NaN."""
    lon, lat = lon.cast("double"), lat.cast("double")
    ok = lon.isNotNull() & lat.isNotNull() & ~F.isnan(lon) & ~F.isnan(lat)
    phi = F.radians(lat)
    es = F.lit(ECC) * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - es) / (1 + es), F.lit(ECC / 2))
    rho = F.lit(RADIUS) * F.pow(t, F.lit(CONE))
    theta = F.lit(CONE) * F.radians(lon - F.lit(LON_0))
    x = (F.lit(FALSE_EAST) + rho * F.sin(theta)) * FEET_PER_METRE
    y = (F.lit(FALSE_NORTH) + F.lit(RHO_0) - rho * F.cos(theta)) * FEET_PER_METRE
    return F.when(ok, x), F.when(ok, y)


def project_rings(rings: Column) -> Column:
    """Shapes with every vertex projected; parts, holes and the order of vertices stay."""

    def vertex(v: Column) -> Column:
        x, y = to_state_plane(v["x"], v["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    def ring(r: Column) -> Column:
        return F.struct(r["part"].alias("part"), r["hole"].alias("hole"), F.transform(r["pts"], vertex).alias("pts"))

    return F.transform(rings, ring)


def point_text(x: Column, y: Column, srid: int = 2274) -> Column:
    """Point in extended well-known text; null where a coordinate is missing."""
    ok = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    body = F.concat(F.lit(f"SRID={srid};POINT("), x.cast("string"), F.lit(" "), y.cast("string"), F.lit(")"))
    return F.when(ok, body)
