"""Albers equal-area conic projection of the lower 48 states."""
from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Standard parallels, origin latitude, central meridian (degrees).
PARALLELS = (29.5, 45.5)
ORIGIN_LAT = 37.5
CENTRAL_LON = -96.0

_P1, _P2, _P0 = (math.radians(v) for v in (*PARALLELS, ORIGIN_LAT))
_N = (math.sin(_P1) + math.sin(_P2)) / 2
_C = math.cos(_P1) ** 2 + 2 * _N * math.sin(_P1)
_RHO0 = math.sqrt(_C - 2 * _N * math.sin(_P0)) / _N


def albers_xy(lat: Column, lon: Column) -> Column:
    """Struct (x, y) with y pointing up."""
    rho = F.sqrt(F.lit(_C) - F.lit(2 * _N) * F.sin(F.radians(lat))) / F.lit(_N)
    theta = F.lit(_N) * F.radians(lon - F.lit(CENTRAL_LON))
    return F.struct((rho * F.sin(theta)).alias("x"), (F.lit(_RHO0) - rho * F.cos(theta)).alias("y"))
