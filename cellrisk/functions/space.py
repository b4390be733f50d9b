"""Spatial column expressions: grid ids, integer grid indexes, box tests,
haversine distance and Gaussian distance weights.  All are JVM-side
expressions that stay inside whole-stage codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellrisk.params import EARTH_RADIUS_KM, GRID_DECIMALS, GRID_STEP, Region, HOURLY_REGION


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def grid_round(c, decimals: int = GRID_DECIMALS) -> Column:
    """Half-even rounding to ``decimals`` places (numpy ``round``): ``rint(x*10^d)/10^d``."""
    scale = float(10 ** decimals)
    return F.rint(_c(c).cast("double") * F.lit(scale)) / F.lit(scale)


def cell_id(lat_r, lon_r) -> Column:
    """Text cell key ``'<lat_r>_<lon_r>'`` (Java double text equals Python's here)."""
    return F.concat_ws("_", _c(lat_r).cast("string"), _c(lon_r).cast("string"))


def grid_cells(lat, lon, decimals: int = GRID_DECIMALS) -> dict[str, Column]:
    """``latlon_to_grid``: rounded coordinates and the text cell id."""
    lat_r, lon_r = grid_round(lat, decimals), grid_round(lon, decimals)
    return {"lat_r": lat_r, "lon_r": lon_r, "cell_id": cell_id(lat_r, lon_r)}


def grid_index(c, step: float = GRID_STEP) -> Column:
    """Integer grid index ``rint(x/step)``; integer keys for every spatial join."""
    return F.rint(_c(c).cast("double") / F.lit(step)).cast("int")


def in_box(lat, lon, region: Region = HOURLY_REGION) -> Column:
    """Inclusive bounding-box predicate; null coordinates give null (use
    ``coalesce(..., False)`` where a definite answer is needed)."""
    return (_c(lat).between(region.lat_min, region.lat_max)
            & _c(lon).between(region.lon_min, region.lon_max))


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km (degrees in)."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = p2 - p1
    dlmb = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2.0 * radius_km) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))   # antipodes round past 1


def gaussian_weight(d, sigma) -> Column:
    """``exp(-d^2 / (2 sigma^2))``."""
    s = _c(sigma) if not isinstance(sigma, (int, float)) else F.lit(float(sigma))
    return F.exp(-(_c(d) * _c(d)) / (F.lit(2.0) * s * s))


def km_per_degree(lat_deg: float, radius_km: float = EARTH_RADIUS_KM) -> tuple[float, float]:
    """(km per degree of latitude, km per degree of longitude at ``lat_deg``)."""
    k = math.pi / 180.0 * radius_km
    return k, k * math.cos(math.radians(lat_deg))
