"""Great-circle geometry as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Distance in km between two points given in degrees."""
    a_lat, b_lat = F.radians(lat1), F.radians(lat2)
    half_lat = (b_lat - a_lat) / 2
    half_lon = (F.radians(lon2) - F.radians(lon1)) / 2
    root = F.sqrt(
        F.pow(F.sin(half_lat), 2) + F.cos(a_lat) * F.cos(b_lat) * F.pow(F.sin(half_lon), 2)
    )
    # Rounding can push the root above 1 for antipodes, where asin is NaN.
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(root, F.lit(1.0)))


def unit_vector(lat, lon) -> tuple[Column, Column, Column]:
    """Point on the unit sphere; chords there grow with great-circle distance."""
    phi, lam = F.radians(lat), F.radians(lon)
    return F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)


def chord_of_km(km: float) -> float:
    """Straight-line length on the unit sphere of a ``km`` long arc."""
    return 2 * math.sin(min(km / EARTH_RADIUS_KM, math.pi) / 2)
