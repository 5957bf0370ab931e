"""Great-circle distances as Column expressions."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0088
# Kilometres per distance unit.
UNIT_KM = {"m": 0.001, "km": 1.0, "mi": 1.609344}


def kilometres(distance: str | float) -> float:
    """``"200km"``, ``"5mi"``, ``"800m"``; a bare number is metres."""
    if not isinstance(distance, str):
        return float(distance) * UNIT_KM["m"]
    m = re.fullmatch(r"([0-9.]+)\s*(km|mi|m)?", distance.strip())
    if not m:
        raise ValueError(f"not a distance: {distance!r}")
    return float(m[1]) * UNIT_KM[m[2] or "m"]


def haversine_km(lat: Column, lon: Column, lat0: float, lon0: float) -> Column:
    dlat = F.radians(lat - F.lit(lat0)) / 2
    dlon = F.radians(lon - F.lit(lon0)) / 2
    h = F.pow(F.sin(dlat), 2) + F.lit(math.cos(math.radians(lat0))) * F.cos(
        F.radians(lat)
    ) * F.pow(F.sin(dlon), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def plane_km(lat: Column, lon: Column, lat0: float, lon0: float) -> Column:
    """Flat approximation around the mean latitude; cheaper, worse far away."""
    east = F.radians(wrap_lon(lon - F.lit(lon0))) * F.cos(F.radians((lat + F.lit(lat0)) / 2))
    north = F.radians(lat - F.lit(lat0))
    return F.lit(EARTH_KM) * F.sqrt(east * east + north * north)


def wrap_lon(lon: Column) -> Column:
    return F.pmod(lon + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


def bounding_box(lat: Column, lon: Column, lat0: float, lon0: float, km: float) -> Column:
    """A cheap necessary condition that can reach the file scan."""
    dlat = math.degrees(km / EARTH_KM) + 1e-9
    box = (lat >= lat0 - dlat) & (lat <= lat0 + dlat)
    top = max(abs(lat0 - dlat), abs(lat0 + dlat))
    if top < 90:
        reach = math.sin(km / (2 * EARTH_KM)) ** 2 / (
            math.cos(math.radians(lat0)) * math.cos(math.radians(top))
        )
        if reach < 1:
            dlon = math.degrees(2 * math.asin(math.sqrt(reach))) + 1e-9
            if lon0 - dlon >= -180 and lon0 + dlon <= 180:
                box = box & (lon >= lon0 - dlon) & (lon <= lon0 + dlon)
    return box
