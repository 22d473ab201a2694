"""Great-circle geometry as column expressions and as numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0


def distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance in metres; null where any coordinate is null."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_M) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def distance_np(lat1, lon1, lat2, lon2):
    """The same over arrays."""
    p1, p2 = np.radians(lat1), np.radians(lat2)
    a = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(np.subtract(lon2, lon1)) / 2) ** 2
    return 2 * EARTH_M * np.arcsin(np.sqrt(np.minimum(1.0, a)))


def usable_position(lat: Column, lon: Column) -> Column:
    """Latitude within 90 degrees, longitude known, not both zero. Never null; NaN is unusable."""
    ok = lat.between(-90.0, 90.0) & lon.isNotNull() & ~F.isnan(lon) & ~((lat == 0) & (lon == 0))
    return F.coalesce(ok, F.lit(False))
