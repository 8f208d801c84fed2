"""Great-circle and grid distances as native column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in miles; the inner term is clipped to [0, 1]."""
    dphi = F.radians(lat2 - lat1)
    dlmb = F.radians(lon2 - lon1)
    a = (F.pow(F.sin(dphi / 2.0), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlmb / 2.0), 2))
    a = F.least(F.greatest(a, F.lit(0.0)), F.lit(1.0))
    return F.lit(2.0 * C.EARTH_RADIUS_MILES) * F.asin(F.sqrt(a))


def manhattan_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """L1 distance: 69 miles per degree, longitude scaled by cos(mid latitude)."""
    mid = F.radians((lat1 + lat2) / 2.0)
    return (F.abs(lat2 - lat1) * F.lit(C.MILES_PER_DEGREE)
            + F.abs(lon2 - lon1) * F.lit(C.MILES_PER_DEGREE) * F.cos(mid))
