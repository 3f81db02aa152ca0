"""Coordinate arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.constants import KM_PER_DEGREE


def interpolate(start: Column, end: Column, progress: Column) -> Column:
    """start + (end - start) * progress."""
    return start + (end - start) * progress


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """planar approximation sqrt(dlat^2 + dlon^2) * 111."""
    dlat, dlon = lat2 - lat1, lon2 - lon1
    return F.sqrt(dlat * dlat + dlon * dlon) * F.lit(KM_PER_DEGREE)
