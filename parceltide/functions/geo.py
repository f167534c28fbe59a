"""Great-circle distance as a native expression."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from parceltide.contracts import EARTH_RADIUS_KM


def haversine_km(lat_a: Column, lng_a: Column, lat_b: Column, lng_b: Column) -> Column:
    """Kilometres between two points; NULL when any coordinate is NULL.

    The chord term is clamped to [0, 1] so rounding noise at antipodes cannot
    leave the domain of asin. ``greatest``/``least`` skip NULLs, hence the guard.
    """
    half_lat = F.sin((F.radians(lat_b) - F.radians(lat_a)) / 2)
    half_lng = F.sin((F.radians(lng_b) - F.radians(lng_a)) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_lng * half_lng
    known = lat_a.isNotNull() & lng_a.isNotNull() & lat_b.isNotNull() & lng_b.isNotNull()
    clamped = F.least(F.lit(1.0), F.greatest(F.lit(0.0), chord))
    return F.when(known, F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(clamped)))


def within(column: Column, bounds: tuple[float, float]) -> Column:
    return column.between(*bounds)
