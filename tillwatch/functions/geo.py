"""Great-circle distance and travel speed as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Kilometres between two points; 0.0 when any coordinate is NULL."""
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_dlat), F.lit(2.0)) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_dlon), F.lit(2.0))
    )
    # Rounding can push the chord of antipodes just past 1, and a latitude beyond the
    # poles can make it negative; neither may end in a NaN.
    angle = F.lit(2.0) * F.atan2(
        F.sqrt(F.greatest(chord, F.lit(0.0))), F.sqrt(F.abs(F.lit(1.0) - chord))
    )
    return F.coalesce(F.lit(EARTH_RADIUS_KM) * angle, F.lit(0.0))


def speed_kmh(distance_km: Column, since: Column, until: Column) -> Column:
    """Speed over the time between two timestamps; 0.0 when the time is unknown or
    does not run forward."""
    hours = (F.unix_micros(until) - F.unix_micros(since)) / F.lit(3_600_000_000.0)
    return F.when(hours > 0, distance_km / hours).otherwise(F.lit(0.0))
