"""Geographic column expressions (JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str,
                 radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km; NULL when any input is NULL.

    Half the chord, squared, may round to above 1 for opposite points; it is clamped
    by comparison, which leaves NULL as NULL.
    """
    here, there = [tuple(F.col(c) if isinstance(c, str) else c for c in point) for point in ((lat1, lon1), (lat2, lon2))]
    north, east = (F.sin(F.radians(to - frm) / 2) for frm, to in zip(here, there))
    chord = north * north + east * east * F.cos(F.radians(here[0])) * F.cos(F.radians(there[0]))
    angle = 2 * F.asin(F.sqrt(F.when(chord > 1, F.lit(1.0)).otherwise(chord)))
    return angle * F.lit(radius_km)


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str, radius_km: float = EARTH_RADIUS_KM) -> str:
    """The same formula as SQL text (for the DuckDB oracle)."""
    a = (f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
         f" * pow(sin(radians({lon2} - {lon1}) / 2), 2))")
    return f"({2 * radius_km} * asin(sqrt(CASE WHEN {a} IS NOT NULL THEN least(1.0, {a}) END)))"
