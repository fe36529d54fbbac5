"""Distances in metres and grid cells as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METRES_LAT, METRES_LON = 110_574.0, 111_320.0


def flat_metres(lon: Column, lat: Column, lon2: Column, lat2: Column) -> Column:
    """Equirectangular distance, good within a city."""
    x = (lon - lon2) * METRES_LON * F.cos(F.radians(lat))
    y = (lat - lat2) * METRES_LAT
    return F.sqrt(x * x + y * y)


def haversine(lon: Column, lat: Column, lon2: Column, lat2: Column, radius: float = 6_371_000.0) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat) / 2), F.lit(2)) + F.cos(F.radians(lat)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon) / 2), F.lit(2))
    return 2 * radius * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def cell(x: Column, size: float) -> Column:
    return F.floor(x / size).cast("bigint")


def bearing(lon: Column, lat: Column, lon2: Column, lat2: Column) -> Column:
    """Degrees clockwise from north, of the flat way from one point to another."""
    return (F.degrees(F.atan2((lon2 - lon) * METRES_LON * F.cos(F.radians(lat)), (lat2 - lat) * METRES_LAT)) + 360) % 360


def sector(degrees: Column) -> Column:
    """One of the eight: N, NE, E, SE, S, SW, W, NW."""
    return F.element_at(F.array(*map(F.lit, ("N", "NE", "E", "SE", "S", "SW", "W", "NW"))), (F.floor((degrees + 22.5) / 45) % 8).cast("int") + 1)


def spatial_factor(metres: Column, inside: Column) -> Column:
    """How far a name's distance from a footprint lowers its confidence."""
    return F.when(inside, 1.0).when(metres <= 10, 0.9).when(metres <= 25, 0.75).when(metres <= 50, 0.55).otherwise(0.3)


def centroid_id(prefix: Column, lon: Column, lat: Column) -> Column:
    """An id that lasts while the centroid stays within some 0.1 m."""
    return F.concat(prefix, F.lit("-"), F.substring(F.sha1(F.format_string("%.6f,%.6f", lon, lat)), 1, 10))
