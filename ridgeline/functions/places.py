"""Compass and position expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["aspect", "midpoint_lat", "midpoint_lon", "squared_distance", "tile"]


def aspect(degrees: Column) -> Column:
    """N, E, S or W of an azimuth in degrees, any turn."""
    turn = F.pmod(degrees, F.lit(360.0))
    return (
        F.when((turn >= 315) | (turn < 45), "N")
        .when(turn < 135, "E")
        .when(turn < 225, "S")
        .otherwise("W")
    )


def _midpoint_vector(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> tuple[Column, ...]:
    a, b = F.radians(lat1), F.radians(lat2)
    turn = F.radians(lon2 - lon1)
    bx, by = F.cos(b) * F.cos(turn), F.cos(b) * F.sin(turn)
    return a, b, bx, by


def midpoint_lat(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """latitude half way along the great circle.

    The sphere stands in for the WGS84 ellipsoid; for points a few kilometres
    apart the two midpoints differ by less than a metre.
    """
    a, b, bx, by = _midpoint_vector(lat1, lon1, lat2, lon2)
    return F.degrees(F.atan2(F.sin(a) + F.sin(b), F.hypot(F.cos(a) + bx, by)))


def midpoint_lon(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """longitude half way along the great circle, in [-180, 180)."""
    a, _, bx, by = _midpoint_vector(lat1, lon1, lat2, lon2)
    return F.pmod(lon1 + F.degrees(F.atan2(by, F.cos(a) + bx)) + 180, F.lit(360.0)) - 180


def squared_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Planar squared distance in degrees, the order used for nearest cells."""
    return (lat1 - lat2) * (lat1 - lat2) + (lon1 - lon2) * (lon1 - lon2)


def tile(c: Column, side: float) -> Column:
    """Index of the tile of width ``side`` that holds a coordinate."""
    return F.floor(c / F.lit(float(side))).cast("bigint")
