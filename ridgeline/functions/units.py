"""Unit conversions and rounding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridgeline.schemas import SENTINEL

__all__ = [
    "celsius_to_fahrenheit", "ms_to_mph", "cm_to_inches", "mm_to_inches", "percent_to_fraction",
    "rate_to_hourly", "round_even", "sentinel_to_null", "wind_speed", "wind_direction",
    "as_percent", "fixed_decimals", "round_columns",
]


def celsius_to_fahrenheit(c: Column) -> Column:
    return c * 9 / 5 + 32


def ms_to_mph(c: Column) -> Column:
    return c * 2.23694


def cm_to_inches(c: Column) -> Column:
    return c * 0.393701


def mm_to_inches(c: Column) -> Column:
    return c / 25.4


def percent_to_fraction(c: Column) -> Column:
    return c / 100


def rate_to_hourly(c: Column) -> Column:
    """kg/m2/s, which is mm/s of water, to mm/h."""
    return c * 3600


def round_even(c: Column, digits: int = 0) -> Column:
    """F8: round half to even."""
    return F.bround(c, digits)


def round_columns(decimals: Mapping[str, int], present: Sequence[str]) -> dict[str, Column]:
    """F8 over a table: decimals for columns that do not exist are ignored."""
    return {c: round_even(F.col(c), n) for c, n in decimals.items() if c in present}


def sentinel_to_null(c: Column, sentinel: float = SENTINEL) -> Column:
    """The missing-value mark becomes null."""
    return F.nullif(c, F.lit(sentinel))


def wind_speed(u: Column, v: Column) -> Column:
    """F16: speed from eastward and northward components."""
    return F.hypot(u, v)


def wind_direction(u: Column, v: Column) -> Column:
    """F16: direction the wind blows from, degrees clockwise from north."""
    return F.pmod(F.lit(270.0) - F.degrees(F.atan2(v, u)), F.lit(360.0))


def as_percent(c: Column, digits: int = 2) -> Column:
    """a share as text with a percent sign."""
    return F.concat(fixed_decimals(c * 100, digits), F.lit("%"))


def fixed_decimals(c: Column, digits: int) -> Column:
    """a number as text with fixed decimals.

    The pattern form rounds the binary value; ``format_string`` would round its
    shortest decimal form and turn 0.35 into 0.4.
    """
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function("format_number", c, F.lit(pattern))
