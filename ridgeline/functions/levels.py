"""Elevation bands, ordinal levels, zones and their labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridgeline.schemas import (
    BAND_EDGES_FEET, BANDS, FEET_PER_METRE, LEVEL_CODES, LEVEL_COLOURS, LEVEL_NAMES, ZONE_ALIASES,
)

__all__ = [
    "elevation_band", "band_rank", "level_for_band", "clip_level", "slope_label", "zone_name",
    "training_zone", "label_band", "label_level", "level_name", "level_code", "level_colour",
    "shift_label", "unshift_label", "cumulative_targets", "most_likely_class", "lookup",
]


def lookup(key: Column, table: Mapping, default: Column | None = None) -> Column:
    """A fixed small table as one literal map; unknown keys give ``default``."""
    pairs = [F.lit(part) for pair in table.items() for part in pair]
    found = F.try_element_at(F.create_map(*pairs), key)
    return found if default is None else F.coalesce(found, default)


def elevation_band(altitude: Column, strict: bool = False) -> Column:
    """band of an altitude in metres; null outside all bands.

    ``strict`` raises instead, otherwise the caller routes nulls to rejects.
    """
    edges = [feet / FEET_PER_METRE for feet in BAND_EDGES_FEET]
    band = F.lit(None).cast("string")
    for name, low, high in reversed(list(zip(BANDS, edges[:-1], edges[1:]))):
        band = F.when((altitude >= low) & (altitude < high), F.lit(name)).otherwise(band)
    if strict:
        message = F.concat(F.coalesce(altitude.cast("string"), F.lit("null")), F.lit(" lies in no elevation band"))
        return F.coalesce(band, F.raise_error(message).cast("string"))
    return band


def band_rank(band: Column) -> Column:
    """Order of a band, lower first."""
    return lookup(band, {name: i for i, name in enumerate(BANDS)})


def level_for_band(band: Column, columns: Mapping[str, Column]) -> Column:
    """pick the level from the column the band names."""
    picked = F.lit(None).cast("int")
    for name, column in columns.items():
        picked = F.when(band == name, column).otherwise(picked)
    return picked


def clip_level(level: Column, top: int = 3) -> Column:
    """levels at or above ``top`` become ``top``."""
    return F.when(level >= top, F.lit(top)).otherwise(level)


def slope_label(angle: Column) -> Column:
    """flat for angle 0, else slope."""
    return F.when(angle == 0, F.lit("flat")).otherwise(F.lit("slope"))


def zone_name(alias: Column, aliases: Mapping[str, str] = ZONE_ALIASES, strict: bool = True) -> Column:
    """published zone name; an unknown spelling raises or gives null."""
    key = F.lower(F.trim(alias))
    found = lookup(key, aliases)
    if not strict:
        return found
    message = F.concat(F.lit("unknown zone: "), F.coalesce(alias, F.lit("null")))
    return F.coalesce(found, F.raise_error(message).cast("string"))


def training_zone(name: Column) -> Column:
    """the lower-case spelling the training labels use."""
    lowered = F.lower(name)
    return F.when(lowered == "glacier/flathead", F.lit("flathead")).otherwise(lowered)


def label_band(text: Column) -> Column:
    """band of a page label such as ``Mid-Elevation``."""
    head = F.trim(F.lower(F.split_part(text, F.lit("Elevation"), F.lit(1))))
    return F.when(head == "mid-", "middle").when(head == "low", "lower").otherwise(head)


def label_level(text: Column) -> Column:
    """number in front of a page label such as ``2 - Moderate``."""
    return F.trim(F.split_part(text, F.lit(" - "), F.lit(1))).try_cast("int")


def level_name(level: Column) -> Column:
    """name of a level, Unknown if there is none."""
    return lookup(level.cast("int"), LEVEL_NAMES, F.lit(LEVEL_NAMES[-1]))


def level_code(level: Column) -> Column:
    """short code of a level."""
    return lookup(level.cast("int"), LEVEL_CODES, F.lit(LEVEL_CODES[-1]))


def level_colour(shifted: Column) -> Column:
    """map colour of a level counted from 0."""
    return lookup(shifted.cast("int"), LEVEL_COLOURS)


def shift_label(level: Column) -> Column:
    """levels 1 to 4 as classes 0 to 3."""
    return level - 1


def unshift_label(label: Column) -> Column:
    """classes 0 to 3 as levels 1 to 4."""
    return label + 1


def cumulative_targets(level: Column, thresholds: Sequence[int] = (1, 2, 3)) -> list[Column]:
    """one 0/1 column ``le_k`` per threshold: is the level at most k."""
    return [(level <= k).cast("int").alias(f"le_{k}") for k in thresholds]


def most_likely_class(probabilities: Column, first: int = 0) -> Column:
    """position of the largest probability, the first one on a tie."""
    return (F.array_position(probabilities, F.array_max(probabilities)) - 1 + first).cast("int")
