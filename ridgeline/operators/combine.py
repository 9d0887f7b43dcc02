"""Joins and set operations.

No join carries a broadcast hint. Spark broadcasts a side whose measured size
is under ``spark.sql.autoBroadcastJoinThreshold`` and sorts and merges
otherwise, with skewed partitions split at run time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions import elevation_band, level_for_band, training_zone
from ridgeline.schemas import BANDS
from ridgeline.session import cut_lineage

MERGE_KEYS = ("valid_time", "time", "step", "point_id")


def merge_groups(
    groups: Sequence[DataFrame | Sequence[DataFrame]], keys: Sequence[str] = MERGE_KEYS
) -> DataFrame:
    """Full outer merge of variable groups.

    A group given as several frames was requested in parts, which are stacked.
    Copies of a row count once, so copies of one key cannot multiply; different
    rows of a key give a row for each combination. A column two groups share gets
    the group number as suffix. A row with a null key meets no other.

    All groups are stacked with a slot for each of their columns and reduced by
    one aggregate of least and greatest values on the map side, so there is one
    shuffle whatever the number of groups. Keys for which some group has rows that
    differ, which is not the rule, are put together again from their rows. Writes
    the aggregate once.
    """
    keys = list(keys)
    stacked = [
        group if isinstance(group, DataFrame) else union_all(group) for group in groups
    ]
    seen: dict[str, int] = {}
    for frame in stacked:
        for c in set(frame.columns) - set(keys):
            seen[c] = seen.get(c, 0) + 1
    parts = [
        frame.withColumnsRenamed({c: f"{c}_{i}" for c in frame.columns if c not in keys and seen[c] > 1})
        for i, frame in enumerate(stacked)
    ]
    slots = [[c for c in part.columns if c not in keys] for part in parts]
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    both = reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True),
        [part.select(*keys, *own, F.lit(i).alias("_slot")) for i, (part, own) in enumerate(zip(parts, slots))],
    )
    columns = [c for own in slots for c in own]
    sums, differs = [], F.lit(False)
    for i, own in enumerate(slots):
        here = F.col("_slot") == i
        sums.append(F.count(F.when(here, 1)).alias(f"_n_{i}"))
        for c in own:
            sums += [F.min(c).alias(c), F.max(c).alias(f"_most_{c}"), F.count(c).alias(f"_n_{c}")]
            # One value and no null among the rows of the group, or nulls only.
            same = (F.col(f"_n_{c}") == 0) | ((F.col(f"_n_{c}") == F.col(f"_n_{i}")) & F.col(c).eqNullSafe(F.col(f"_most_{c}")))
            differs = differs | ~same
    folded = cut_lineage(both.filter(known).groupBy(*keys).agg(*sums).withColumn("_differs", differs), "merged")
    single = folded.filter("not _differs").select(*keys, *columns)
    lone = both.filter(~known).distinct().select(*keys, *columns)
    several = folded.filter("_differs").select(*keys)
    if several.isEmpty():
        return single.unionByName(lone)
    rows = both.filter(known).join(several, keys, "left_semi")
    sets = rows.groupBy(*keys).agg(*[
        F.collect_set(F.when(F.col("_slot") == i, F.struct(F.lit(i).alias(f"_s_{i}"), *own))).alias(f"_rows_{i}") for i, own in enumerate(slots)
    ])
    for i in range(len(slots)):
        sets = sets.withColumn(f"_row_{i}", F.explode_outer(f"_rows_{i}"))
    whole = sets.select(*keys, *[F.col(f"_row_{i}.{c}").alias(c) for i, own in enumerate(slots) for c in own])
    return single.unionByName(whole).unionByName(lone)


def with_points(df: DataFrame, points: DataFrame, columns: Sequence[str] = ("zone_name",)) -> DataFrame:
    """Rows with the attributes of their point; unknown points drop out."""
    return df.join(points.select("id", *columns), "id")


def with_wide_levels(df: DataFrame, observed: DataFrame, bands: Sequence[str] = tuple(BANDS)) -> DataFrame:
    """Rows with the levels issued for their zone and day, one column per band."""
    return df.join(observed.select("date", "zone_name", *bands), ["date", "zone_name"])


def with_zone_prediction(df: DataFrame, zone_day: DataFrame) -> DataFrame:
    """Rows with the level of their zone, day and band.

    The level of the point and the slope label of the zone are not wanted, so
    neither side carries them into the join.
    """
    keys = ["date", "zone_name", "elevation_band"]
    level = zone_day.select(*keys, "predicted_danger")
    return df.drop("predicted_danger").join(level, keys)


def actual_and_predicted(observed: DataFrame, zone_day: DataFrame, how: str = "inner") -> DataFrame:
    """Observed beside predicted levels of zone, day and band, slopes only."""
    keys = ["zone_name", "date", "elevation_band"]
    predicted = zone_day.filter(F.col("slope_angle") == "slope").select(*keys, "predicted_danger")
    return observed.select(*keys, "actual_danger").join(predicted, keys, how)


def with_outline(df: DataFrame, zones: DataFrame) -> DataFrame:
    """Zone rows with the outline of their zone."""
    return df.join(zones, "zone_name")


def complete_bands(df: DataFrame, zone: str = "zone_name", band: str = "elevation_band", bands: Sequence[str] = tuple(BANDS)) -> DataFrame:
    """Every zone with every band; measures are null where there was no row.

    The bands are a fixed list, so a zone is expanded in place instead of being
    joined with all bands.
    """
    zones = df.select(zone).distinct().withColumn(band, F.explode(F.array(*[F.lit(b) for b in bands])))
    return zones.join(df, [zone, band], "left")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_rows(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows, or any one row per key."""
    return df.dropDuplicates(list(keys)) if keys else df.distinct()


def rows_without(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``df`` that ``other`` lacks."""
    return df.select(*keys).distinct().join(other.select(*keys), list(keys), "left_anti")


def label_values(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """All levels that occur in either column."""
    return df.select(F.col(actual).alias("level")).distinct().union(
        df.select(F.col(predicted).alias("level")).distinct()
    ).distinct()


def training_rows(
    averages: DataFrame, points: DataFrame, observed: DataFrame, clip: Column | int | None = None
) -> DataFrame:
    """A2 from J2 on: daily features with band and level, one frame.

    ``observed`` holds one column per band and the training zone spelling. Days
    without an issued level drop out in a semi join before the wider joins.
    """
    days = observed.select("date").distinct()
    rows = averages.join(days, "date", "left_semi")
    rows = with_points(rows, points).withColumn("zone_name", training_zone(F.col("zone_name")))
    rows = with_wide_levels(rows, observed)
    rows = rows.withColumn("elevation_band", elevation_band(F.col("altitude")))
    rows = rows.withColumn("danger_level", level_for_band(F.col("elevation_band"), {b: F.col(b) for b in BANDS}))
    if clip is not None:
        rows = rows.withColumn("danger_level", F.least("danger_level", F.lit(clip)))
    return rows.drop(*BANDS)
