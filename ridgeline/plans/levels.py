"""From hourly rows to zone-day levels, reports and their archive."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions import elevation_band, shifted_day, zone_name
from ridgeline.operators.aggregate import (
    accuracy_table, daily_weather, shifted_day_mean, wide_to_long, zone_day_levels,
)
from ridgeline.operators.calendar import _ntz, missing_pairs, underfilled_days
from ridgeline.operators.checks import drop_all_sentinel
from ridgeline.operators.combine import (
    actual_and_predicted, training_rows, union_all, with_points, with_zone_prediction,
)
from ridgeline.operators.metrics import confusion_matrix, pair_counts, scores
from ridgeline.operators.resolve import distinct_rows, new_keys
from ridgeline.plans.models import predict
from ridgeline.schemas import BANDS, DROPPED_PROFILE_COLUMNS, PROFILE_KEYS, ZONE_ALIASES
from ridgeline.session import cut_lineage


def banded(df: DataFrame, points: DataFrame, strict: bool = False) -> DataFrame:
    """Rows with the zone of their point and the band of their altitude."""
    return with_points(df, points).withColumn("elevation_band", elevation_band(F.col("altitude"), strict))


def split_banded(df: DataFrame, points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``banded``: (rows in a band, rows whose altitude lies in none)."""
    rows = banded(df, points)
    inside = F.col("elevation_band").isNotNull()
    return rows.filter(inside), rows.filter(~inside)


def zone_levels(predictions: DataFrame, points: DataFrame) -> DataFrame:
    """Point predictions to one level per zone, band and slope."""
    return zone_day_levels(split_banded(predictions, points)[0])


def training_matrix(
    profile: DataFrame, points: DataFrame, observed: DataFrame, clip: int | None = None, replace_missing: bool = True
) -> DataFrame:
    """A2: P4, C5, A1, P7, J2, F5, J3, F1, F2 and F3 as one frame.

    Rows outside all bands or without an issued level are left to the caller:
    their band or level is null.
    """
    rows = drop_all_sentinel(profile) if replace_missing else profile
    return training_rows(shifted_day_mean(rows), points, observed, clip)


def missing_predictions(
    predictions: DataFrame,
    points: DataFrame,
    profile: DataFrame,
    model: PipelineModel,
    features: Sequence[str],
    today: date,
    slopes: int = 5,
    tolerance: int = 5,
    excluded: Sequence[int] = (),
) -> tuple[DataFrame, DataFrame]:
    """Predictions with the missing (day, id) pairs added, and their zone levels.

    ``profile`` holds the simulated hours. A whole day has a row for each slope
    of each point that is not excluded. A point without any row on a day is
    asked for whatever the other points have; one with some rows is asked for on
    days that lack more than ``tolerance`` rows. All pairs are averaged and
    scored in one job; the hours are cut to them first, and their range reaches
    the scan. Stored predictions are kept, new ones only fill what is missing.
    """
    pairs = cut_lineage(missing_pairs(predictions, points, slopes, tolerance, today, excluded=excluded), "pairs")
    first, last = pairs.agg(F.min("date"), F.max("date")).first()
    if first is None:
        return predictions, zone_levels(predictions, points)
    # No zone is further from UTC than a day, and a day is shifted by hours.
    margin = timedelta(days=2)
    in_range = (F.col("timestamp") >= _ntz(first - margin)) & (F.col("timestamp") < _ntz(last + margin))
    hourly = profile.drop(*DROPPED_PROFILE_COLUMNS).filter(in_range)
    wanted = hourly.withColumn("date", shifted_day(F.col("timestamp"))).join(pairs, ["date", "id"], "left_semi")
    fresh = cut_lineage(predict(model, shifted_day_mean(wanted.drop("date"), PROFILE_KEYS), features), "fresh")
    stored = predictions.filter(F.col("date").between(F.lit(first), F.lit(last)))
    fresh = new_keys(fresh, stored, ["date", *PROFILE_KEYS])
    together = predictions.unionByName(fresh, allowMissingColumns=True)
    return together, zone_levels(together, points)


def weather_of_day(
    predictions: DataFrame, points: DataFrame, zone_day: DataFrame, day: str | Column
) -> DataFrame:
    """A4 with J2, F1 and J4: the weather report of one day, steep slopes only.

    The day and slope filters come first, so they reach the scans.
    """
    wanted = (day if isinstance(day, Column) else F.lit(day)).cast("date")
    today = predictions.filter((F.col("slope_angle") == 38.0) & (F.col("date") == wanted))
    levels = zone_day.filter((F.col("slope_angle") == "slope") & (F.col("date") == wanted))
    return daily_weather(with_zone_prediction(split_banded(today, points)[0], levels))


def season_performance(observed: DataFrame, zone_day: DataFrame, zones: Sequence[str]) -> dict[str, DataFrame]:
    """M5: scores, both confusion matrices and the accuracy table of a season.

    The scores and matrices share one count of level pairs per zone and band,
    written once, so the rows are read a single time.
    """
    both = actual_and_predicted(observed, zone_day)
    cells = cut_lineage(
        pair_counts(both, "actual_danger", "predicted_danger", ["zone_name", "elevation_band"]), "pairs"
    )
    pairs = cells.groupBy("actual", "predicted").agg(F.sum("n").alias("n"))
    weighted = cells.withColumn("_hit", F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0))
    by_cell = weighted.groupBy("elevation_band", "zone_name").agg((F.sum("_hit") / F.sum("n")).alias("accuracy"))
    table = by_cell.groupBy("elevation_band").pivot("zone_name", list(zones)).agg(F.first("accuracy"))
    return {
        "scores": scores(pairs),
        "matrix": confusion_matrix(pairs),
        "normalised": confusion_matrix(pairs, normalise=True),
        "accuracy": table,
    }


def update_archive(
    archive: DataFrame, found: DataFrame, today: date, least: int = 3, aliases: Mapping[str, str] = ZONE_ALIASES
) -> tuple[DataFrame, DataFrame]:
    """(archive with the missing days added, the same one row per band).

    ``found`` holds levels read from stored pages; only days that lack zones
    take rows from it. The archive itself holds no copies, as this leaves it, and
    is not searched for any.
    """
    lacking = underfilled_days(archive, least, "date", today).select("date")
    fresh = found.select(*archive.columns).join(lacking, "date", "left_semi").distinct()
    # Rows that the archive has are compared with the few new ones, not with each other.
    whole = union_all([archive, new_keys(fresh, archive, archive.columns)])
    published = whole.withColumn("zone_name", zone_name(F.col("zone_name"), aliases))
    long = wide_to_long(published, ["zone_name", "date"], BANDS[::-1])
    return whole, distinct_rows(long.select("date", "zone_name", "elevation_band", "actual_danger")).withColumn(
        "slope_angle", F.lit("slope")
    )


__all__ = [
    "accuracy_table", "banded", "missing_predictions", "season_performance", "split_banded",
    "training_matrix", "update_archive", "weather_of_day", "zone_levels",
]
