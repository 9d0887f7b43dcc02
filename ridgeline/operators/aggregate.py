"""Aggregations (A1 to A11) and reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.functions import (
    celsius_to_fahrenheit, cm_to_inches, local_midnight_epoch, mm_to_inches, ms_to_mph,
    round_columns, sentinel_to_null, shifted_day, slope_label,
)
from ridgeline.operators.checks import measure_columns
from ridgeline.schemas import (
    BANDS, DAILY_WEATHER, DAY_START_HOUR, LOCAL_ZONE, PROFILE_KEYS, REPORT_DECIMALS, REPORT_UNITS,
)


def shifted_day_mean(
    df: DataFrame,
    keys: Sequence[str] = tuple(PROFILE_KEYS),
    time_col: str = "timestamp",
    measures: Sequence[str] | None = None,
    zone: str = LOCAL_ZONE,
    start_hour: int = DAY_START_HOUR,
) -> DataFrame:
    """A1: mean of every measure per key and local day from 19:00 to 19:00.

    The sentinel is read as null and nulls are skipped. The date is the right
    edge of the day. The mean is built from partial sums on the map side.
    """
    measures = list(measures or measure_columns(df, [*keys, time_col]))
    day = shifted_day(F.col(time_col), zone, start_hour).alias("date")
    return df.filter(F.col(time_col).isNotNull()).groupBy(*keys, day).agg(
        *[F.avg(sentinel_to_null(F.col(c))).alias(c) for c in measures]
    )


def mode_highest(df: DataFrame, keys: Sequence[str], value: str, name: str | None = None) -> DataFrame:
    """A3: the most frequent value per key, the highest one on a tie.

    Values are counted first, so what is compared per key is one row per
    distinct value, not the rows themselves. A key with null values only gives
    null.
    """
    counts = df.groupBy(*keys, value).agg(F.count(value).alias("_n"))
    best = F.max(F.struct("_n", value)).getField(value)
    return counts.groupBy(*keys).agg(best.alias(name or value))


def zone_day_levels(df: DataFrame, value: str = "predicted_danger") -> DataFrame:
    """A3 with F4: one level per date, zone, band and flat or slope."""
    labelled = df.withColumn("slope_angle", slope_label(F.col("slope_angle")))
    return mode_highest(labelled, ["date", "zone_name", "elevation_band", "slope_angle"], value)


#: Conversions by their names in ``REPORT_UNITS``.
_CONVERSIONS = {"fahrenheit": celsius_to_fahrenheit, "mph": ms_to_mph, "cm to inches": cm_to_inches, "mm to inches": mm_to_inches}


def daily_weather(
    df: DataFrame,
    summary: Mapping[str, tuple[str, str]] = DAILY_WEATHER,
    decimals: Mapping[str, int] = REPORT_DECIMALS,
    zone: str = LOCAL_ZONE,
) -> DataFrame:
    """A4: weather per date, zone, band and slope, in the units of the report.

    ``df`` has the zone, band and zone level joined already. Columns of the
    summary whose source is absent are left out.
    """
    keys = ["date", "zone_name", "elevation_band", "slope_angle", "slope_azi"]
    build = {"avg": F.avg, "max": F.max, "sum": F.sum}
    present = {out: spec for out, spec in summary.items() if spec[0] in df.columns}
    daily = df.groupBy(*keys).agg(*[build[how](src).alias(out) for out, (src, how) in present.items()])
    daily = daily.withColumns({c: _CONVERSIONS[unit](F.col(c)) for c, unit in REPORT_UNITS.items() if c in present})
    # Partial sums arrive in any order; dropping their noise first keeps the
    # rounding of ties the same on every run.
    daily = daily.withColumns({c: F.round(c, 9) for c in decimals if c in present})
    daily = daily.withColumns(round_columns(decimals, daily.columns))
    return daily.withColumn("date_epoch", local_midnight_epoch(F.col("date"), zone))


def group_size(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A5: rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def time_span(df: DataFrame, time_col: str = "time") -> DataFrame:
    """First and last stamp of a table."""
    return df.agg(F.min(time_col).alias("first_time"), F.max(time_col).alias("last_time"))


def value_shares(df: DataFrame, value: str, within: Sequence[str] = ()) -> DataFrame:
    """Count and share of every value, in the table or inside groups.

    Inside groups a window sums the counts of a group. In the table the total is
    one number, counted beside them, so no task holds all distinct values.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*within, value).agg(F.count(F.lit(1)).alias("n"))
    if within:
        return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*within)))
    total = df.agg(F.count(value).alias("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column."""
    return df.select(column).distinct()


def group_accuracy(
    df: DataFrame, keys: Sequence[str], actual: str = "actual_danger", predicted: str = "predicted_danger"
) -> DataFrame:
    """A10: share of equal levels per group."""
    return df.groupBy(*keys).agg(
        F.avg((F.col(actual) == F.col(predicted)).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("n"),
    )


def latest_day(df: DataFrame, date_col: str = "date", zone: str = LOCAL_ZONE) -> DataFrame:
    """Epoch of the latest day, null for an empty table."""
    return df.agg(local_midnight_epoch(F.max(date_col), zone).alias("latest_day"))


def wide_to_long(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "elevation_band", value: str = "actual_danger"
) -> DataFrame:
    """One row per listed column."""
    return df.unpivot(list(ids), list(values), name, value)


def long_to_wide(
    df: DataFrame, keys: Sequence[str], name: str, value: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """One column per name. Naming the columns saves a pass."""
    grouped = df.groupBy(*keys)
    pivoted = grouped.pivot(name, list(columns)) if columns else grouped.pivot(name)
    return pivoted.agg(F.first(value, ignorenulls=True))


def one_hot(df: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """A 0/1 column per category in place of the source columns."""
    flags: list[Column] = []
    for source, names in categories.items():
        flags += [
            F.when(F.col(source) == n, F.lit(1)).otherwise(F.lit(0)).alias(f"{source}_{n}") for n in names
        ]
    return df.select(*[c for c in df.columns if c not in categories], *flags)


def accuracy_table(
    df: DataFrame, zones: Sequence[str], actual: str = "actual_danger", predicted: str = "predicted_danger"
) -> DataFrame:
    """M4: accuracy with bands as rows, lowest first, and zones as columns.

    A zone without rows in a band is null there.
    """
    cells = group_accuracy(df, ["elevation_band", "zone_name"], actual, predicted)
    wide = long_to_wide(cells, ["elevation_band"], "zone_name", "accuracy", zones)
    order = F.array_position(F.array(*[F.lit(b) for b in BANDS]), F.col("elevation_band"))
    return wide.orderBy(order)
