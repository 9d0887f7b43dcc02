"""Row repair of hourly series.

Repairs touch few rows. The keys that need one are found first and written, so
their size is known; the large table is then joined to them, which Spark plans
as a broadcast while they are few and as a sorted join when they are many. In
the usual case no hour of the large table is shuffled. All joins include the
hour, so a point with a very long history is spread like any other rows, and
copies of a row are reduced on the map side.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions import hours, percent_to_fraction, rate_to_hourly
from ridgeline.operators.calendar import _ntz, missing_intervals, single_gaps
from ridgeline.operators.checks import any_null, measure_columns
from ridgeline.operators.resolve import distinct_rows, first_of_key
from ridgeline.schemas import HOURLY_KEYS, SUMMER_MONTHS
from ridgeline.session import cut_lineage


def neighbour_means(
    df: DataFrame,
    wanted: DataFrame,
    keys: Sequence[str] = ("point_id", "fxx"),
    time_col: str = "time",
    measures: Sequence[str] | None = None,
    usable: Callable[[str], Column] = F.col,
) -> DataFrame:
    """For each wanted key and hour the values one hour before and after.

    Gives ``before_c`` and ``after_c`` per measure, null where that exact hour
    has no usable value. Equal hours are averaged; a wanted hour without rows
    on either side is left out. ``usable`` may turn a value into null.
    """
    measures = list(measures or measure_columns(df, [*HOURLY_KEYS, time_col]))
    sides = F.explode(F.array(F.lit(-1), F.lit(1)))
    asked = wanted.select(*keys, F.col(time_col).alias("_at")).withColumn("_side", sides).withColumn(
        time_col, F.col("_at") + hours(F.col("_side"))
    )
    before, after = F.col("_side") == -1, F.col("_side") == 1
    columns = []
    for c in measures:
        columns.append(F.avg(F.when(before, usable(c))).alias(f"before_{c}"))
        columns.append(F.avg(F.when(after, usable(c))).alias(f"after_{c}"))
    found = df.select(*keys, time_col, *measures).join(asked, [*keys, time_col])
    return found.groupBy(*keys, F.col("_at").alias(time_col)).agg(*columns)


def repair_outliers(
    df: DataFrame,
    time_col: str = "time",
    keys: Sequence[str] = ("point_id", "fxx"),
    measures: Sequence[str] | None = None,
    low: float = -10.0,
    high: float = 1000.0,
) -> DataFrame:
    """Replace values outside [low, high] by the mean of the hours next to them.

    Only raw neighbours exactly one hour away and themselves in range count;
    with one such neighbour its value is taken, with none the value becomes
    null. ``unrepaired`` counts the values of a row that became null. Writes
    the hours with a bad value once.
    """
    measures = list(measures or measure_columns(df, [*HOURLY_KEYS, time_col]))
    if not measures:
        return df.withColumn("unrepaired", F.lit(0))

    def bad(c: str) -> Column:
        return F.coalesce((F.col(c) < low) | (F.col(c) > high), F.lit(False))

    any_bad = bad(measures[0])
    for c in measures[1:]:
        any_bad = any_bad | bad(c)
    hit = cut_lineage(df.filter(any_bad).select(*keys, time_col).distinct(), "outliers")
    near = neighbour_means(df, hit, keys, time_col, measures, lambda c: F.when(~bad(c), F.col(c)))
    near = cut_lineage(near, "neighbours")
    rows = df.join(near, [*keys, time_col], "left")

    def repaired(c: str) -> Column:
        before, after = F.col(f"before_{c}"), F.col(f"after_{c}")
        mean = F.coalesce((before + after) / 2, before, after)
        return F.when(bad(c), mean).otherwise(F.col(c))

    lost = [(bad(c) & repaired(c).isNull()).cast("int") for c in measures]
    unrepaired = lost[0]
    for part in lost[1:]:
        unrepaired = unrepaired + part
    return rows.select(
        *[repaired(c).alias(c) if c in measures else F.col(c) for c in df.columns], unrepaired.alias("unrepaired")
    )


def interpolated_hours(
    df: DataFrame,
    time_col: str = "time",
    keys: Sequence[str] = ("point_id", "fxx"),
    measures: Sequence[str] | None = None,
    off_months: Sequence[int] = SUMMER_MONTHS,
) -> DataFrame:
    """Rows for single missing hours between two present ones.

    Measures are the mean of both sides; ``valid_time`` is the hour plus the
    lead. Longer gaps give no row. Gaps come from the day masks, which carry no
    measures, and are written once.
    """
    measures = list(measures or measure_columns(df, [*HOURLY_KEYS, time_col]))
    gaps = cut_lineage(single_gaps(df.select(*keys, time_col), keys, time_col, off_months), "gaps")
    return _interpolated(df, gaps, time_col, keys, measures)


def _interpolated(df: DataFrame, gaps: DataFrame, time_col: str, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    near = neighbour_means(df, gaps, keys, time_col, measures)
    out = near.select(
        *keys, time_col, *[((F.col(f"before_{c}") + F.col(f"after_{c}")) / 2).alias(c) for c in measures]
    )
    if "valid_time" in df.columns and time_col != "valid_time" and "fxx" in keys:
        out = out.withColumn("valid_time", F.col(time_col) + hours(F.col("fxx").cast("int")))
    return out


def fill_single_hours(df: DataFrame, time_col: str = "time", keys: Sequence[str] = ("point_id", "fxx")) -> DataFrame:
    """The table with its interpolated rows."""
    return df.unionByName(interpolated_hours(df, time_col, keys), allowMissingColumns=True)


def repair_gaps(df: DataFrame, time_col: str = "time", keys: Sequence[str] = ("point_id", "fxx")) -> DataFrame:
    """Rows with a null count as missing; fill single hours, keep whole rows.

    Gaps come from the keys and stamps alone. Only the rows next to a gap are
    freed of copies before they are averaged; the table itself is resolved in
    two phases, and hours that were missing add no copies.
    """
    whole = df.filter(~any_null(df.columns))
    measures = measure_columns(df, [*HOURLY_KEYS, time_col])
    gaps = cut_lineage(single_gaps(whole.select(*keys, time_col), keys, time_col), "gaps")
    sides = F.explode(F.array(F.lit(-1), F.lit(1)))
    beside = gaps.withColumn("_side", sides).select(*keys, (F.col(time_col) + hours(F.col("_side"))).alias(time_col)).distinct()
    around = whole.join(beside, [*keys, time_col], "left_semi").select(*df.columns).distinct()
    filled = _interpolated(around, gaps, time_col, keys, measures)
    return distinct_rows(whole).unionByName(filled, allowMissingColumns=True).na.drop("any")


def first_per_stamp(
    df: DataFrame, rank: str | Column, keys: Sequence[str] = ("point_id", "time")
) -> DataFrame:
    """C4: one row per key, the one with the lowest rank.

    Equal ranks are settled by the remaining columns in order. Only keys with
    several rows are grouped.
    """
    rank = F.col(rank) if isinstance(rank, str) else rank
    return first_of_key(df, keys, rank).select(*df.columns)


def station_units(df: DataFrame) -> DataFrame:
    """Relative humidity as a fraction, precipitation rate per hour."""
    return df.withColumns({"r2": percent_to_fraction(F.col("r2")), "prate": rate_to_hourly(F.col("prate"))})


def splice(past: DataFrame, forecast: DataFrame, day: str, keys: Sequence[str] = ("point_id",)) -> DataFrame:
    """Observed rows up to ``day`` and forecast rows valid on that day.

    Forecast rows take their valid time as time. Where both have the first
    hour of the day the observed row is kept. Of the past only keys and stamps
    are grouped; its rows are not moved but where a stamp has several.
    """
    until = _ntz(day)
    seen = past.filter(F.col("time") <= until).withColumn("_source", F.lit(0))
    ahead = (
        forecast.filter(F.col("valid_time").cast("date") == until.cast("date"))
        .withColumn("time", F.col("valid_time"))
        .withColumn("_source", F.lit(1))
    )
    # Only points with a past are spliced.
    ahead = ahead.join(seen.select(*keys).distinct(), list(keys), "left_semi")
    both = seen.unionByName(ahead, allowMissingColumns=True)
    return first_per_stamp(both, "_source", [*keys, "time"]).drop("_source")


def checked_splice(
    past: DataFrame, forecast: DataFrame, day: str, keys: Sequence[str] = ("point_id",)
) -> tuple[DataFrame, DataFrame]:
    """U2 with P13: (spliced rows of whole series, points in quarantine with what is wrong).

    A series is whole if it lacks no hour between its first and last stamp and
    ends with the last hour of ``day``. Gaps are counted as intervals. The
    spliced rows are written once.
    """
    both = cut_lineage(splice(past, forecast, day, keys), "spliced")
    keys, end = list(keys), _ntz(day).cast("date").cast("timestamp_ntz") + hours(23)
    lacking = missing_intervals(both, keys, "time").groupBy(*keys).agg(F.sum("n_hours").alias("missing_hours"))
    ends = both.groupBy(*keys).agg(F.max("time").alias("last_time")).join(lacking, keys, "left")
    wrong = ends.withColumn("missing_hours", F.coalesce("missing_hours", F.lit(0).cast("bigint")))
    wrong = cut_lineage(wrong.filter((F.col("missing_hours") > 0) | (F.col("last_time") != end)), "quarantine")
    return both.join(wrong.select(*keys), keys, "left_anti"), wrong


def merge_runs(parts: Sequence[DataFrame], time_col: str = "timestamp", key: str = "id") -> DataFrame:
    """Union of simulator outputs, whole and distinct rows only.

    Adds the first and last year of each station, by which the output is named.
    """
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    merged = merged.na.drop("any")
    span = merged.groupBy(key).agg(
        F.year(F.min(time_col)).alias("first_year"), F.year(F.max(time_col)).alias("last_year")
    )
    return merged.distinct().join(span, key)


def known_levels(df: DataFrame, column: str = "lower") -> DataFrame:
    """Rows with a level that was issued."""
    return df.filter(F.col(column) > -1)
