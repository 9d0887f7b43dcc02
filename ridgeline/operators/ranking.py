"""Ordering, limits, samples and viewer look-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.functions import season_of
from ridgeline.operators.combine import actual_and_predicted
from ridgeline.schemas import BANDS


#: Up to this many rows of a group the planner cuts groups before the shuffle.
_GROUP_LIMIT = 1000


def _order_key(keys: Sequence[str], seed: int) -> Column:
    """A fixed pseudo-random text per row key: the MD5 of seed and keys, which any engine can repeat."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]).cast("binary"))


def _order_number(keys: Sequence[str], seed: int) -> Column:
    """The same as a number of 32 bits."""
    return F.conv(F.substring(_order_key(keys, seed), 1, 8), 16, 10).cast("bigint")


def sorted_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """L1: total order, for report output only."""
    return df.orderBy(*keys)


def top_rows(df: DataFrame, by: str, n: int = 15, positive_only: bool = False) -> DataFrame:
    """The n rows with the largest value."""
    rows = df.filter(F.col(by) > 0) if positive_only else df
    return rows.orderBy(F.desc(by), *[c for c in df.columns if c != by]).limit(n)


def latest_levels(report: DataFrame, bands: Sequence[str] = tuple(BANDS)) -> DataFrame:
    """L3: level of every zone and band on the latest day, -1 if there is none."""
    latest = report.agg(F.max("date")).scalar()
    today = report.filter(F.col("date") == latest).select("zone_name", "elevation_band", "predicted_danger")
    # Ranking ties of a band cannot occur: a report has one row per key.
    wanted = report.select("zone_name").distinct().withColumn(
        "elevation_band", F.explode(F.array(*[F.lit(b) for b in bands]))
    )
    return wanted.join(today, ["zone_name", "elevation_band"], "left").withColumn(
        "predicted_danger", F.coalesce("predicted_danger", F.lit(-1))
    )


def recent_levels(report: DataFrame, days_back: int = 5) -> DataFrame:
    """L4: levels of the days before the latest one, upper band else middle.

    Days are matched by local date; a day with neither band gives no row.
    """
    latest = report.agg(F.max("date")).scalar()
    back = F.date_diff(latest, F.col("date"))
    recent = report.filter((back >= 1) & (back <= days_back) & F.col("elevation_band").isin("upper", "middle"))

    def of(band: str) -> Column:
        return F.max(F.when(F.col("elevation_band") == band, F.col("predicted_danger")))

    return (
        recent.groupBy("zone_name", "date")
        .agg(F.coalesce(of("upper"), of("middle")).alias("predicted_danger"))
        .filter(F.col("predicted_danger").isNotNull())
    )


def stratified_sample(df: DataFrame, by: str, n: int, keys: Sequence[str], seed: int = 42, slices: int = 64) -> DataFrame:
    """At most n rows per class, the same ones on every run.

    A small ``n`` is cut in each task before the rows are shuffled (the planner's
    group limit). A large one is first cut in hash slices, so a class with most of
    the rows is not ordered in one task.
    """
    # The first digits as a number sort as the whole text does; the text decides ties.
    number = F.conv(F.substring("_h", 1, 15), 16, 10).cast("bigint")
    ordered = df.withColumn("_h", _order_key(keys, seed)).withColumn("_o", number)
    helpers = ["_h", "_o", "_r"]
    if n > _GROUP_LIMIT:
        ordered = ordered.withColumn("_slice", F.pmod(_order_number(keys, seed), F.lit(slices)))
        first = Window.partitionBy(by, "_slice").orderBy("_o", "_h", *keys)
        ordered = ordered.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= n)
        helpers.append("_slice")
    second = Window.partitionBy(by).orderBy("_o", "_h", *keys)
    return ordered.withColumn("_r", F.row_number().over(second)).filter(F.col("_r") <= n).drop(*helpers)


def random_rows(df: DataFrame, k: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """K rows in hash order; every task keeps k rows before they are merged."""
    return df.orderBy(_order_key(keys, seed), *keys).limit(k)


def hash_split(df: DataFrame, keys: Sequence[str], test_share: float = 0.3, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test parts that do not change with the partitioning."""
    bucket = F.pmod(_order_number(keys, seed), F.lit(10_000))
    cut = int(round(test_share * 10_000))
    return df.filter(bucket >= cut), df.filter(bucket < cut)


def time_split(df: DataFrame, at: str, date_col: str = "date") -> tuple[DataFrame, DataFrame]:
    """Rows before a date, rows from it on."""
    day = F.lit(at).cast("date")
    return df.filter(F.col(date_col) < day), df.filter(F.col(date_col) >= day)


def season_folds(df: DataFrame, date_col: str = "date", first_month: int = 10, last_month: int = 5) -> DataFrame:
    """The rows of the training season, October 1 to May 1, with their season."""
    d = F.col(date_col)
    month_day = F.month(d) * 100 + F.dayofmonth(d)
    inside = (month_day >= first_month * 100 + 1) | (month_day <= last_month * 100 + 1)
    return df.filter(inside).withColumn("season", season_of(d, first_month))


def hold_out(df: DataFrame, season: int) -> tuple[DataFrame, DataFrame]:
    """The other seasons, the held-out season."""
    return df.filter(F.col("season") != season), df.filter(F.col("season") == season)


def level_series(
    observed: DataFrame, zone_day: DataFrame, zone: str | None = None, band: str | None = None
) -> DataFrame:
    """Predicted beside observed levels of a zone and band, by date."""
    both = actual_and_predicted(observed, zone_day, "full")
    if zone is not None:
        both = both.filter(F.col("zone_name") == zone)
    if band is not None:
        both = both.filter(F.col("elevation_band") == band)
    return both.orderBy("date", "zone_name", "elevation_band")


def zone_rows(df: DataFrame, zone: str) -> DataFrame:
    """Rows of one zone."""
    return df.filter(F.col("zone_name") == zone)


def zone_discussion(zones: DataFrame, discussion: DataFrame) -> DataFrame:
    """The text of every zone, null where none was written."""
    return zones.join(discussion.withColumnRenamed("zone", "zone_name"), "zone_name", "left")
