"""Hour grids, gaps and request ranges.

Presence is folded to one 24-bit mask per key and day before anything else.
The fold combines on the map side, so a key that holds a large part of all rows
reaches the shuffle as at most one row per day and task. Gaps are then read off
consecutive days of a key; such a window holds one small row per calendar day,
whatever the number of rows of the key. Gaps stay intervals: hours are written
out only where hours are asked for.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridgeline.functions import (
    days, forecast_lead, forecast_run_date, hour_stamp, hours, in_summer, parse_stamp, season_of,
)
from ridgeline.schemas import SUMMER_MONTHS
from ridgeline.session import cut_lineage

_DAY_BITS = (1 << 24) - 1


def _ntz(value: datetime | date | Column | str) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(value if isinstance(value, str) else value.isoformat(sep=" ") if isinstance(value, datetime) else value.isoformat()).cast("timestamp_ntz")


def day_masks(df: DataFrame, keys: Sequence[str], time_col: str = "time") -> DataFrame:
    """One row per key and day: bit h is set if hour h is present."""
    t = F.col(time_col)
    on_the_hour = t == hour_stamp(t)
    bit = F.when(on_the_hour, F.expr(f"shiftleft(1, hour({time_col}))")).otherwise(0)
    return df.filter(t.isNotNull()).groupBy(*keys, t.cast("date").alias("day")).agg(
        F.bit_or(bit).alias("mask"), F.min(t).alias("first_time"), F.max(t).alias("last_time")
    )


def _mask_days(df: DataFrame, keys: Sequence[str], time_col: str) -> tuple[DataFrame, list[str]]:
    """Day masks with a constant key in place of no keys."""
    masks = day_masks(df, keys, time_col)
    return (masks, list(keys)) if keys else (masks.withColumn("_all", F.lit(1)), ["_all"])


def missing_hours(
    df: DataFrame,
    keys: Sequence[str] = ("point_id",),
    time_col: str = "time",
    start: datetime | Column | str | None = None,
    end: datetime | Column | str | None = None,
    off_months: Sequence[int] = SUMMER_MONTHS,
) -> DataFrame:
    """Hours of the grid that a key does not have.

    The grid runs from ``start`` to ``end``, by default from the first to the
    last stamp of the key, without the ``off_months``. Empty ``keys`` asks the
    question of the table as a whole: an hour counts as present if any key has
    it. A start that is not on the hour begins with the next full hour.
    """
    masks, part = _mask_days(df, keys, time_col)
    whole = Window.partitionBy(*part)
    by_day = whole.orderBy("day")
    lo = F.min("first_time").over(whole) if start is None else _ntz(start)
    hi = F.max("last_time").over(whole) if end is None else _ntz(end)
    rows = masks.select(
        *part, "day", "mask", lo.alias("lo"), hi.alias("hi"),
        F.lag("day").over(by_day).alias("before"), F.lead("day").over(by_day).alias("after"),
    )
    # A row answers for its own day and the empty days up to the next row; the
    # first and last row also for the rest of the grid.
    first = F.when(F.col("before").isNull(), F.least("day", F.col("lo").cast("date"))).otherwise(F.col("day"))
    last = F.coalesce(F.date_sub("after", 1), F.greatest("day", F.col("hi").cast("date")))
    spread = rows.withColumn("_d", F.explode(F.sequence(first, last, F.expr("interval 1 day"))))
    if off_months:
        spread = spread.filter(~in_summer(F.col("_d"), off_months))
    present = F.when(F.col("_d") == F.col("day"), F.col("mask")).otherwise(0)
    absent = spread.withColumn("absent", F.lit(_DAY_BITS).bitwiseAND(F.bitwise_not(present))).filter("absent != 0")
    stamps = absent.select(*part, "lo", "hi", "_d", _set_hours("absent").alias("h"))
    stamp = (F.col("_d").cast("timestamp_ntz") + hours(F.col("h"))).alias(time_col)
    out = stamps.select(*part, "lo", "hi", stamp).filter(F.col(time_col).between(F.col("lo"), F.col("hi")))
    return out.select(*keys, time_col)


def _set_hours(mask: str) -> Column:
    """One row per bit set in a mask."""
    return F.explode(F.expr(f"filter(sequence(0, 23), h -> (shiftright({mask}, h) & 1) = 1)"))


def single_gaps(
    df: DataFrame, keys: Sequence[str] = ("point_id",), time_col: str = "time", off_months: Sequence[int] = SUMMER_MONTHS
) -> DataFrame:
    """Missing hours whose hours before and after are both present.

    Found on the masks: a bit that is clear while both bits next to it are set,
    with the edge bits of the days before and after. No grid is built.
    """
    masks, part = _mask_days(df, keys, time_col)
    by_day = Window.partitionBy(*part).orderBy("day")

    def mask_of(offset: int) -> Column:
        near = F.lead("day", offset).over(by_day) == F.date_add("day", offset)
        return F.coalesce(F.when(near, F.lead("mask", offset).over(by_day)), F.lit(0))

    rows = masks.select(*part, "day", "mask", mask_of(-1).alias("yesterday"), mask_of(1).alias("tomorrow"))
    gaps = rows.withColumn("gap", F.expr(
        "(shiftleft(mask, 1) | shiftright(yesterday, 23)) & (shiftright(mask, 1) | shiftleft(tomorrow & 1, 23)) "
        f"& ~mask & {_DAY_BITS}"
    )).filter("gap != 0")
    if off_months:
        gaps = gaps.filter(~in_summer(F.col("day"), off_months))
    found = gaps.select(*part, "day", _set_hours("gap").alias("h"))
    return found.select(*keys, (F.col("day").cast("timestamp_ntz") + hours(F.col("h"))).alias(time_col))


def incomplete_points(
    df: DataFrame, upto: datetime | Column | str, key: str = "point_id", time_col: str = "time", slack: int = 24
) -> DataFrame:
    """Points whose row count differs from the hours up to ``upto`` plus a day.

    Hours are counted from the first stamp of the whole table.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    first = df.agg(F.min(time_col)).scalar()
    expected = F.floor(F.timestamp_diff("MINUTE", first, _ntz(upto)) / 60) + slack
    return counts.withColumn("expected", expected.cast("bigint")).filter("rows != expected")


def missing_ranges(
    missing: DataFrame,
    keys: Sequence[str] = ("point_id",),
    time_col: str = "time",
    longest: int = 8,
    isolate_last: bool = False,
    off_months: Sequence[int] = SUMMER_MONTHS,
) -> DataFrame:
    """Runs of consecutive missing hours, cut after ``longest`` stamps.

    ``isolate_last`` makes the last missing hour of a key a range of its own.
    Runs never cross the months without a season, so the season joins the
    window key: a window holds at most one season of distinct hours, however
    long the history of a point is.
    """
    keys = list(keys)
    t = F.col(time_col)
    rows = missing.select(*keys, time_col)
    part = list(keys)
    if off_months:
        rows = rows.withColumn("_season", season_of(t))
        part.append("_season")
    tail = F.lit(False)
    if isolate_last:
        if keys:
            rows = rows.join(rows.groupBy(*keys).agg(F.max(time_col).alias("_last")), keys)
            tail = t == F.col("_last")
        else:
            tail = t == rows.agg(F.max(time_col)).scalar()
    part = part or [F.lit(1)]
    # A dense rank gives repeated hours one place, so they need no distinct.
    numbered = rows.withColumn("_tail", tail).withColumn(
        "_rn", F.dense_rank().over(Window.partitionBy(*part).orderBy(time_col))
    )
    runs = numbered.withColumn("_run", t - hours(F.col("_rn")))
    place = F.col("_rn") - F.min("_rn").over(Window.partitionBy(*part, "_run"))
    return (
        runs.withColumn("_chunk", F.floor(place / longest))
        .groupBy(*part, "_run", "_chunk", "_tail")
        .agg(
            F.min(time_col).alias("start"), F.max(time_col).alias("end"),
            (F.max("_rn") - F.min("_rn") + 1).cast("bigint").alias("n_hours"),
        )
        .select(*keys, "start", "end", "n_hours")
    )


def _hour_number(day: Column, hour: Column) -> Column:
    """Hours since 1970 of an hour of a day: gaps are computed on whole numbers."""
    return F.unix_date(day).cast("bigint") * 24 + hour


def _stamp_of(number: str) -> Column:
    return F.expr(f"date_from_unix_date(cast({number} div 24 as int))").cast("timestamp_ntz") + hours(F.expr(f"cast({number} % 24 as int)"))


def _first_hour(ts: Column) -> Column:
    """Number of the first full hour from a stamp on."""
    late = (ts > hour_stamp(ts)).cast("bigint")
    return _hour_number(ts.cast("date"), F.hour(ts)) + late


def _last_hour(ts: Column) -> Column:
    return _hour_number(ts.cast("date"), F.hour(ts))


def _season_stretches(off_months: Sequence[int]) -> list[tuple[int, int]]:
    """Runs of months that are not off: (first month, number of months); a run may go on in the next year."""
    on = [m for m in range(1, 13) if m not in off_months]
    if len(on) == 12:
        return [(1, 12)]
    starts = [m for m in on if (m - 2) % 12 + 1 not in on]
    return [(m, next(n for n in range(1, 13) if (m + n - 1) % 12 + 1 not in on)) for m in starts]


def _without_months(gaps: DataFrame, keys: Sequence[str], off_months: Sequence[int]) -> DataFrame:
    """Intervals (s, e) cut to the seasons, one row for each piece that is left."""
    if not set(off_months) & set(range(1, 13)):
        return gaps.select(*keys, "s", "e")
    year = "year(date_from_unix_date(cast({} div 24 as int)))"
    pieces = []
    for month, length in _season_stretches(off_months):
        opens = f"make_date(y, {month}, 1)"
        pieces.append(
            f"struct(greatest(s, cast(unix_date({opens}) as bigint) * 24) as s, "
            f"least(e, cast(unix_date(add_months({opens}, {length})) as bigint) * 24 - 1) as e)"
        )
    # Years of one gap, not hours; a season that began the year before may reach into the first.
    each = f"flatten(transform(sequence({year.format('s')} - 1, {year.format('e')}), y -> array({', '.join(pieces)})))"
    if not pieces:
        return gaps.select(*keys, "s", "e").limit(0)
    return gaps.select(*keys, F.inline(F.expr(f"filter({each}, p -> p.s <= p.e)")))


def missing_intervals(
    df: DataFrame,
    keys: Sequence[str] = ("point_id",),
    time_col: str = "time",
    start: datetime | Column | str | None = None,
    end: datetime | Column | str | None = None,
    off_months: Sequence[int] = SUMMER_MONTHS,
    listed: DataFrame | None = None,
) -> DataFrame:
    """The hours of G1 as maximal intervals: keys, start, end, n_hours.

    No hour becomes a row. A day mask gives the runs of clear bits between its
    first and last set bit, found by shifting the mask against itself; the run
    before its first bit reaches back to the last bit of the row before, over
    any number of empty days; the last row of a key adds the run up to the end
    of the grid. Off months are cut out by arithmetic on the interval, so work
    follows the days with rows and the number of gaps.

    ``listed`` names the keys to ask for, with or without rows: keys that are
    not listed are left out, one without rows lacks the whole grid. It needs
    ``start`` and ``end``.
    """
    if listed is not None and (start is None or end is None):
        raise ValueError("a list of keys needs the start and the end of the grid")
    masks, part = _mask_days(df, keys, time_col)
    if listed is not None and keys:
        asked = listed.select(*keys).dropna().distinct()
        nothing = {"day": _ntz(start).cast("date"), "mask": F.lit(0), "first_time": F.lit(None).cast("timestamp_ntz"), "last_time": F.lit(None).cast("timestamp_ntz")}
        # A day without hours for each listed key: it has no bits, so it moves no gap of a key with rows.
        masks = masks.join(asked, list(keys), "left_semi").unionByName(asked.withColumns(nothing))
    whole = Window.partitionBy(*part)
    by_day = whole.orderBy("day")
    lo = _first_hour(F.min("first_time").over(whole) if start is None else _ntz(start))
    hi = _last_hour(F.max("last_time").over(whole) if end is None else _ntz(end))
    some = F.col("mask") != 0
    lowest, highest = F.length(F.bin(F.expr("mask & -mask"))) - 1, F.length(F.bin("mask")) - 1
    rows = masks.select(
        *part, "mask", F.lead("day").over(by_day).isNull().alias("_final"), lo.alias("lo"), hi.alias("hi"),
        _hour_number(F.col("day"), F.lit(0)).alias("_day"), F.when(some, lowest).alias("_f"), F.when(some, highest).alias("_l"),
        F.last(F.when(some, _hour_number(F.col("day"), highest)), ignorenulls=True)
        .over(by_day.rowsBetween(Window.unboundedPreceding, -1)).alias("_prev"),
    )
    bits = "filter(sequence(0, 23), h -> (shiftright({}, h) & 1) = 1)"
    opened = bits.format("(~mask & shiftleft(mask, 1) & (shiftleft(1, _l) - 1))")
    closed = bits.format("(~mask & shiftright(mask, 1) & ~(shiftleft(2, _f) - 1))")
    inner = f"if(_f is null, array(), zip_with({opened}, {closed}, (a, b) -> struct(_day + a as s, _day + b as e)))"
    ahead = "if(_f is null, array(), array(struct(coalesce(_prev + 1, lo) as s, _day + _f - 1 as e)))"
    rest = "if(_final, array(struct(coalesce(_day + _l + 1, _prev + 1, lo) as s, hi as e)), array())"
    found = rows.select(*part, "lo", "hi", F.inline(F.expr(f"filter(concat({ahead}, {inner}, {rest}), g -> g.s <= g.e)")))
    found = found.select(*keys, F.greatest("s", "lo").alias("s"), F.least("e", "hi").alias("e")).filter("s <= e")
    cut = _without_months(found, keys, off_months)
    return cut.select(*keys, _stamp_of("s").alias("start"), _stamp_of("e").alias("end"), (F.col("e") - F.col("s") + 1).alias("n_hours"))


def interval_ranges(intervals: DataFrame, keys: Sequence[str] = ("point_id",), longest: int = 8, isolate_last: bool = False) -> DataFrame:
    """Maximal intervals cut after ``longest`` hours; one row for each range that comes out.

    ``isolate_last`` makes the last missing hour of a key a range of its own.
    """
    keys = list(keys)
    rows, body, tail = intervals, F.col("n_hours"), F.lit(False)
    if isolate_last:
        latest = F.max("end").over(Window.partitionBy(*keys)) if keys else intervals.agg(F.max("end")).scalar()
        rows = rows.withColumn("_tail", F.col("end") == latest)
        tail = F.col("_tail")
        body = body - tail.cast("bigint")
    whole = F.floor((body + longest - 1) / longest).cast("bigint")
    pieces = F.sequence(F.lit(0).cast("bigint"), whole + tail.cast("bigint") - 1)
    cut = rows.select(*keys, "start", body.alias("_n"), whole.alias("_whole"), F.explode(pieces).alias("_i"))
    first = F.when(F.col("_i") < F.col("_whole"), F.col("_i") * longest).otherwise(F.col("_n"))
    length = F.when(F.col("_i") < F.col("_whole"), F.least(F.lit(longest).cast("bigint"), F.col("_n") - F.col("_i") * longest)).otherwise(F.lit(1).cast("bigint"))
    cut = cut.select(*keys, "start", first.cast("int").alias("_first"), length.alias("n_hours"))
    begin = F.col("start") + hours(F.col("_first"))
    return cut.select(*keys, begin.alias("start"), (begin + hours((F.col("n_hours") - 1).cast("int"))).alias("end"), "n_hours")


def forecast_requests(ranges: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Run date and lead hours that supply a range of valid hours."""
    return ranges.withColumns({
        "run_start": forecast_run_date(F.col(start)), "lead_from": forecast_lead(F.col(start)),
        "run_end": forecast_run_date(F.col(end)), "lead_to": forecast_lead(F.col(end)),
    })


def request_intervals(
    df: DataFrame, start_col: str, days_col: str, now: datetime | Column | str,
    step_hours: int = 6, off_months: Sequence[int] = SUMMER_MONTHS,
) -> DataFrame:
    """Intervals of ``step_hours`` over the days from a start.

    Summer days are skipped; the plan of a row ends at the first day that is
    less than a day before ``now``.
    """
    day_list = F.sequence(F.lit(0), F.col(days_col) - 1)
    planned = df.filter(F.col(days_col) > 0).withColumn("_d", F.explode(day_list)).withColumn(
        "_day", F.col(start_col) + days(F.col("_d"))
    )
    planned = planned.filter((F.col("_day") <= _ntz(now) - days(1)) & ~in_summer(F.col("_day"), off_months))
    step = F.explode(F.sequence(F.lit(0), F.lit(24 // step_hours - 1)))
    return (
        planned.withColumn("_i", step)
        .withColumn("start", F.col("_day") + hours(F.col("_i") * step_hours))
        .withColumn("end", F.col("start") + hours(step_hours))
        .drop("_d", "_day", "_i")
    )


def range_hours(ranges: DataFrame, start: str = "start", end: str = "end", time_col: str = "time") -> DataFrame:
    """The hours of a range, both ends included."""
    return ranges.withColumn(time_col, F.explode(F.sequence(F.col(start), F.col(end), F.expr("interval 1 hour"))))


def calendar_counts(
    df: DataFrame, date_col: str = "date", last: date | Column | str | None = None
) -> DataFrame:
    """Rows per day over the whole calendar, zero where there are none."""
    counts = df.groupBy(F.col(date_col).cast("date").alias(date_col)).agg(F.count(F.lit(1)).alias("n"))
    stop = F.max(date_col) if last is None else (last if isinstance(last, Column) else F.lit(last)).cast("date")
    calendar = counts.agg(F.min(date_col).alias("lo"), stop.alias("hi")).filter("lo <= hi").select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias(date_col)
    )
    return calendar.join(counts, date_col, "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


def underfilled_days(
    df: DataFrame, least: int, date_col: str = "date", last: date | Column | str | None = None
) -> DataFrame:
    """Days with fewer than ``least`` rows, days without rows included."""
    return calendar_counts(df, date_col, last).filter(F.col("n") < least)


def underfilled_ids(
    df: DataFrame, ids: DataFrame, day_list: DataFrame, least: int = 5,
    id_col: str = "id", date_col: str = "date", excluded: Sequence[int] = (),
) -> DataFrame:
    """(day, id) pairs with fewer than ``least`` rows.

    Pairs with some rows come from the counts. Pairs without any are the listed
    days of every id that the counts do not have: as many as the answer holds,
    and a day on which all ids have rows adds none beyond the anti join.
    """
    wanted = ids.select(id_col).distinct()
    if excluded:
        wanted = wanted.filter(~F.col(id_col).isin(*excluded))
    days_wanted = day_list.select(F.col(date_col).cast("date").alias(date_col)).distinct()
    counts = (
        df.withColumn(date_col, F.col(date_col).cast("date"))
        .join(days_wanted, date_col, "left_semi").join(wanted, id_col, "left_semi")
        .groupBy(date_col, id_col).agg(F.count(F.lit(1)).alias("n"))
    )
    counts = cut_lineage(counts, "counts")
    # The day list travels as one array: days of a calendar, not rows of data.
    listed = days_wanted.agg(F.collect_set(date_col)).scalar()
    absent = wanted.select(id_col, F.explode(listed).alias(date_col)).join(counts, [date_col, id_col], "left_anti")
    none = absent.withColumn("n", F.lit(0).cast("bigint")).filter(F.lit(least > 0))
    return counts.filter(F.col("n") < least).select(date_col, id_col, "n").unionByName(none)


def missing_pairs(
    df: DataFrame, ids: DataFrame, least: int, tolerance: int = 0, last: date | Column | str | None = None,
    id_col: str = "id", date_col: str = "date", excluded: Sequence[int] = (),
) -> DataFrame:
    """(day, id) pairs that lack rows, over the calendar from the first day on.

    An id without any row on a day is always asked for. An id with some rows,
    but fewer than ``least``, is asked for on days that lack more than
    ``tolerance`` rows in all. Counts of day and id are taken once; only days on
    which some id is absent meet the list of ids.
    """
    wanted = ids.select(id_col).dropna().distinct()
    if excluded:
        wanted = wanted.filter(~F.col(id_col).isin(*excluded))
    wanted = cut_lineage(wanted, "ids")
    n_ids = wanted.count()
    dated = df.withColumn(date_col, F.col(date_col).cast("date"))
    first = dated.agg(F.min(date_col).alias("lo"), (F.max(date_col) if last is None else F.lit(last).cast("date")).alias("hi"))
    counts = dated.join(wanted, id_col, "left_semi").groupBy(date_col, id_col).agg(F.count(F.lit(1)).alias("_n"))
    counts = cut_lineage(counts, "counts")
    per_day = counts.groupBy(date_col).agg(F.count(F.lit(1)).alias("_ids"), F.sum(F.least("_n", F.lit(least))).alias("_rows"))
    calendar = first.filter("lo <= hi").select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias(date_col))
    days_of = calendar.join(per_day, date_col, "left").na.fill(0, ["_ids", "_rows"])
    # One row for each day of the calendar, whatever the number of rows.
    days_of = cut_lineage(days_of, "days")
    partly = counts.filter(F.col("_n") < least).join(
        days_of.filter(n_ids * least - F.col("_rows") > tolerance).select(date_col), date_col, "left_semi"
    )
    listed = days_of.filter(F.col("_ids") < n_ids).agg(F.collect_set(date_col)).scalar()
    absent = wanted.select(F.explode(listed).alias(date_col), id_col).join(counts, [date_col, id_col], "left_anti")
    return partly.select(date_col, id_col).unionByName(absent)


def on_day(df: DataFrame, day: date | Column | str, date_col: str = "date") -> tuple[DataFrame, DataFrame]:
    """(rows of the day, the other rows)."""
    wanted = (day if isinstance(day, Column) else F.lit(day)).cast("date")
    hit = F.coalesce(F.col(date_col).cast("date") == wanted, F.lit(False))
    return df.filter(hit), df.filter(~hit)


def failed_ranges(log: DataFrame) -> DataFrame:
    """Hours of the intervals a request log lists as failed."""
    spans = log.select(parse_stamp(F.col("start")).alias("start"), parse_stamp(F.col("end")).alias("end"))
    return range_hours(spans.filter("start <= end").distinct()).select("time").distinct()


def season_backfill(
    df: DataFrame, season: int, day: datetime, keys: Sequence[str] = ("point_id",), points: DataFrame | None = None
) -> DataFrame:
    """Ranges to request so that every point has each hour since October 1.

    ``points`` is the list of points to plan for, those without any row as
    well; without it the plan is for the points that have rows.
    """
    gaps = missing_intervals(df, keys, "time", start=datetime(season, 10, 1), end=day, listed=points)
    return interval_ranges(gaps, keys)


def forecast_backfill(
    df: DataFrame, season: int, day: datetime, keys: Sequence[str] = ("point_id",), points: DataFrame | None = None
) -> DataFrame:
    """Forecast runs and lead hours still to request since December 1; ``points`` as for the season."""
    until = F.lit(str(day)).cast("timestamp_ntz") + days(1)
    gaps = missing_intervals(df, keys, "valid_time", start=datetime(season, 12, 1), end=until, listed=points)
    return forecast_requests(interval_ranges(gaps, keys))


def spark_days(spark: SparkSession, first: str, last: str) -> DataFrame:
    """A calendar table from ``first`` to ``last``."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 day"))).alias("date")
    )
