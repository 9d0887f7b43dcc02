"""Time columns. Stamps are UTC wall clock (``timestamp_ntz``) throughout, so
no result depends on the session time zone."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ridgeline.schemas import DAY_START_HOUR, LOCAL_ZONE, SEASON_FIRST_MONTH, SUMMER_MONTHS

__all__ = [
    "hours", "days", "hour_stamp", "seconds_of", "to_local", "shifted_day", "local_midnight_epoch",
    "epoch_to_date", "season_of", "in_summer", "parse_stamp",
    "forecast_run_date", "forecast_lead",
]


def hours(n: int | Column) -> Column:
    """An interval of ``n`` hours."""
    return F.make_dt_interval(F.lit(0), n if isinstance(n, Column) else F.lit(n))


def days(n: int | Column) -> Column:
    """An interval of ``n`` days."""
    return F.make_dt_interval(n if isinstance(n, Column) else F.lit(n))


def hour_stamp(ts: Column) -> Column:
    """the hour a stamp lies in."""
    return ts.cast("date").cast("timestamp_ntz") + hours(F.hour(ts))


def seconds_of(ts: Column) -> Column:
    """Whole seconds since 1970 of a wall-clock stamp."""
    return (
        F.unix_date(ts.cast("date")).cast("bigint") * 86400
        + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    )


def _session_is_utc() -> bool:
    spark = SparkSession.getActiveSession()
    return spark is not None and spark.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "GMT", "Z")


def to_local(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """UTC wall clock to local wall clock.

    In a UTC session, the default here, a zoned stamp and its wall clock are
    the same number, and ``from_utc_timestamp`` looks its zone up once instead
    of per row: an eighth of the time of ``convert_timezone``, which other
    sessions need.
    """
    if _session_is_utc():
        return F.from_utc_timestamp(ts.cast("timestamp"), zone).cast("timestamp_ntz")
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def shifted_day(ts: Column, zone: str = LOCAL_ZONE, start_hour: int = DAY_START_HOUR) -> Column:
    """Local date of the right edge of a day that starts at ``start_hour``.

    The day is cut on the local wall clock, so the two days a year on which the
    clock changes hold 23 and 25 hours.
    """
    return (to_local(ts, zone) + hours(24 - start_hour)).cast("date")


def local_midnight_epoch(day: Column, zone: str = LOCAL_ZONE) -> Column:
    """epoch seconds of local midnight of a date."""
    midnight = day.cast("date").cast("timestamp_ntz")
    return seconds_of(F.convert_timezone(F.lit(zone), F.lit("UTC"), midnight))


def epoch_to_date(seconds: Column, zone: str = LOCAL_ZONE) -> Column:
    """local date of epoch seconds, as the viewer prints it."""
    utc = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds
    )
    return F.date_format(to_local(utc, zone), "M/d/yyyy")


def season_of(ts: Column, first_month: int = SEASON_FIRST_MONTH) -> Column:
    """Start year of the season a stamp or date lies in."""
    return F.year(ts) - (F.month(ts) < first_month).cast("int")


def in_summer(ts: Column, months: Iterable[int] = SUMMER_MONTHS) -> Column:
    """True in the months that lie between two seasons."""
    return F.month(ts).isin(*months)


def parse_stamp(text: Column, patterns: Iterable[str] | None = None) -> Column:
    """parse text written in mixed formats; null when none fits."""
    patterns = list(patterns or ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd", "MM/dd/yyyy HH:mm:ss"])
    return F.coalesce(
        *[F.try_to_timestamp(F.trim(text), F.lit(p)).cast("timestamp_ntz") for p in patterns]
    )


def forecast_run_date(valid: Column) -> Column:
    """Run date that supplies a valid hour; midnight belongs to the day before."""
    day = F.date_trunc("day", valid).cast("timestamp_ntz")
    return F.when(F.hour(valid) == 0, day - days(1)).otherwise(day)


def forecast_lead(valid: Column) -> Column:
    """Lead hour, 1 to 24, that goes with ``forecast_run_date``."""
    return F.when(F.hour(valid) == 0, F.lit(24)).otherwise(F.hour(valid))
