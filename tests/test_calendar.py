from datetime import datetime, timedelta

import pytest
from stamps import at
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridgeline.operators import calendar as cal
from ridgeline.operators.checks import series_violations

H = timedelta(hours=1)
START = datetime(2025, 1, 10)


def found(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_gap_of_one_point(hourly_of):
    full = [(p, START + i * H, 1.0) for p in (1, 2) for i in range(10)]
    rows = hourly_of([r for r in full if not (r[0] == 2 and r[1] == START + 4 * H)])
    assert found(cal.missing_hours(rows), "point_id", "time") == [(2, START + 4 * H)]
    assert found(cal.missing_hours(rows, keys=()), "time") == []
    assert found(cal.single_gaps(rows), "point_id", "time") == [(2, START + 4 * H)]


def test_summer_is_never_missing(hourly_of):
    rows = hourly_of([(1, "2025-05-31 22:00", 1.0), (1, "2025-10-01 01:00", 1.0)])
    assert found(cal.missing_hours(rows), "time") == [(at("2025-05-31 23:00"),), (at("2025-10-01 00:00"),)]
    empty_start = cal.missing_hours(rows, start="2025-06-01 00:00:00", end="2025-09-30 23:00:00")
    assert empty_start.count() == 0


def test_explicit_bounds_and_hot_point(hourly_of):
    # one point holds most rows, many of them copies of one hour
    rows = hourly_of([(1, START, float(i)) for i in range(300)] + [(2, START, 0.0), (2, START + 2 * H, 0.0)])
    got = found(cal.missing_hours(rows, start=START - H, end=START + 3 * H), "point_id", "time")
    want = [(1, START + i * H) for i in (-1, 1, 2, 3)] + [(2, START + i * H) for i in (-1, 1, 3)]
    assert got == sorted(want)
    # bounds inside the data
    assert found(cal.missing_hours(rows, start=START + H, end=START + H), "point_id", "time") == [
        (1, START + H), (2, START + H)
    ]


def loop_ranges(hours, longest_span=7):
    """Plain loop: extend while consecutive and not longer than eight stamps."""
    out, i = [], 0
    hours = sorted(set(hours))
    while i < len(hours):
        j = i
        while j + 1 < len(hours) and hours[j + 1] == hours[j] + H and j + 1 - i <= longest_span:
            j += 1
        out.append((hours[i], hours[j], j - i + 1))
        i = j + 1
    return out


@settings(max_examples=12, deadline=None)
@given(st.sets(st.integers(0, 80), min_size=1, max_size=60))
def test_ranges_equal_the_loop(spark, offsets):
    hours = [START + i * H for i in offsets]
    df = spark.createDataFrame([(7, t) for t in hours] * 2, "point_id bigint, time timestamp_ntz")
    got = found(cal.missing_ranges(df), "start", "end", "n_hours")
    assert got == loop_ranges(hours)


def test_twenty_hours(spark):
    df = spark.createDataFrame([(1, START + i * H) for i in range(20)], "point_id bigint, time timestamp_ntz")
    assert [r[0] for r in found(cal.missing_ranges(df).orderBy("start"), "n_hours")] == [4, 8, 8]
    alone = cal.missing_ranges(df, isolate_last=True).orderBy("start").select("n_hours").collect()
    assert [r[0] for r in alone] == [8, 8, 3, 1]
    whole = cal.missing_ranges(df, keys=(), isolate_last=True).orderBy("start").select("n_hours").collect()
    assert [r[0] for r in whole] == [8, 8, 3, 1]


def test_present_and_missing_make_the_grid(hourly_of):
    offsets = [0, 1, 2, 7, 30, 31, 55, 80]
    rows = hourly_of([(1, START + i * H, 1.0) for i in offsets])
    missing = [t for (t,) in found(cal.missing_hours(rows), "time")]
    assert sorted(missing + [START + i * H for i in offsets]) == [START + i * H for i in range(81)]


def test_single_gap_across_midnight_and_months(hourly_of):
    stamps = ["2025-01-31 22:00", "2025-02-01 00:00", "2025-02-01 22:00", "2025-02-01 23:00", "2025-02-02 01:00", "2025-02-02 04:00"]
    rows = hourly_of([(1, s, 1.0) for s in stamps])
    assert found(cal.single_gaps(rows), "time") == [(at("2025-01-31 23:00"),), (at("2025-02-02 00:00"),)]


def test_completeness(hourly_of):
    rows = hourly_of([(1, START + i * H, 1.0) for i in range(48)] + [(2, START + i * H, 1.0) for i in range(47)])
    got = found(cal.incomplete_points(rows, START + 24 * H), "point_id", "rows", "expected")
    assert got == [(2, 47, 48)]
    gaps = cal.missing_hours(rows, start=START, end=START + 47 * H)
    last = F.lit(START + 47 * H).cast("timestamp_ntz")
    assert found(series_violations(rows, gaps, last), "point_id", "missing_hours") == [(2, 1)]


def test_request_intervals(spark):
    df = spark.createDataFrame([(1, at("2025-05-31"), 3), (2, at("2025-01-01"), 1)], "id int, d timestamp_ntz, n int")
    got = found(cal.request_intervals(df, "d", "n", "2025-12-01"), "id", "start", "end")
    assert [g[0] for g in got] == [1] * 4 + [2] * 4  # June 1 and 2 are skipped
    assert got[0][1:] == (at("2025-05-31"), at("2025-05-31 06:00"))
    none = cal.request_intervals(df, "d", "n", "2025-01-01 12:00:00")
    assert none.count() == 0


def test_days_and_ids(spark):
    rows = spark.createDataFrame(
        [(at("2025-01-01").date(), 1)] * 5 + [(at("2025-01-03").date(), 1), (at("2025-01-03").date(), 3)], "date date, id bigint"
    )
    days = cal.underfilled_days(rows, 3, last="2025-01-04")
    assert [str(r[0])[-2:] + str(r[1]) for r in days.orderBy("date").collect()] == ["020", "032", "040"]
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id bigint")
    pairs = cal.underfilled_ids(rows, ids, days, least=1, excluded=[2])
    assert sorted((str(d), i) for d, i, _ in [(r.date, r.id, r.n) for r in pairs.collect()]) == [
        ("2025-01-02", 1), ("2025-01-02", 3), ("2025-01-04", 1), ("2025-01-04", 3)
    ]


def test_day_split_and_log(spark):
    rows = spark.createDataFrame([("a", at("2025-01-01").date()), ("b", None)], "k string, date date")
    today, rest = cal.on_day(rows, "2025-01-01")
    assert [r.k for r in today.collect()] == ["a"] and [r.k for r in rest.collect()] == ["b"]
    log = spark.createDataFrame(
        [("x", "2025-01-01 00:00:00", "2025-01-01 02:00:00", "m"), ("x", "2025-01-02 00:00:00", "2025-01-01 00:00:00", "m")],
        "logged string, start string, end string, message string",
    )
    assert cal.failed_ranges(log).count() == 3


@pytest.mark.parametrize("day", ["2025-01-12"])
def test_backfill_plans(hourly_of, day):
    rows = hourly_of([(1, "2024-10-01 00:00", 1.0), (1, "2024-10-01 03:00", 1.0)])
    plan = found(cal.season_backfill(rows, 2024, at("2024-10-01 06:00")), "start", "end")
    assert plan == [(at("2024-10-01 01:00"), at("2024-10-01 02:00")), (at("2024-10-01 04:00"), at("2024-10-01 06:00"))]
    ahead = cal.forecast_backfill(hourly_of([(1, "2024-12-01 00:00", 1.0)]), 2024, at("2024-11-30"))
    got = found(ahead, "start", "lead_from", "lead_to")
    assert got == [(at("2024-12-01 00:00"), 24, 24)]


def hours_of(rows):
    return sorted((k, s + i * H) for k, s, e, n in rows for i in range(n) if s + (n - 1) * H == e)


@settings(max_examples=15, deadline=None)
@given(
    st.lists(st.tuples(st.integers(1, 3), st.integers(0, 400)), min_size=1, max_size=50),
    st.sampled_from([datetime(2025, 1, 10), datetime(2025, 5, 28, 13), datetime(2025, 9, 25)]),
    st.sampled_from([(None, None), (-30, 500), (100, 200), (390, 600), (-200, -3)]),
    st.sampled_from([(6, 7, 8, 9), (), (1, 12), (5, 10)]),
)
def test_intervals_hold_the_missing_hours(spark, stamps, first, bounds, off):
    rows = spark.createDataFrame([(p, first + i * H) for p, i in stamps], "point_id bigint, time timestamp_ntz")
    lo, hi = (None if b is None else first + b * H for b in bounds)
    got = found(cal.missing_intervals(rows, start=lo, end=hi, off_months=off), "point_id", "start", "end", "n_hours")
    assert hours_of(got) == found(cal.missing_hours(rows, start=lo, end=hi, off_months=off), "point_id", "time")
    # Maximal: the hour after an interval is present, off or beyond the grid.
    opens = {(k, s) for k, s, _, _ in got}
    assert not any((k, e + H) in opens for k, _, e, _ in got)
    whole = cal.missing_intervals(rows, keys=(), off_months=off)
    assert sum(r.n_hours for r in whole.collect()) == cal.missing_hours(rows, keys=(), off_months=off).count()


@settings(max_examples=10, deadline=None)
@given(st.sets(st.integers(0, 120), min_size=2, max_size=60), st.booleans())
def test_interval_ranges_equal_the_hours(spark, offsets, alone):
    rows = spark.createDataFrame([(p, START + (i + p) * H) for p in (1, 2) for i in offsets], "point_id bigint, time timestamp_ntz")
    got = cal.interval_ranges(cal.missing_intervals(rows), isolate_last=alone)
    want = cal.missing_ranges(cal.missing_hours(rows), isolate_last=alone)
    assert found(got, "point_id", "start", "end", "n_hours") == found(want, "point_id", "start", "end", "n_hours")
    got, want = (f(g, keys=(), isolate_last=alone) for f, g in (
        (cal.interval_ranges, cal.missing_intervals(rows, keys=())), (cal.missing_ranges, cal.missing_hours(rows, keys=()))))
    assert found(got, "start", "end", "n_hours") == found(want, "start", "end", "n_hours")


def test_intervals_do_not_follow_the_hours(hourly_of):
    rows = hourly_of([(1, "1725-01-01 05:00", 1.0), (1, "2025-01-01 02:30", 1.0), (1, "2025-01-01 04:00", 1.0)])
    one = found(cal.missing_intervals(rows, off_months=()), "start", "end")
    # A stamp inside an hour is not that hour.
    assert one == [(at("1725-01-01 06:00"), at("2025-01-01 03:00"))]
    seasons = cal.missing_intervals(rows)
    assert seasons.count() == 301 and seasons.filter("month(start) = 10 and month(end) = 5").count() == 299
    plan = cal.missing_intervals(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(sequence" not in plan and plan.count("Generate") == 2
    assert cal.missing_intervals(rows, off_months=range(1, 13)).count() == 0


def test_listed_points_without_rows(hourly_of, spark):
    rows = hourly_of([(1, "2024-12-01 01:00", 1.0), (3, "2024-12-01 00:00", 1.0), (4, "2025-01-01 00:00", 1.0)])
    listed = spark.createDataFrame([(1,), (2,), (2,), (None,), (4,)], "point_id bigint")
    grid = {"start": at("2024-12-01 00:00"), "end": at("2024-12-01 02:30")}
    got = found(cal.missing_intervals(rows, listed=listed, **grid), "point_id", "start", "n_hours")
    assert got == [(1, at("2024-12-01 00:00"), 1), (1, at("2024-12-01 02:00"), 1), (2, at("2024-12-01 00:00"), 3), (4, at("2024-12-01 00:00"), 3)]
    with pytest.raises(ValueError):
        cal.missing_intervals(rows, listed=listed)
    plan = cal.season_backfill(rows, 2024, at("2024-10-01 09:00"), points=listed)
    assert found(plan.filter("point_id = 2"), "start", "n_hours") == [(at("2024-10-01 00:00"), 8), (at("2024-10-01 08:00"), 2)]
    ahead = cal.forecast_backfill(rows, 2024, at("2024-11-30"), points=listed)
    assert found(ahead.filter("point_id = 2"), "start", "lead_from", "lead_to") == [(at("2024-12-01 00:00"), 24, 24)]


def test_pairs_that_lack_rows(spark):
    """One point without a row is asked for on any day, a thin one only where the day lacks more than the tolerance."""
    day = lambda n: at(f"2025-01-0{n}").date()
    rows = [(day(1), i) for i in (1, 2, 3) for _ in range(5)] + [(day(2), i) for i in (1, 2) for _ in range(5)]
    rows += [(day(3), 1)] * 5 + [(day(3), 2)] * 4 + [(day(3), 3)] * 5 + [(day(4), 1)] * 2 + [(day(4), 2)] * 2 + [(day(4), 3)] * 5 + [(day(1), 9)] * 3
    df = spark.createDataFrame(rows, "date date, id bigint")
    ids = spark.createDataFrame([(1,), (2,), (3,), (3,), (None,), (7,)], "id bigint")
    got = cal.missing_pairs(df, ids, 5, tolerance=5, last="2025-01-05", excluded=[7])
    want = [(day(2), 3), (day(4), 1), (day(4), 2)] + [(day(5), i) for i in (1, 2, 3)]
    assert found(got, "date", "id") == want
    assert found(cal.missing_pairs(df, ids, 5, 0, "2025-01-05", excluded=[7]), "date", "id") == sorted([*want, (day(3), 2)])
    assert cal.missing_pairs(df.limit(0), ids, 5, last="2025-01-05").count() == 0
