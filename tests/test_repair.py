from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridgeline.operators import repair

H = timedelta(hours=1)
START = datetime(2025, 1, 31, 20)  # runs over the end of a month


def values(df, *extra):
    return {r.time: tuple(r[c] for c in ("t", *extra)) for r in df.collect()}


@pytest.mark.parametrize(
    "series, want, lost",
    [
        ([1, 10000, 3], [1, 2, 3], 0),           # middle
        ([10000, 5, 6], [5, 5, 6], 0),           # first row
        ([5, 6, -11], [5, 6, 6], 0),             # last row
        ([4, 10000, 10000, 8], [4, 4, 8, 8], 0),  # pair: the one usable side
        ([10000], [None], 1),
        ([10000, 10000, 10000], [None, None, None], 3),
        ([-10, 1000, None], [-10, 1000, None], 0),  # limits are inside
    ],
)
def test_outliers(hourly_of, series, want, lost):
    rows = hourly_of([(1, START + i * H, v) for i, v in enumerate(series)])
    got = values(repair.repair_outliers(rows), "unrepaired")
    assert [got[START + i * H][0] for i in range(len(series))] == want
    assert sum(v[1] for v in got.values()) == lost


def test_outlier_ignores_other_points_leads_and_longer_gaps(hourly_of):
    rows = hourly_of([(1, START, 10000), (1, START + 2 * H, 7), (2, START + H, 9)]).unionByName(
        hourly_of([(1, START + H, 9)], fxx=2)
    )
    got = repair.repair_outliers(rows).filter("point_id = 1 and fxx = 1")
    assert values(got)[START] == (None,)


def test_copies_of_a_row_stay(hourly_of):
    rows = hourly_of([(1, START, 2)] * 50 + [(1, START + H, 10000)] * 3 + [(1, START + 2 * H, 4)])
    got = repair.repair_outliers(rows)
    assert got.count() == 54
    assert [r.t for r in got.filter(F.col("time") == START + H).collect()] == [3.0] * 3


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.floats(-2000, 2000), st.none()), min_size=1, max_size=30))
def test_repaired_series_is_in_range(spark, series):
    rows = spark.createDataFrame(
        [(1, 1, START + i * H, v) for i, v in enumerate(series)], "point_id bigint, fxx int, time timestamp_ntz, t double"
    )
    got = repair.repair_outliers(rows)
    assert got.count() == len(series)
    assert got.filter("t < -10 or t > 1000").count() == 0


def test_single_hours(hourly_of):
    rows = hourly_of([(1, START + i * H, v) for i, v in [(0, 1), (2, 3), (5, 9), (6, 10), (8, 20)]])
    filled = values(repair.interpolated_hours(rows), "valid_time")
    assert filled == {START + H: (2.0, START + 2 * H), START + 7 * H: (15.0, START + 8 * H)}
    assert repair.fill_single_hours(rows).count() == 7


def test_no_hour_is_made_up_in_summer(hourly_of):
    rows = hourly_of([(1, datetime(2025, 5, 31, 23), 1), (1, datetime(2025, 6, 1, 1), 1)])
    assert repair.interpolated_hours(rows).count() == 0


def test_gap_repair_counts_nulls_as_missing(hourly_of):
    rows = hourly_of([(1, START, 1), (1, START + H, None), (1, START + 2 * H, 3), (1, START + 2 * H, 3)])
    assert values(repair.repair_gaps(rows)) == {START: (1.0,), START + H: (2.0,), START + 2 * H: (3.0,)}


def test_splice_prefers_the_past(hourly_of):
    day = datetime(2025, 1, 20)
    past = hourly_of([(1, day - H, 1), (1, day, 2), (1, day + H, 3)])
    run = hourly_of([(1, day - H, 20), (1, day, 30), (1, day + 30 * H, 40), (2, day, 50)])
    got = repair.splice(past, run, "2025-01-20 00:00:00")
    assert values(got) == {day - H: (1.0,), day: (2.0,), day + H: (30.0,)}
    assert {r.point_id for r in got.collect()} == {1}


def test_first_per_stamp(spark):
    df = spark.createDataFrame([(1, 0, "b", 2), (1, 0, "a", 1), (1, 5, None, 0)], "k int, time int, v string, rank int")
    got = sorted((r.time, r.v) for r in repair.first_per_stamp(df, "rank", ["k", "time"]).collect())
    assert got == [(0, "a"), (5, None)]


def test_merge_runs(spark):
    a = spark.createDataFrame([(1, datetime(2024, 12, 31), 1.0), (1, datetime(2024, 12, 31), 1.0), (1, datetime(2025, 1, 1), None)],
                              "id int, timestamp timestamp_ntz, x double")
    b = spark.createDataFrame([(1, datetime(2025, 2, 1), 2.0)], "id int, timestamp timestamp_ntz, x double")
    got = sorted((r.x, r.first_year, r.last_year) for r in repair.merge_runs([a, b]).collect())
    assert got == [(1.0, 2024, 2025), (2.0, 2024, 2025)]


def test_series_with_gaps_go_to_quarantine(spark, hourly_of):
    day = datetime(2025, 1, 11)
    full = [day + (i - 24) * H for i in range(48)]
    rows = hourly_of([(p, t, 1.0) for p in (1, 2, 3) for t in full if not (p == 2 and t == full[30]) and not (p == 3 and t > full[45])], fxx=0)
    good, wrong = repair.checked_splice(rows.filter("time <= timestamp_ntz '2025-01-11'"), rows, "2025-01-11")
    assert {r.point_id for r in good.collect()} == {1} and good.count() == 48
    assert sorted((r.point_id, r.missing_hours, r.last_time) for r in wrong.collect()) == [(2, 1, full[47]), (3, 0, full[45])]


def test_whole_series_are_made_in_bounded_parts(spark, tmp_path, monkeypatch):
    """An id becomes 384 rows: no task makes those of more than some thousand ids."""
    from suite import calendars
    from suite.registry import JOBS

    ids = spark.range(4500).selectExpr("id as event_id", "timestamp_ntz '2024-01-05 00:00:00' as ts", "id as user_id", "'view' as event_type", "1d as value", "'' as props")
    ids.write.parquet(str(tmp_path / "events.parquet"))
    seen, splice = [], calendars.repair.checked_splice
    monkeypatch.setattr(calendars.repair, "checked_splice", lambda past, ahead, day: seen.extend([past, ahead]) or splice(past, ahead, day))
    whole = JOBS["u2_p13_whole_series"](spark, str(tmp_path))
    assert whole.select("point_id").distinct().count() == sum(1 for i in range(4500) if i % 3 != 1 and i % 5 != 2)
    assert whole.count() == 384 * sum(1 for i in range(4500) if i % 3 != 1 and i % 5 != 2)
    for rows in seen:
        assert rows.groupBy(F.spark_partition_id()).count().agg({"count": "max"}).first()[0] < 384 * 2000
