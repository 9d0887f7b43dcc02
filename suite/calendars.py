"""Queries for hour grids, gaps and request ranges (G1 to G14) and repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeline.functions import season_of
from ridgeline.operators import calendar as cal
from ridgeline.operators import repair
from ridgeline.session import cut_lineage
from suite import views as v
from suite.registry import query

_MISSING = """
    grid as (select point_id, unnest(generate_series(lo, hi, interval 1 hour)) as time
             from (select point_id, min(time) as lo, max(time) as hi from v_hourly group by point_id)),
    missing as (select * from grid anti join v_hourly using (point_id, time) where month(time) not in (6, 7, 8, 9))
"""


@query("g1_missing_hours", f"with {_MISSING} select point_id, time from missing", "v_hourly")
def g1(spark, sf):
    return cal.missing_hours(v.hourly(spark, sf))


@query(
    "g1_missing_hours_any_point",
    """with few as (select date_trunc('hour', ts) as time from events where event_type = 'purchase'),
       grid as (select unnest(generate_series(lo, hi, interval 1 hour)) as time from (select min(time) as lo, max(time) as hi from few))
       select time from grid anti join few using (time)""",
)
def g1_any(spark, sf):
    bought = v.table(spark, sf, "events").filter("event_type = 'purchase'")
    return cal.missing_hours(bought.select(cal.hour_stamp(F.col("ts")).alias("time")), keys=())


@query(
    "g2_incomplete_points",
    """select point_id, count(*) as "rows",
              cast(floor(date_diff('minute', (select min(time) from v_hourly), timestamp '2024-01-31 00:00:00') / 60) + 24 as bigint) as expected
       from v_hourly group by point_id
       having count(*) <> floor(date_diff('minute', (select min(time) from v_hourly), timestamp '2024-01-31 00:00:00') / 60) + 24""",
    "v_hourly",
)
def g2(spark, sf):
    return cal.incomplete_points(v.hourly(spark, sf), "2024-01-31 00:00:00")


def _ranges_sql(tail: str) -> str:
    return f"""with {_MISSING},
        flagged as (select point_id, time, {tail} as tail from missing),
        runs as (select *, time - row_number() over (partition by point_id order by time) * interval 1 hour as run from flagged),
        placed as (select *, row_number() over (partition by point_id, run order by time) - 1 as pos from runs)
        select point_id, min(time) as start, max(time) as "end", count(*) as n_hours
        from placed group by point_id, run, pos // 8, tail"""


@query("g3_gap_ranges", _ranges_sql("false"), "v_hourly")
def g3(spark, sf):
    return cal.interval_ranges(cal.missing_intervals(v.hourly(spark, sf)))


@query(
    "g3_gap_intervals",
    f"""with {_MISSING},
        runs as (select *, time - row_number() over (partition by point_id order by time) * interval 1 hour as run from missing)
        select point_id, min(time) as start, max(time) as "end", count(*) as n_hours from runs group by point_id, run""",
    "v_hourly",
)
def g3_intervals(spark, sf):
    return cal.missing_intervals(v.hourly(spark, sf))


@query(
    "g3_ranges_of_listed_hours",
    f"""with listed as (select distinct user_id as point_id, date_trunc('hour', ts) as time from events where event_type = 'click'),
        runs as (select *, time - row_number() over (partition by point_id order by time) * interval 1 hour as run from listed),
        placed as (select *, row_number() over (partition by point_id, run order by time) - 1 as pos from runs)
        select point_id, min(time) as start, max(time) as "end", count(*) as n_hours from placed group by point_id, run, pos // 8""",
)
def g3_listed(spark, sf):
    rows = v.table(spark, sf, "events").filter("event_type = 'click'")
    return cal.missing_ranges(rows.select(F.col("user_id").alias("point_id"), cal.hour_stamp(F.col("ts")).alias("time")))


@query("g4_gap_ranges_last_alone", _ranges_sql("time = max(time) over (partition by point_id)"), "v_hourly")
def g4(spark, sf):
    return cal.interval_ranges(cal.missing_intervals(v.hourly(spark, sf)), isolate_last=True)


@query(
    "g5_forecast_requests",
    """select point_id, time as start, time + interval 5 hour as "end",
              case when hour(time) = 0 then date_trunc('day', time) - interval 1 day else date_trunc('day', time) end::timestamp as run_start,
              case when hour(time) = 0 then 24 else hour(time) end::int as lead_from,
              case when hour(time + interval 5 hour) = 0 then date_trunc('day', time + interval 5 hour) - interval 1 day
                   else date_trunc('day', time + interval 5 hour) end::timestamp as run_end,
              case when hour(time + interval 5 hour) = 0 then 24 else hour(time + interval 5 hour) end::int as lead_to
       from v_hourly""",
    "v_hourly",
)
def g5(spark, sf):
    ranges = v.hourly(spark, sf).select("point_id", F.col("time").alias("start"))
    return cal.forecast_requests(ranges.withColumn("end", F.col("start") + F.expr("interval 5 hours")))


@query(
    "g6_request_intervals",
    """with plan as (select o_orderkey, o_orderdate as first_day, unnest(generate_series(0, o_orderkey % 4 - 1)) as d, o_orderkey % 4 as n_days from orders),
       kept as (select *, first_day + to_days(d::int) as day from plan)
       select o_orderkey, day + to_hours(6 * i) as start, day + to_hours(6 * i + 6) as "end"
       from kept, (values (0), (1), (2), (3)) as s(i)
       where day <= timestamp '2001-06-01 00:00:00' - interval 1 day and month(day) not in (6, 7, 8, 9)""",
)
def g6(spark, sf):
    plan = v.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").alias("first_day"), (F.col("o_orderkey") % 4).cast("int").alias("n_days")
    )
    out = cal.request_intervals(plan, "first_day", "n_days", "2001-06-01 00:00:00")
    return out.select("o_orderkey", "start", "end")


@query(
    "g7_range_hours",
    """select point_id, unnest(generate_series(time, time + to_hours((point_id % 4)::int), interval 1 hour)) as hour from v_hourly""",
    "v_hourly",
)
def g7(spark, sf):
    spans = v.hourly(spark, sf).select(
        "point_id", F.col("time").alias("start"),
        (F.col("time") + F.make_dt_interval(F.lit(0), (F.col("point_id") % 4).cast("int"))).alias("end"),
    )
    return cal.range_hours(spans, time_col="hour").select("point_id", "hour")


_CALENDAR = """
    counts as (select date, count(*) as n from v_days group by date),
    days as (select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as date
             from (select min(date) as lo, max(date) as hi from v_days))
"""


def _days(spark, sf):
    return v.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("date"), "o_custkey")


@query("g8_underfilled_days", f"""with {_CALENDAR} select date, coalesce(n, 0) as n from days left join counts using (date)
        where coalesce(n, 0) < 6""", "v_days")
def g8(spark, sf):
    return cal.underfilled_days(_days(spark, sf), 6)


@query(
    "g9_underfilled_ids",
    """with counted as (select cast(date as date) as date, count(*) as n from v_levels group by 1),
       days as (select d.date from (select cast(unnest(generate_series(min(date), max(date), interval 1 day)) as date) as date from counted) d
                left join counted c on c.date = d.date where coalesce(c.n, 0) < 160),
       ids as (select distinct id from v_points where id <> 202),
       counts as (select date, id, count(*) as n from v_levels group by date, id)
       select d.date, i.id, coalesce(c.n, 0) as n from days d cross join ids i
       left join counts c on c.date = d.date and c.id = i.id where coalesce(c.n, 0) < 5""",
    "v_levels v_points",
)
def g9(spark, sf):
    rows = v.levels(spark, sf).select("id", "date")
    days = cal.underfilled_days(rows, 160).select("date")
    return cal.underfilled_ids(rows, v.points(spark, sf), days, 5, excluded=[202]).select("date", "id", "n")


@query(
    "g10_underfilled_archive_days",
    """with seen as (select distinct zone_name, date from v_observed),
       counts as (select date, count(*) as n from seen group by date),
       days as (select cast(unnest(generate_series(lo, date '2024-02-05', interval 1 day)) as date) as date
                from (select min(date) as lo from seen))
       select date, coalesce(n, 0) as n from days left join counts using (date) where coalesce(n, 0) < 5""",
    "v_observed",
)
def g10(spark, sf):
    zones = v.observed(spark, sf).select("zone_name", "date").distinct()
    return cal.underfilled_days(zones, 5, last="2024-02-05")


@query(
    "g11_not_of_the_day",
    """select date, zone_name, elevation_band, actual_danger from v_observed where date <> date '2024-01-15'""",
    "v_observed",
)
def g11(spark, sf):
    _, others = cal.on_day(v.observed(spark, sf).drop("slope_angle"), "2024-01-15")
    return others


@query(
    "g12_failed_range_hours",
    """select distinct unnest(generate_series(date_trunc('hour', ts), date_trunc('hour', ts) + to_hours((event_id % 6)::int), interval 1 hour)) as time
       from events where event_type = 'error'""",
)
def g12(spark, sf):
    stamp = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    fmt = "yyyy-MM-dd HH:mm:ss"
    log = v.table(spark, sf, "events").filter("event_type = 'error'").select(
        F.date_format(stamp, fmt).alias("start"),
        F.date_format(stamp + F.make_dt_interval(F.lit(0), (F.col("event_id") % 6).cast("int")), fmt).alias("end"),
    )
    return cal.failed_ranges(log)


@query(
    "g13_season_sizes",
    """select case when month(o_orderdate) < 10 then year(o_orderdate) - 1 else year(o_orderdate) end::int as season,
              count(*) as n from orders where month(o_orderdate) not in (6, 7, 8, 9) group by 1""",
)
def g13(spark, sf):
    rows = v.table(spark, sf, "orders").filter(~cal.in_summer(F.col("o_orderdate")))
    return rows.groupBy(season_of(F.col("o_orderdate")).alias("season")).agg(F.count(F.lit(1)).alias("n"))


_BACKFILL = """with
    grid as (select p.point_id, unnest(generate_series({start}, {end}, interval 1 hour)) as t from (select distinct point_id from v_hourly) p),
    missing as (select point_id, t from grid g where month(t) not in (6, 7, 8, 9)
                and not exists (select 1 from v_hourly h where h.point_id = g.point_id and h.{col} = g.t)),
    runs as (select *, t - row_number() over (partition by point_id order by t) * interval 1 hour as run from missing),
    placed as (select *, row_number() over (partition by point_id, run order by t) - 1 as pos from runs),
    ranges as (select point_id, min(t) as start, max(t) as "end", count(*) as n_hours from placed group by point_id, run, pos // 8)
"""


@query(
    "g14_season_backfill",
    _BACKFILL.format(start="timestamp '2023-10-01 00:00:00'", end="timestamp '2024-01-31 00:00:00'", col="time")
    + "select * from ranges",
    "v_hourly",
)
def g14(spark, sf):
    from datetime import datetime

    return cal.season_backfill(v.hourly(spark, sf), 2023, datetime(2024, 1, 31))


@query(
    "g14_forecast_backfill",
    _BACKFILL.format(start="timestamp '2023-12-01 00:00:00'", end="timestamp '2024-02-01 00:00:00'", col="valid_time")
    + """select *,
         case when hour(start) = 0 then date_trunc('day', start) - interval 1 day else date_trunc('day', start) end::timestamp as run_start,
         case when hour(start) = 0 then 24 else hour(start) end::int as lead_from,
         case when hour("end") = 0 then date_trunc('day', "end") - interval 1 day else date_trunc('day', "end") end::timestamp as run_end,
         case when hour("end") = 0 then 24 else hour("end") end::int as lead_to from ranges""",
    "v_hourly",
)
def g14_forecast(spark, sf):
    from datetime import datetime

    return cal.forecast_backfill(v.hourly(spark, sf), 2023, datetime(2024, 1, 31))


_ALL_POINTS = _BACKFILL.replace("(select distinct point_id from v_hourly) p", "(select c_custkey as point_id from customer) p")


@query(
    "g14_backfill_of_listed_points",
    _ALL_POINTS.format(start="timestamp '2023-12-01 00:00:00'", end="timestamp '2024-02-01 00:00:00'", col="valid_time")
    + """select point_id, start, "end", n_hours,
         case when hour(start) = 0 then 24 else hour(start) end::int as lead_from,
         case when hour("end") = 0 then 24 else hour("end") end::int as lead_to from ranges""",
    "v_hourly",
)
def g14_listed(spark, sf):
    from datetime import datetime

    listed = v.table(spark, sf, "customer").select(F.col("c_custkey").alias("point_id"))
    return cal.forecast_backfill(v.hourly(spark, sf), 2023, datetime(2024, 1, 31), points=listed).drop("run_start", "run_end")


def _repair_sql(c: str) -> str:
    frame = "partition by point_id, fxx order by time range between interval 1 hour {} and interval 1 hour {}"
    usable = f"avg(case when {c} between 5 and 150 then {c} end) over"
    return (
        f"{usable} ({frame.format('preceding', 'preceding')}) as b_{c}, "
        f"{usable} ({frame.format('following', 'following')}) as a_{c}"
    )


@query(
    "c1_repair_outliers",
    f"""with sides as (select *, {_repair_sql('t')}, {_repair_sql('max_10si')} from v_hourly),
        fixed as (select point_id, fxx, time,
            case when t < 5 or t > 150 then coalesce((b_t + a_t) / 2, b_t, a_t) else t end as t,
            case when max_10si < 5 or max_10si > 150 then coalesce((b_max_10si + a_max_10si) / 2, b_max_10si, a_max_10si) else max_10si end as m from sides)
        select point_id, fxx, time, round(t, 6) as t, round(m, 6) as max_10si,
               (case when t is null then 1 else 0 end + case when m is null then 1 else 0 end)::int as unrepaired from fixed""",
    "v_hourly",
)
def c1(spark, sf):
    out = repair.repair_outliers(v.hourly(spark, sf), measures=["t", "max_10si"], low=5.0, high=150.0)
    return out.select("point_id", "fxx", "time", F.round("t", 6).alias("t"), F.round("max_10si", 6).alias("max_10si"), "unrepaired")


_MID = """mid as (select point_id, fxx, time + interval 1 hour as time, time + interval 2 hour as valid_time,
        (t + nt) / 2 as t, (max_10si + nm) / 2 as max_10si, (r2 + nr) / 2 as r2
        from (select *, lead(time) over w as nx, lead(t) over w as nt, lead(max_10si) over w as nm, lead(r2) over w as nr
              from v_hourly window w as (partition by point_id, fxx order by time))
        where nx = time + interval 2 hour and month(time + interval 1 hour) not in (6, 7, 8, 9))"""


@query(
    "c2_interpolated_hours",
    f"with {_MID} select point_id, fxx, time, valid_time, round(t, 6) as t, round(max_10si, 6) as max_10si, r2 from mid",
    "v_hourly",
)
def c2(spark, sf):
    out = repair.interpolated_hours(v.hourly(spark, sf))
    return out.withColumns({"t": F.round("t", 6), "max_10si": F.round("max_10si", 6)})


@query(
    "c3_repair_gaps",
    f"with {_MID} select point_id, fxx, time, valid_time, round(t, 6) as t, round(max_10si, 6) as max_10si, r2 from mid"
    " union all select point_id, fxx, time, valid_time, round(t, 6), round(max_10si, 6), r2 from v_hourly",
    "v_hourly",
)
def c3(spark, sf):
    out = repair.repair_gaps(v.hourly(spark, sf))
    return out.withColumns({"t": F.round("t", 6), "max_10si": F.round("max_10si", 6)})


@query(
    "c4_first_per_stamp",
    """select user_id as point_id, date_trunc('hour', ts) as time, arg_min(event_id, ts) as event_id, arg_min(value, ts) as value
       from events group by 1, 2""",
)
def c4(spark, sf):
    rows = v.table(spark, sf, "events").select(
        F.col("user_id").alias("point_id"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("time"),
        "ts", "event_id", "value",
    )
    return repair.first_per_stamp(rows, "ts").drop("ts")


@query(
    "c8_station_units",
    "select point_id, time, round(r2 / 100, 8) as r2, round(t / 100000 * 3600, 8) as prate from v_hourly",
    "v_hourly",
)
def c8(spark, sf):
    rows = v.hourly(spark, sf).select("point_id", "time", "r2", (F.col("t") / 100000).alias("prate"))
    return repair.station_units(rows).withColumns({"r2": F.round("r2", 8), "prate": F.round("prate", 8)})


@query(
    "c9_merge_runs",
    """select distinct id, slope_angle, slope_azi, timestamp, "TA",
              min(year(timestamp)) over (partition by id)::int as first_year, max(year(timestamp)) over (partition by id)::int as last_year
       from v_profile where "TA" is not null""",
    "v_profile",
)
def c9(spark, sf):
    rows = v.profile(spark, sf).select(
        "id", "slope_angle", "slope_azi", "timestamp", F.nullif(F.col("TA"), F.lit(-999.0)).alias("TA")
    )
    return repair.merge_runs([rows.filter("slope_azi < 180"), rows.filter("slope_azi >= 90")])


@query("c10_known_levels", "select * from v_observed_wide where lower > -1", "v_observed_wide")
def c10(spark, sf):
    return repair.known_levels(v.observed_wide(spark, sf))


@query(
    "u2_splice",
    """with spliced as (
         select point_id, time, valid_time, fxx, t, max_10si, r2, 0 as src from v_hourly where time <= timestamp '2024-01-20'
         union all
         select point_id, valid_time as time, valid_time, fxx, t + 1000 as t, max_10si, r2, 1 as src from v_hourly
         where cast(valid_time as date) = date '2024-01-20'
           and point_id in (select point_id from v_hourly where time <= timestamp '2024-01-20'))
       select point_id, time, valid_time, fxx, t, max_10si, r2 from spliced
       qualify row_number() over (partition by point_id, time order by src) = 1""",
    "v_hourly",
)
def u2(spark, sf):
    rows = v.hourly(spark, sf)
    forecast = rows.withColumn("t", F.col("t") + 1000)
    return repair.splice(rows, forecast, "2024-01-20")


_SPLICED = """spliced as (
         select point_id, time, t, 0 as src from v_hourly where time <= timestamp '2024-01-20'
         union all
         select point_id, valid_time as time, t + 1000 as t, 1 as src from v_hourly
         where cast(valid_time as date) = date '2024-01-20'
           and point_id in (select point_id from v_hourly where time <= timestamp '2024-01-20')),
       both_ as (select point_id, time, t from spliced qualify row_number() over (partition by point_id, time order by src) = 1),
       wrong as (select point_id, max(time) as last_time, date_diff('hour', min(time), max(time)) + 1 - count(distinct time) as missing_hours from both_ group by point_id
                 having date_diff('hour', min(time), max(time)) + 1 <> count(distinct time) or max(time) <> timestamp '2024-01-20 23:00:00')"""


@query("u2_p13_quarantine", f"with {_SPLICED} select point_id, last_time, missing_hours from wrong", "v_hourly")
def u2_quarantine(spark, sf):
    rows = v.hourly(spark, sf)
    return repair.checked_splice(rows, rows.withColumn("t", F.col("t") + 1000), "2024-01-20")[1]


_IDS_OF_A_PART = 1024


@query(
    "u2_p13_whole_series",
    """with base as (select distinct point_id from v_hourly), hours as (select unnest(generate_series(timestamp '2024-01-05', timestamp '2024-01-20 23:00:00', interval 1 hour)) as time),
       full_ as (select point_id, time from base, hours where not (point_id % 3 = 1 and hour(time) = 7 and day(time) = 9) and not (point_id % 5 = 2 and time > timestamp '2024-01-20 20:00:00'))
       select point_id, time from full_ where point_id % 3 <> 1 and point_id % 5 <> 2""",
    "v_hourly",
)
def u2_whole(spark, sf):
    """Whole series of every point, but for a lost hour of some and a lost end of others."""
    ids = cut_lineage(v.hourly(spark, sf).select("point_id").distinct(), "points")
    # An id becomes 384 rows, which the planner does not see: parts are made by their number, or one task gets all.
    ids = ids.repartition(max(1, -(-ids.count() // _IDS_OF_A_PART)), "point_id")
    hours = F.explode(F.sequence(F.lit("2024-01-05").cast("timestamp_ntz"), F.lit("2024-01-20 23:00:00").cast("timestamp_ntz"), F.expr("interval 1 hour")))
    rows = ids.withColumn("time", hours).withColumns({"valid_time": F.col("time"), "t": F.lit(1.0)}).filter(
        "not (point_id % 3 = 1 and hour(time) = 7 and day(time) = 9) and not (point_id % 5 = 2 and time > timestamp_ntz '2024-01-20 20:00:00')"
    )
    good, _ = repair.checked_splice(rows.filter("time <= timestamp_ntz '2024-01-20'"), rows, "2024-01-20")
    return good.select("point_id", "time")
