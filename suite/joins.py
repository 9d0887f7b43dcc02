"""Queries for joins and set operations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ridgeline.operators import calendar as cal
from ridgeline.operators import combine as cb
from ridgeline.operators.repair import interpolated_hours, neighbour_means
from ridgeline.plans import levels as pl
from suite import views as v
from suite.registry import query


@query(
    "j1_merge_groups",
    """with a as (select point_id, time, valid_time, fxx as step, t from v_hourly where t > 20),
       b as (select point_id, time, valid_time, fxx as step, r2 from v_hourly where max_10si < 80),
       c as (select point_id, time, valid_time, fxx as step, max_10si from v_hourly where hour(time) < 20)
       select point_id, time, valid_time, step, t, r2, max_10si
       from a full join b using (point_id, time, valid_time, step) full join c using (point_id, time, valid_time, step)""",
    "v_hourly",
)
def j1(spark, sf):
    rows = v.hourly(spark, sf).withColumnRenamed("fxx", "step")
    keys = ["point_id", "time", "valid_time", "step"]
    a = rows.filter("t > 20").select(*keys, "t")
    b = rows.filter("max_10si < 80").select(*keys, "r2")
    c = rows.filter("hour(time) < 20").select(*keys, "max_10si")
    halves = [c.filter("hour(time) < 12"), c.filter("hour(time) >= 12")]
    return cb.merge_groups([a, b, halves])


@query("j2_with_points", "select event_id, l.id, date, zone_name from v_levels l join v_points p on l.id = p.id", "v_levels v_points")
def j2(spark, sf):
    return cb.with_points(v.levels(spark, sf).select("event_id", "id", "date"), v.points(spark, sf))


@query(
    "j3_with_wide_levels",
    "select event_id, date, zone_name, upper, middle, lower from v_banded join v_observed_wide using (date, zone_name)",
    "v_banded v_observed_wide",
)
def j3(spark, sf):
    rows = cb.with_points(v.levels(spark, sf).select("event_id", "id", "date"), v.points(spark, sf)).drop("id")
    return cb.with_wide_levels(rows, v.observed_wide(spark, sf))


@query(
    "j4_with_zone_prediction",
    """select b.event_id, date, zone_name, elevation_band, z.predicted_danger from v_banded b
       join (select * from v_zone_day where slope_angle = 'slope') z using (date, zone_name, elevation_band)""",
    "v_banded v_zone_day",
)
def j4(spark, sf):
    rows = pl.banded(v.levels(spark, sf), v.points(spark, sf)).select(
        "event_id", "date", "zone_name", "elevation_band", "predicted_danger"
    )
    return cb.with_zone_prediction(rows, v.zone_day(spark, sf).filter("slope_angle = 'slope'"))


@query("j5_actual_and_predicted", "select * from v_both", "v_both")
def j5(spark, sf):
    return cb.actual_and_predicted(v.observed(spark, sf), v.zone_day(spark, sf))


@query(
    "j6_with_outline",
    """select zone_name, date, elevation_band, actual_danger, r_regionkey * 10.0::double as west
       from v_observed join region on r_name = zone_name""",
    "v_observed",
)
def j6(spark, sf):
    zones = v.table(spark, sf, "region").select(
        F.col("r_name").alias("zone_name"), (F.col("r_regionkey") * F.lit(10.0)).alias("west")
    )
    return cb.with_outline(v.observed(spark, sf).drop("slope_angle"), zones)


@query(
    "j8_neighbour_hours",
    """select h.point_id, h.time, p.t as before, n.t as after from v_hourly h
       left join v_hourly p on p.point_id = h.point_id and p.time = h.time - interval 1 hour
       left join v_hourly n on n.point_id = h.point_id and n.time = h.time + interval 1 hour
       where p.t is not null or n.t is not null""",
    "v_hourly",
)
def j8(spark, sf):
    rows = v.hourly(spark, sf).select("point_id", "fxx", "time", "t")
    return neighbour_means(rows, rows, measures=["t"]).select(
        "point_id", "time", F.col("before_t").alias("before"), F.col("after_t").alias("after")
    )


@query(
    "j9_calendar_counts",
    """with counts as (select date, count(*) as n from v_days group by date),
       days as (select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as date
                from (select min(date) as lo, max(date) as hi from v_days))
       select date, coalesce(n, 0) as n from days left join counts using (date)""",
    "v_days",
)
def j9(spark, sf):
    return cal.calendar_counts(v.table(spark, sf, "orders").select(F.col("o_orderdate").alias("date")))


@query(
    "j10_complete_bands",
    """select z.zone_name, b.elevation_band, o.n from (select distinct zone_name from v_observed) z
       cross join (values ('lower'), ('middle'), ('upper')) b(elevation_band)
       left join (select zone_name, elevation_band, count(*) as n from v_observed where actual_danger > 2 and elevation_band <> 'middle'
                  group by all) o
       on o.zone_name = z.zone_name and o.elevation_band = b.elevation_band""",
    "v_observed",
)
def j10(spark, sf):
    rows = v.observed(spark, sf).groupBy("zone_name", "elevation_band").agg(
        F.count_if((F.col("actual_danger") > 2) & (F.col("elevation_band") != "middle")).alias("n")
    )
    return cb.complete_bands(rows.withColumn("n", F.when(F.col("n") > 0, F.col("n"))))


@query(
    "u1_union_batches",
    """select point_id, time, t, null::double as r2 from v_hourly where hour(time) < 12
       union all select point_id, time, t, r2 from v_hourly""",
    "v_hourly",
)
def u1(spark, sf):
    rows = v.hourly(spark, sf).select("point_id", "time", "t", "r2")
    return cb.union_all([rows.filter("hour(time) < 12").drop("r2"), rows])


@query("u3_distinct_rows", "select distinct user_id, event_type from events")
def u3(spark, sf):
    return cb.distinct_rows(v.table(spark, sf, "events").select("user_id", "event_type"))


@query(
    "u5_rows_without",
    """with grid as (select distinct o_custkey as id, cast(o_orderdate as date) as date from orders),
       have as (select c_custkey as id from customer where c_mktsegment = 'BUILDING')
       select id, date from grid anti join have using (id)""",
)
def u5(spark, sf):
    rows = v.table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderdate").cast("date").alias("date"))
    have = v.table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id"))
    return rows.distinct().join(cb.rows_without(rows, have, ["id"]), "id", "left_semi")


@query("u6_label_values", "select actual_danger as level from v_levels union select predicted_danger from v_levels", "v_levels")
def u6(spark, sf):
    return cb.label_values(v.levels(spark, sf), "actual_danger", "predicted_danger")


@query(
    "u7_update_archive",
    """with kept as (select * from v_observed_wide where not (dayofweek(date) = 0 and zone_name < 'ASIA')),
       counts as (select date, count(*) as n from kept group by date),
       days as (select cast(unnest(generate_series(lo, date '2024-02-05', interval 1 day)) as date) as date from (select min(date) as lo from kept)),
       lacking as (select date from days left join counts using (date) where coalesce(n, 0) < 5),
       whole as (select zone_name, date, upper, middle, lower from kept
                 union select zone_name, date, upper, middle, lower from v_observed_wide where date in (select date from lacking)),
       long as (from whole unpivot include nulls (actual_danger for elevation_band in (upper, middle, lower)))
       select date, 'zone ' || lower(zone_name) as zone_name, elevation_band, actual_danger, 'slope' as slope_angle from long""",
    "v_observed_wide",
)
def u7(spark, sf):
    wide = v.observed_wide(spark, sf)
    archive = wide.filter("not (dayofweek(date) = 1 and zone_name < 'ASIA')")
    aliases = {z.lower(): f"zone {z.lower()}" for z in v.REGIONS}
    return pl.update_archive(archive, wide, date(2024, 2, 5), 5, aliases)[1]


@query(
    "j8_filled_series",
    """select point_id, count(*) as n from (select point_id, time, lead(time) over (partition by point_id order by time) as nx from v_hourly)
       where nx = time + interval 2 hour group by point_id""",
    "v_hourly",
)
def filled(spark, sf):
    return interpolated_hours(v.hourly(spark, sf)).groupBy("point_id").agg(F.count(F.lit(1)).alias("n"))
