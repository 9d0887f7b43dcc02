"""Queries for selection, validation and null handling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeline.operators import calendar as cal
from ridgeline.operators import checks as ck
from ridgeline.schemas import STATION_FIELDS
from suite import views as v
from suite.registry import query


@query("p1_keep_columns", "select time, valid_time, fxx, t, point_id, r2, max_10si from v_hourly", "v_hourly")
def p1(spark, sf):
    return ck.keep_columns(v.hourly(spark, sf).withColumn("step", F.lit(1)))


@query(
    "p2_rename_columns",
    """select point_id, fxx, valid_time, time as timestamp, t as "TSG", r2 as "RH", max_10si as "VW_MAX" from v_hourly""",
    "v_hourly",
)
def p2(spark, sf):
    return ck.rename_columns(v.hourly(spark, sf), STATION_FIELDS)


@query("p3_feature_columns", 'select "TA", "RH", "VW", "HN24", "SWE", hoar_size, "ISWR" from v_profile', "v_profile")
def p3(spark, sf):
    rows = v.profile(spark, sf).withColumn("TA", F.nullif(F.col("TA"), F.lit(-999.0)))
    features, _ = ck.split_columns(rows, ["id", "slope_angle", "slope_azi", "timestamp", "altitude"])
    return rows.select(*features)


@query("p4_drop_all_sentinel", 'select id, timestamp, coalesce("TA", -999) as "TA" from v_profile', "v_profile")
def p4(spark, sf):
    rows = v.profile(spark, sf).select("id", "timestamp", "TA", F.lit(-999.0).alias("HS_meas"))
    return ck.drop_all_sentinel(rows)


@query(
    "p5_range_filters",
    "select * from v_observed where date >= date '2024-01-10' and date <= date '2024-01-20' and actual_danger >= 2",
    "v_observed",
)
def p5(spark, sf):
    return v.observed(spark, sf).filter("date between '2024-01-10' and '2024-01-20' and actual_danger >= 2")


@query("p6_slope_only", 'select id, timestamp, slope_azi, "VW" from v_profile where slope_angle > 0', "v_profile")
def p6(spark, sf):
    return v.profile(spark, sf).filter("slope_angle > 0").select("id", "timestamp", "slope_azi", "VW")


@query(
    "p7_rows_of_listed_days",
    "select event_id, date from v_levels where date in (select date from v_observed where actual_danger = 4 and zone_name = 'ASIA' and elevation_band = 'upper')",
    "v_levels v_observed",
)
def p7(spark, sf):
    days = v.observed(spark, sf).filter(
        "actual_danger = 4 and zone_name = 'ASIA' and elevation_band = 'upper'"
    ).select("date")
    return v.levels(spark, sf).select("event_id", "date").join(days, "date", "left_semi")


_LONG = """long as (
    select point_id, time, ':TMP:surface' as variable, t as value from v_hourly union all
    select point_id, time, ':RH:2 m above ground' as variable, r2 as value from v_hourly union all
    select point_id, time, ':CAPE:255-0 mb' as variable, max_10si as value from v_hourly)"""


@query(
    "p9_pick_variables",
    f"""with {_LONG} select point_id, time, max(case when variable = ':TMP:surface' then value end) as "TMP",
        max(case when variable = ':RH:2 m above ground' then value end) as "RH" from long
        where regexp_matches(variable, ':(?:TMP|RH):(?:surface|2 m)') group by point_id, time""",
    "v_hourly",
)
def p9(spark, sf):
    names = {"t": ":TMP:surface", "r2": ":RH:2 m above ground", "max_10si": ":CAPE:255-0 mb"}
    rows = v.hourly(spark, sf).withColumnsRenamed(names).unpivot(
        ["point_id", "time"], [f"`{n}`" if " " in n else n for n in names.values()], "variable", "value"
    )
    out = ck.pick_variables(rows, [":TMP:surface", ":RH:2 m above ground"], ["point_id", "time"])
    return out.withColumnsRenamed({":TMP:surface": "TMP", ":RH:2 m above ground": "RH"})


@query(
    "p10_required_columns",
    "select point_id, count(*) as n from v_hourly group by point_id",
    "v_hourly",
)
def p10(spark, sf):
    return ck.require_columns(v.hourly(spark, sf)).groupBy("point_id").agg(F.count(F.lit(1)).alias("n"))


_HOLES = """holes as (select point_id, time, case when r2 > 1 then null else t end as t,
                             case when point_id % 7 = 0 then null else max_10si end as max_10si from v_hourly)"""


def _holes(spark, sf):
    return v.hourly(spark, sf).select(
        "point_id", "time", F.when(F.col("r2") <= 1, F.col("t")).alias("t"),
        F.when(F.col("point_id") % 7 != 0, F.col("max_10si")).alias("max_10si"),
    )


@query(
    "p11_null_report",
    f"""with {_HOLES} select 't' as "column", true as present, count(*) filter (t is null) as nulls from holes
        union all select 'max_10si', true, count(*) filter (max_10si is null) from holes
        union all select 'sde', false, count(*) from holes""",
    "v_hourly",
)
def p11(spark, sf):
    return ck.null_report(_holes(spark, sf), ["t", "max_10si", "sde"])


@query(
    "p11_incomplete_rows",
    f"""with {_HOLES} select *, concat_ws(',', case when t is null then 't' end, case when max_10si is null then 'max_10si' end) as missing
        from holes where t is null or max_10si is null""",
    "v_hourly",
)
def p11_rows(spark, sf):
    return ck.split_incomplete(_holes(spark, sf), ["point_id", "time", "t", "max_10si"])[1]


@query("p12_report_columns", "select date, zone_name, elevation_band, slope_angle from v_observed", "v_observed")
def p12(spark, sf):
    wanted = ["date", "zone_name", "elevation_band", "slope_angle"]
    return ck.require_columns(v.observed(spark, sf), wanted, non_empty=False).select(*wanted)


@query(
    "p13_series_violations",
    """with span as (select point_id, min(time) as lo, max(time) as last_time, count(*) as n from v_hourly group by point_id)
       select point_id, last_time, date_diff('hour', lo, last_time) + 1 - n as missing_hours from span
       where date_diff('hour', lo, last_time) + 1 - n > 0 or last_time <> timestamp '2024-01-30 23:00:00'""",
    "v_hourly",
)
def p13(spark, sf):
    rows = v.hourly(spark, sf)
    return ck.series_violations(rows, cal.missing_hours(rows), F.lit("2024-01-30 23:00:00").cast("timestamp_ntz"))


@query(
    "p14_interval_rejects",
    """select l_orderkey, l_linenumber, l_shipdate as start, o_orderdate as "end", 'start after end' as reason
       from lineitem join orders on l_orderkey = o_orderkey where l_shipdate > o_orderdate""",
)
def p14(spark, sf):
    spans = v.table(spark, sf, "lineitem").join(
        v.table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select("l_orderkey", "l_linenumber", F.col("l_shipdate").alias("start"), F.col("o_orderdate").alias("end"))
    return ck.split_intervals(spans)[1]


@query("c5_sentinel_to_null", 'select id, timestamp, "TA" from v_profile', "v_profile")
def c5(spark, sf):
    return ck.nulls_for_sentinel(v.profile(spark, sf).select("id", "timestamp", "TA"), ["TA"])


@query("c6_drop_null_rows", f"with {_HOLES} select * from holes where t is not null and max_10si is not null", "v_hourly")
def c6(spark, sf):
    return _holes(spark, sf).na.drop("any")


@query(
    "c7_fill_with_zero",
    f"with {_HOLES} select point_id, time, coalesce(t, 0) as t, coalesce(max_10si, 0) as max_10si from holes",
    "v_hourly",
)
def c7(spark, sf):
    return _holes(spark, sf).na.fill(0.0)


@query(
    "j7_points_without_rows",
    "select c_custkey as id from customer where c_custkey not in (select o_custkey from orders where o_orderdate < timestamp '1996-01-01')",
)
def j7(spark, sf):
    from ridgeline.operators.combine import rows_without

    orders = v.table(spark, sf, "orders").filter("o_orderdate < '1996-01-01'").select(F.col("o_custkey").alias("id"))
    return rows_without(v.points(spark, sf), orders, ["id"])
