"""Queries for the column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeline import functions as fn
from suite import views as v
from suite.registry import query


@query(
    "f2_level_for_band",
    """select b.event_id, case elevation_band when 'lower' then w.lower when 'middle' then w.middle when 'upper' then w.upper end as level
       from v_banded b join v_observed_wide w using (date, zone_name)""",
    "v_banded v_observed_wide",
)
def f2(spark, sf):
    rows = v.levels(spark, sf).join(v.points(spark, sf).select("id", "zone_name"), "id").join(
        v.observed_wide(spark, sf), ["date", "zone_name"]
    )
    band = fn.elevation_band(F.col("altitude"))
    return rows.select("event_id", fn.level_for_band(band, {b: F.col(b) for b in ["lower", "middle", "upper"]}).alias("level"))


@query("f3_clip_level", "select event_id, least(predicted_danger, 3) as level from v_levels", "v_levels")
def f3(spark, sf):
    return v.levels(spark, sf).select("event_id", fn.clip_level(F.col("predicted_danger")).alias("level"))


@query(
    "f4_slope_label",
    "select event_id, case when slope_angle = 0 then 'flat' else 'slope' end as slope from v_levels",
    "v_levels",
)
def f4(spark, sf):
    return v.levels(spark, sf).select("event_id", fn.slope_label(F.col("slope_angle")).alias("slope"))


@query(
    "f5_zone_names",
    """select c_custkey as id, case lower(c_mktsegment) when 'building' then 'Whitefish' when 'machinery' then 'Swan'
              when 'household' then 'Glacier/Flathead' end as zone from customer""",
)
def f5(spark, sf):
    names = {"building": "Whitefish", "machinery": "Swan", "household": "Glacier/Flathead"}
    return v.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), fn.zone_name(F.col("c_mktsegment"), names, strict=False).alias("zone")
    )


@query(
    "f6_label_text",
    """select c_custkey, case c_custkey % 3 when 0 then 'lower' when 1 then 'middle' else 'upper' end as band,
              (c_custkey % 5)::int as level from customer""",
)
def f6(spark, sf):
    k = F.col("c_custkey")
    label = F.when(k % 3 == 0, "Low Elevation ").when(k % 3 == 1, "Mid-Elevation").otherwise("Upper Elevation (Above)")
    level = F.concat((k % 5).cast("string"), F.lit(" - Moderate"))
    return v.table(spark, sf, "customer").select(
        "c_custkey", fn.label_band(label).alias("band"), fn.label_level(level).alias("level")
    )


@query(
    "f7_unit_conversions",
    """select event_id, round(value * 9 / 5 + 32, 6) as fahrenheit, round(value * 2.23694, 6) as mph,
              round(value * 0.393701, 6) as inches, round(value / 25.4, 6) as water_inches from events""",
)
def f7(spark, sf):
    x = F.col("value")
    return v.table(spark, sf, "events").select(
        "event_id", F.round(fn.celsius_to_fahrenheit(x), 6).alias("fahrenheit"), F.round(fn.ms_to_mph(x), 6).alias("mph"),
        F.round(fn.cm_to_inches(x), 6).alias("inches"), F.round(fn.mm_to_inches(x), 6).alias("water_inches"),
    )


@query("f8_round_even", "select event_id, round_even(event_id / 8, 2) as two, round_even(event_id / 2, 0) as whole from events")
def f8(spark, sf):
    return v.table(spark, sf, "events").select(
        "event_id", fn.round_even(F.col("event_id") / 8, 2).alias("two"), fn.round_even(F.col("event_id") / 2, 0).alias("whole")
    )


@query(
    "f9_local_midnight",
    """select distinct cast(o_orderdate as date) as date,
              cast(epoch(o_orderdate at time zone 'America/Denver') as bigint) as epoch,
              strftime(o_orderdate, '%-m/%-d/%Y') as shown from orders""",
)
def f9(spark, sf):
    day = F.col("o_orderdate").cast("date").alias("date")
    days = v.table(spark, sf, "orders").select(day).distinct().withColumn("epoch", fn.local_midnight_epoch(F.col("date")))
    return days.withColumn("shown", fn.epoch_to_date(F.col("epoch")))


@query(
    "f10_local_clock",
    "select event_id, (ts at time zone 'UTC') at time zone 'America/Denver' as local from events",
)
def f10(spark, sf):
    return v.table(spark, sf, "events").select("event_id", fn.to_local(F.col("ts")).alias("local"))


@query(
    "f11_time_parts",
    """select o_orderkey, date_trunc('second', o_orderdate + to_seconds(o_orderkey % 86400)) as parsed,
              date_trunc('hour', o_orderdate + to_seconds(o_orderkey % 86400)) as hour, month(o_orderdate)::int as month from orders""",
)
def f11(spark, sf):
    stamp = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("o_orderkey") % 86400)
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format(stamp, "yyyy-MM-dd HH:mm:ss")).otherwise(
        F.date_format(stamp, "MM/dd/yyyy HH:mm:ss")
    )
    rows = v.table(spark, sf, "orders").select("o_orderkey", fn.parse_stamp(text).alias("parsed"), F.month("o_orderdate").alias("month"))
    return rows.withColumn("hour", fn.hour_stamp(F.col("parsed")))


@query(
    "f12_aspect",
    """select event_id, case when d >= 315 or d < 45 then 'N' when d < 135 then 'E' when d < 225 then 'S' else 'W' end as aspect
       from (select event_id, ((value * 7 - 900) % 360 + 360) % 360 as d from events)""",
)
def f12(spark, sf):
    return v.table(spark, sf, "events").select("event_id", fn.aspect(F.col("value") * 7 - 900).alias("aspect"))


@query(
    "f13_level_names",
    """select event_id, case l when 1 then 'Low' when 2 then 'Moderate' when 3 then 'Considerable' when 4 then 'High' else 'Unknown' end as name,
              case l when 1 then 'low' when 2 then 'mod' when 3 then 'con' when 4 then 'hig' else 'unknown' end as code,
              case l - 1 when 0 then 'green' when 1 then 'yellow' when 2 then 'orange' when 3 then 'red' end as colour
       from (select event_id, event_id % 6 - 1 as l from events)""",
)
def f13(spark, sf):
    level = F.col("event_id") % 6 - 1
    return v.table(spark, sf, "events").select(
        "event_id", fn.level_name(level).alias("name"), fn.level_code(level).alias("code"),
        fn.level_colour(level - 1).alias("colour"),
    )


@query(
    "f15_number_text",
    "select event_id, printf('%.2f%%', event_id % 1024 / 1024 * 100) as share, printf('%.1f', event_id / 4 + 0.1) as short from events",
)
def f15(spark, sf):
    k = F.col("event_id")
    return v.table(spark, sf, "events").select(
        "event_id", fn.as_percent(k % 1024 / 1024).alias("share"), fn.fixed_decimals(k / 4 + 0.1, 1).alias("short")
    )


@query(
    "f16_wind",
    """select vec_id, round(sqrt(u * u + w * w), 6) as speed,
              round(((270 - degrees(atan2(w, u))) % 360 + 360) % 360, 6) as direction
       from (select vec_id, embedding[1]::double as u, embedding[2]::double as w from embeddings)""",
)
def f16(spark, sf):
    u, w = F.get("embedding", F.lit(0)).cast("double"), F.get("embedding", F.lit(1)).cast("double")
    return v.table(spark, sf, "embeddings").select(
        "vec_id", F.round(fn.wind_speed(u, w), 6).alias("speed"), F.round(fn.wind_direction(u, w), 6).alias("direction")
    )


@query(
    "f17_midpoint",
    """with p as (select id, radians(lat) as a, radians(lat + 1) as b, lon, radians(2) as turn from v_points),
       m as (select id, a, b, lon, cos(b) * cos(turn) as bx, cos(b) * sin(turn) as yy from p)
       select id, round(degrees(atan2(sin(a) + sin(b), sqrt((cos(a) + bx) * (cos(a) + bx) + yy * yy))), 6) as lat,
              round((lon + degrees(atan2(yy, cos(a) + bx)) + 180 + 360) % 360 - 180, 6) as lon from m""",
    "v_points",
)
def f17(spark, sf):
    ends = [F.col("lat"), F.col("lon"), F.col("lat") + 1, F.col("lon") + 2]
    return v.points(spark, sf).select(
        "id", F.round(fn.midpoint_lat(*ends), 6).alias("lat"), F.round(fn.midpoint_lon(*ends), 6).alias("lon")
    )


@query(
    "f19_cumulative_targets",
    """select event_id, predicted_danger - 1 as shifted, (predicted_danger <= 1)::int as le_1, (predicted_danger <= 2)::int as le_2,
              (predicted_danger <= 3)::int as le_3 from v_levels""",
    "v_levels",
)
def f19(spark, sf):
    level = F.col("predicted_danger")
    return v.levels(spark, sf).select("event_id", fn.shift_label(level).alias("shifted"), *fn.cumulative_targets(level))


@query(
    "f20_most_likely_class",
    "select vec_id, (list_position(embedding, list_max(embedding)) - 1)::int as best from embeddings",
)
def f20(spark, sf):
    return v.table(spark, sf, "embeddings").select("vec_id", fn.most_likely_class(F.col("embedding")).alias("best"))
