"""Queries for incremental ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeline import streaming as sm
from ridgeline.session import new_path
from suite import views as v
from suite.registry import query

KEYS = ["user_id", "event_type", "hour"]


def _stream(spark, sf):
    events = sm.read_stream(spark, f"{sf}/[e]vents.parquet", v.SCHEMAS["events"])
    return events.select("user_id", "event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))


@query("t1_ingest", "select distinct user_id, event_type, date_trunc('hour', ts) as hour from events")
def t1(spark, sf):
    table, check = new_path(spark, "ingest"), new_path(spark, "check")
    for _ in range(2):  # the second run finds nothing new
        sm.ingest_available(_stream(spark, sf), table, check, KEYS, "hour")
    return sm.stored_rows(spark, table)


@query("t1_within_delay", "select distinct user_id, event_type, date_trunc('hour', ts) as hour from events")
def t1_state(spark, sf):
    table, check = new_path(spark, "ingest"), new_path(spark, "check")
    stream = sm.within_delay(_stream(spark, sf), KEYS, "hour", "2 days")
    stream.writeStream.format("parquet").option("path", table).option("checkpointLocation", check).trigger(
        availableNow=True
    ).start().awaitTermination()
    return spark.read.parquet(table)


@query(
    "t1_missing_hours",
    """with grid as (select point_id, unnest(generate_series(lo, hi, interval 1 hour)) as time
                     from (select point_id, min(time) as lo, max(time) as hi from v_hourly group by point_id))
       select point_id, time from grid anti join v_hourly using (point_id, time)
       where time < (select max(time) from v_hourly) - interval 48 hour""",
    "v_hourly",
)
def t1_gaps(spark, sf):
    """The hours of G1 that are certain after the last file, from files that land in three batches."""
    rows = v.hourly(spark, sf).select("point_id", "time")
    landed, table, check = new_path(spark, "landed"), new_path(spark, "gaps"), new_path(spark, "check")
    for first, last in (("2000-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2100-01-01")):
        rows.filter((F.col("time") >= first) & (F.col("time") < last)).write.mode("append").parquet(landed)
        sm.gaps_available(sm.read_stream(spark, landed, rows.schema), table, check)
    return spark.read.parquet(table)


@query("t2_resume_point", "select max(date_trunc('hour', ts)) as resume_from from events")
def t2(spark, sf):
    table, check = new_path(spark, "ingest"), new_path(spark, "check")
    sm.ingest_available(_stream(spark, sf), table, check, KEYS, "hour")
    return sm.resume_point(sm.stored_rows(spark, table), "hour")


@query(
    "t3_repair_days",
    """with late as (select point_id, fxx, time, t * 2 as t from v_hourly where t > 100),
       merged as (select point_id, fxx, time, t from v_hourly h where not exists
                  (select 1 from late l where l.point_id = h.point_id and l.time = h.time) union all select * from late),
       touched as (select distinct cast(time as date) as d from late),
       around as (select distinct d + o as d from touched, (values (-1), (0), (1)) x(o)),
       near as (select * from merged where cast(time as date) in (select d from around)),
       mids as (select point_id, fxx, time + interval 1 hour as time, (t + nt) / 2 as t from
                  (select *, lead(time) over w as nx, lead(t) over w as nt from near window w as (partition by point_id order by time))
                where nx = time + interval 2 hour),
       whole as (select * from near union all select * from mids)
       select point_id, fxx, time, round(t, 6) as t from whole where cast(time as date) in (select d from touched)""",
    "v_hourly",
)
def t3(spark, sf):
    rows = v.hourly(spark, sf).select("point_id", "fxx", "time", "t")
    late = rows.filter("t > 100").withColumn("t", F.col("t") * 2)
    return sm.repair_days(rows, late).withColumn("t", F.round("t", 6))


@query(
    "t3_repaired_table",
    """with late as (select point_id, fxx, time, t * 2 as t from v_hourly where t > 100),
       merged as (select point_id, fxx, time, t from v_hourly h where not exists
                  (select 1 from late l where l.point_id = h.point_id and l.time = h.time) union all select * from late),
       touched as (select distinct cast(time as date) as d from late),
       around as (select distinct d + o as d from touched, (values (-1), (0), (1)) x(o)),
       near as (select * from merged where cast(time as date) in (select d from around)),
       mids as (select point_id, fxx, time + interval 1 hour as time, (t + nt) / 2 as t from
                  (select *, lead(time) over w as nx, lead(t) over w as nt from near window w as (partition by point_id order by time))
                where nx = time + interval 2 hour),
       whole as (select * from near union all select * from mids)
       select point_id, fxx, time, round(t, 6) as t from whole where cast(time as date) in (select d from touched)
       union all select point_id, fxx, time, round(t, 6) as t from v_hourly where cast(time as date) not in (select d from touched)""",
    "v_hourly",
)
def t3_table(spark, sf):
    rows = v.hourly(spark, sf).select("point_id", "fxx", "time", "t")
    table = new_path(spark, "hours")
    sm.store_days(spark, table, rows)
    late = rows.filter("t > 100").withColumn("t", F.col("t") * 2)
    sm.store_days(spark, table, sm.repair_days(sm.stored_rows(spark, table), late))
    return sm.stored_rows(spark, table).withColumn("t", F.round("t", 6))
