"""Derived tables: the supplied tables in the shape the operators expect.

Every table exists twice, as a DataFrame and as SQL, with the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.functions import elevation_band, hour_stamp, hours, shifted_day
from ridgeline.operators.aggregate import mode_highest
from ridgeline.plans.levels import zone_levels

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


# Declared, so that opening a table needs no job that reads its footer.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    """One row per user and hour with events."""
    stamp = hour_stamp(F.col("ts"))
    rows = table(spark, sf, "events").groupBy(F.col("user_id").alias("point_id"), stamp.alias("time")).agg(
        F.min("value").alias("t"), F.max("value").alias("max_10si"),
        F.count(F.lit(1)).cast("double").alias("r2"),
    )
    return rows.withColumns({"fxx": F.lit(1), "valid_time": F.col("time") + hours(1)})


def profile(spark: SparkSession, sf: str) -> DataFrame:
    """Events as simulated hours of a point and slope; some values are the sentinel."""
    return table(spark, sf, "events").select(
        F.col("user_id").alias("id"),
        F.when(F.col("event_type") == "view", 0.0).otherwise(38.0).alias("slope_angle"),
        (F.col("event_id") % 4 * 90).cast("double").alias("slope_azi"),
        (F.col("user_id") % 100 * 30).cast("double").alias("altitude"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_id") % 50 == 0, -999.0).otherwise(F.col("value")).alias("TA"),
        F.get_json_object("props", "$.k").cast("double").alias("RH"),
        (F.col("value") / 10).alias("VW"),
        (F.col("event_id") % 30).cast("double").alias("HN24"),
        (F.col("event_id") % 200).cast("double").alias("SWE"),
        (F.col("event_id") % 7).cast("double").alias("hoar_size"),
        (F.col("event_id") % 500).cast("double").alias("ISWR"),
    )


def points(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as points; the region is the zone."""
    nation = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", F.col("r_name").alias("zone_name"))
    return table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("id"),
        (F.col("c_custkey") % 97 * 0.1 + 40).alias("lat"),
        (F.col("c_custkey") % 89 * 0.1 - 120).alias("lon"),
        "zone_name",
        (F.abs("c_acctbal") * 0.3).alias("altitude"),
    )


def levels(spark: SparkSession, sf: str) -> DataFrame:
    """Events as point predictions with the observed level beside them."""
    return table(spark, sf, "events").select(
        F.col("event_id"), F.col("user_id").alias("id"), shifted_day(F.col("ts")).alias("date"),
        F.when(F.col("event_type") == "view", 0.0).otherwise(38.0).alias("slope_angle"),
        (F.col("event_id") % 4 * 90).cast("double").alias("slope_azi"),
        (F.col("user_id") % 100 * 30).cast("double").alias("altitude"),
        (F.col("event_id") % 4 + 1).cast("int").alias("predicted_danger"),
        (F.floor(F.col("event_id") / 4) % 4 + 1).cast("int").alias("actual_danger"),
    )


def zone_day(spark: SparkSession, sf: str) -> DataFrame:
    """Predicted level per zone, day and band."""
    return zone_levels(levels(spark, sf).drop("actual_danger"), points(spark, sf).select("id", "zone_name"))


def observed(spark: SparkSession, sf: str) -> DataFrame:
    """Observed level per zone, day and band, slopes only."""
    rows = levels(spark, sf).filter("slope_angle > 0").join(points(spark, sf).select("id", "zone_name"), "id")
    rows = rows.withColumn("elevation_band", elevation_band(F.col("altitude")))
    out = mode_highest(rows, ["date", "zone_name", "elevation_band"], "actual_danger")
    return out.withColumn("slope_angle", F.lit("slope"))


def observed_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Observed levels with one column per band."""
    return observed(spark, sf).groupBy("zone_name", "date").pivot(
        "elevation_band", ["upper", "middle", "lower"]
    ).agg(F.first("actual_danger"))


def training(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as daily feature rows over several seasons, priority as level."""
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("quantity"), F.avg("l_discount").alias("discount"),
        F.avg("l_tax").alias("tax"), F.count(F.lit(1)).cast("double").alias("n_lines"),
    )
    return table(spark, sf, "orders").join(lines, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_totalprice").alias("price"), "quantity", "discount", "tax", "n_lines",
        F.least(F.substring("o_orderpriority", 1, 1).cast("int"), F.lit(4)).alias("danger_level"),
    )


TRAINING_FEATURES = ["price", "quantity", "discount", "tax", "n_lines"]


def rated(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as daily rows whose level follows two features by a rule; the third says nothing."""
    snow, wind = F.col("o_custkey") % 24, F.col("o_orderkey") % 10
    level = 1 + (snow >= 8).cast("int") + (snow >= 16).cast("int") + ((snow >= 16) & (wind >= 5)).cast("int")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("date"),
        snow.cast("double").alias("snow"), wind.cast("double").alias("wind"), (F.col("o_totalprice") % 100).alias("noise"),
        level.alias("danger_level"),
    )


RATED_FEATURES = ["snow", "wind", "noise"]

_DAY = "cast((ts at time zone 'UTC') at time zone 'America/Denver' + interval 5 hour as date)"
_BAND = (
    "case when altitude >= 0 and altitude < 5000 / 3.281 then 'lower' "
    "when altitude >= 5000 / 3.281 and altitude < 6500 / 3.281 then 'middle' "
    "when altitude >= 6500 / 3.281 and altitude < 13000 / 3.281 then 'upper' end"
)

VIEWS = {
    "v_rated": """
        select o_orderkey as id, cast(o_orderdate as date) as date, (o_custkey % 24)::double as snow, (o_orderkey % 10)::double as wind,
               (1 + (o_custkey % 24 >= 8)::int + (o_custkey % 24 >= 16)::int + (o_custkey % 24 >= 16 and o_orderkey % 10 >= 5)::int)::int as danger_level
        from orders""",
    "v_hourly": """
        select user_id as point_id, date_trunc('hour', ts) as time, min(value) as t, max(value) as max_10si,
               cast(count(*) as double) as r2, 1 as fxx, date_trunc('hour', ts) + interval 1 hour as valid_time
        from events group by user_id, date_trunc('hour', ts)""",
    "v_profile": f"""
        select user_id as id, case when event_type = 'view' then 0.0 else 38.0 end::double as slope_angle,
               (event_id % 4 * 90)::double as slope_azi, (user_id % 100 * 30)::double as altitude,
               ts as timestamp, {_DAY} as date,
               case when event_id % 50 = 0 then null else value end as "TA",
               cast(json_extract_string(props, '$.k') as double) as "RH", value / 10 as "VW",
               (event_id % 30)::double as "HN24", (event_id % 200)::double as "SWE",
               (event_id % 7)::double as hoar_size, (event_id % 500)::double as "ISWR"
        from events""",
    "v_points": """
        select c_custkey as id, c_custkey % 97 * 0.1::double + 40 as lat, c_custkey % 89 * 0.1::double - 120 as lon,
               r_name as zone_name, abs(c_acctbal) * 0.3::double as altitude
        from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "v_levels": f"""
        select event_id, user_id as id, {_DAY} as date,
               case when event_type = 'view' then 0.0 else 38.0 end::double as slope_angle,
               (event_id % 4 * 90)::double as slope_azi, (user_id % 100 * 30)::double as altitude,
               (event_id % 4 + 1)::int as predicted_danger, (event_id // 4 % 4 + 1)::int as actual_danger
        from events""",
    "v_banded": f"""
        select l.*, p.zone_name, {_BAND.replace('altitude', 'l.altitude')} as elevation_band
        from v_levels l join v_points p on l.id = p.id""",
    "v_zone_day": """
        select date, zone_name, elevation_band, slope_angle, arg_max(predicted_danger, n * 1000 + predicted_danger) as predicted_danger
        from (select date, zone_name, elevation_band, case when slope_angle = 0 then 'flat' else 'slope' end as slope_angle,
                     predicted_danger, count(*) as n
              from v_banded group by all) group by date, zone_name, elevation_band, slope_angle""",
    "v_observed": """
        select date, zone_name, elevation_band, arg_max(actual_danger, n * 1000 + actual_danger) as actual_danger, 'slope' as slope_angle
        from (select date, zone_name, elevation_band, actual_danger, count(*) as n
              from v_banded where slope_angle > 0 group by all) group by date, zone_name, elevation_band""",
    "v_observed_wide": """
        select zone_name, date, max(case when elevation_band = 'upper' then actual_danger end) as upper,
               max(case when elevation_band = 'middle' then actual_danger end) as middle,
               max(case when elevation_band = 'lower' then actual_danger end) as lower
        from v_observed group by zone_name, date""",
    "v_both": """
        select o.zone_name, o.date, o.elevation_band, o.actual_danger, z.predicted_danger
        from v_observed o join v_zone_day z using (zone_name, date, elevation_band) where z.slope_angle = 'slope'""",
    "v_training": """
        select o_orderkey as id, cast(o_orderdate as date) as date, o_totalprice as price,
               least(cast(substr(o_orderpriority, 1, 1) as int), 4) as danger_level
        from orders""",
    "v_days": "select cast(o_orderdate as date) as date, o_orderkey, o_custkey from orders",
}
NEEDS = {
    "v_banded": ["v_levels", "v_points"],
    "v_zone_day": ["v_banded"],
    "v_observed": ["v_banded"],
    "v_observed_wide": ["v_observed"],
    "v_both": ["v_observed", "v_zone_day"],
}
LOCAL_DAY_SQL = _DAY
BAND_SQL = _BAND


def with_views(sql: str, names: Sequence[str]) -> str:
    """SQL with the derived tables it needs in front."""
    order: list[str] = []

    def need(name: str) -> None:
        for before in NEEDS.get(name, []):
            need(before)
        if name not in order:
            order.append(name)

    for name in names:
        need(name)
    text = sql.strip()
    if not order:
        return text
    ctes = ", ".join(f"{n} as ({VIEWS[n].strip()})" for n in order)
    return f"with {ctes}, {text[4:].strip()}" if text[:4].lower() == "with" else f"with {ctes} {text}"
