"""Queries for cells, boxes and pixels.

The grid comes from parts, the places from customers, the pixels from line
items; all three grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeline.operators import spatial as sp
from suite import views as v
from suite.registry import query

_W = 40  # columns of the grid
_CELLS_SQL = f"""cells as (select (p_partkey // {_W})::int as iy, (p_partkey % {_W})::int as ix,
        p_partkey // {_W} * 0.25::double + (p_partkey * 37 % 11) * 0.004::double as lat,
        p_partkey % {_W} * 0.25::double + (p_partkey * 53 % 13) * 0.004::double as lon from part)"""
_PLACES_SQL = """places as (select c_custkey as id, c_custkey % 331 * 0.037::double as lat, c_custkey % 257 * 0.041::double as lon from customer)"""
_NEAR_SQL = f"""{_CELLS_SQL}, {_PLACES_SQL},
    spots as (select distinct lat, lon from places),
    best as (select s.lat, s.lon, arg_min(struct_pack(iy := c.iy, ix := c.ix),
                    struct_pack(d := (s.lat - c.lat) * (s.lat - c.lat) + (s.lon - c.lon) * (s.lon - c.lon), iy := c.iy, ix := c.ix)) as m
             from spots s, cells c group by s.lat, s.lon),
    near as (select id, p.lat, p.lon, m.iy as iy, m.ix as ix from places p join best b on p.lat = b.lat and p.lon = b.lon)"""
_PIXELS_SQL = """pixels as (select 'r' || (l_linenumber % 3) as file, l_partkey % 1009 * 0.0101::double as x, l_orderkey % 1013 * 0.0127::double as y,
        case when l_quantity > 45 then -9999 else l_quantity end::double as elevation_m from lineitem)"""
_BOXES_SQL = f"""{_PLACES_SQL}, boxes as (select id, lat - 0.08 as min_lat, lat + 0.08 as max_lat, lon - 0.06 as min_lon, lon + 0.06 as max_lon
        from places)"""


def cells(spark, sf):
    k = F.col("p_partkey")
    return v.table(spark, sf, "part").select(
        F.floor(k / _W).cast("int").alias("iy"), (k % _W).cast("int").alias("ix"),
        (F.floor(k / _W) * F.lit(0.25) + k * 37 % 11 * F.lit(0.004)).alias("lat"),
        (k % _W * F.lit(0.25) + k * 53 % 13 * F.lit(0.004)).alias("lon"),
    )


def places(spark, sf):
    k = F.col("c_custkey")
    return v.table(spark, sf, "customer").select(
        k.alias("id"), (k % 331 * F.lit(0.037)).alias("lat"), (k % 257 * F.lit(0.041)).alias("lon")
    )


def pixels(spark, sf):
    return v.table(spark, sf, "lineitem").select(
        F.concat(F.lit("r"), (F.col("l_linenumber") % 3).cast("string")).alias("file"),
        (F.col("l_partkey") % 1009 * F.lit(0.0101)).alias("x"), (F.col("l_orderkey") % 1013 * F.lit(0.0127)).alias("y"),
        F.when(F.col("l_quantity") > 45, -9999.0).otherwise(F.col("l_quantity")).alias("elevation_m"),
    )


def box_table(spark, sf):
    return places(spark, sf).select(
        "id", (F.col("lat") - 0.08).alias("min_lat"), (F.col("lat") + 0.08).alias("max_lat"),
        (F.col("lon") - 0.06).alias("min_lon"), (F.col("lon") + 0.06).alias("max_lon"),
    )


@query("j11_nearest_cell", f"with {_NEAR_SQL} select id, iy, ix from near")
def j11(spark, sf):
    return sp.nearest_cell(places(spark, sf), cells(spark, sf), 0.5).select("id", "iy", "ix")


@query(
    "j12_pick_cells",
    f"""with {_NEAR_SQL}, vals as (select (l_partkey // {_W})::int as iy, (l_partkey % {_W})::int as ix, l_orderkey, l_linenumber from lineitem)
        select id, iy, ix, l_orderkey, l_linenumber from vals join near using (iy, ix)""",
)
def j12(spark, sf):
    k = F.col("l_partkey")
    values = v.table(spark, sf, "lineitem").select(
        F.floor(k / _W).cast("int").alias("iy"), (k % _W).cast("int").alias("ix"), "l_orderkey", "l_linenumber"
    )
    return sp.pick_cells(values, sp.nearest_cell(places(spark, sf), cells(spark, sf), 0.5))


_OFFSETS_SQL = "(values (0, -1, 0), (1, -1, -1), (2, 0, -1), (3, 1, -1), (4, 1, 0), (5, 1, 1), (6, 0, 1), (7, -1, 1)) o(ord, dy, dx)"
_MID_SQL = f"""{_NEAR_SQL}, ends as (
      select n.id, o.ord::int as ord, c.iy as index_y, c.ix as index_x, radians(n.lat) as a, radians(c.lat) as b, n.lon, radians(c.lon - n.lon) as turn
      from near n, {_OFFSETS_SQL}, cells c where c.iy = n.iy + o.dy and c.ix = n.ix + o.dx),
    mid as (select id, ord, index_y, index_x,
      degrees(atan2(sin(a) + sin(b), sqrt(pow(cos(a) + cos(b) * cos(turn), 2) + pow(cos(b) * sin(turn), 2)))) as lat,
      (lon + degrees(atan2(cos(b) * sin(turn), cos(a) + cos(b) * cos(turn))) + 180 + 360) % 360 - 180 as lon from ends)"""


@query("j13_neighbour_midpoints", f"with {_MID_SQL} select id, ord, index_y, index_x, round(lat, 6) as lat, round(lon, 6) as lon from mid")
def j13(spark, sf):
    grid = cells(spark, sf)
    out = sp.neighbour_midpoints(sp.nearest_cell(places(spark, sf), grid, 0.5), grid)
    return out.withColumns({"lat": F.round("lat", 6), "lon": F.round("lon", 6)})


@query(
    "j13_box_rings",
    f"""with {_MID_SQL} select id, count(*)::int as corners, round(arg_min(lat, ord), 6) as first_lat, round(arg_max(lon, ord), 6) as last_lon
        from mid group by id""",
)
def j13_rings(spark, sf):
    grid = cells(spark, sf)
    rings = sp.box_rings(sp.neighbour_midpoints(sp.nearest_cell(places(spark, sf), grid, 0.5), grid))
    return rings.select(
        "id", F.size("ring").alias("corners"), F.round(F.element_at("ring", 1).lat, 6).alias("first_lat"),
        F.round(F.element_at("ring", -1).lon, 6).alias("last_lon"),
    )


@query(
    "j14_pixels_in_boxes",
    f"""with {_BOXES_SQL}, {_PIXELS_SQL} select id, count(*) as n, round(sum(elevation_m), 4) as total from boxes, pixels
        where x between min_lon and max_lon and y between min_lat and max_lat group by id""",
)
def j14(spark, sf):
    inside = sp.pixels_in_boxes(box_table(spark, sf), pixels(spark, sf), 0.2)
    return inside.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("elevation_m"), 4).alias("total"))


@query(
    "a7_zonal_mean",
    f"""with {_BOXES_SQL}, {_PIXELS_SQL}, means as (select id, avg(elevation_m) as e from boxes, pixels
          where x between min_lon and max_lon and y between min_lat and max_lat and elevation_m >= 0 group by id)
        select id, round(coalesce(e, -1), 6) as elevation from boxes left join means using (id)""",
)
def a7(spark, sf):
    out = sp.zonal_mean(box_table(spark, sf), pixels(spark, sf), 0.04)
    return out.withColumn("elevation", F.round("elevation", 6))


@query(
    "j15_point_elevation",
    f"""with {_BOXES_SQL}, cached as (select c_custkey as id from customer where c_mktsegment = 'BUILDING'), {_PIXELS_SQL}, per_file as (select id, file, avg(elevation_m) as e from boxes, pixels
          where x between min_lon and max_lon and y between min_lat and max_lat and elevation_m >= 0 and id not in (select id from cached) group by id, file),
        first_file as (select id, arg_min(e, file) as e, min(file) as file from per_file group by id)
        select id, round(e, 6) as elevation, file from first_file
        union all select id, id * 1.5::double, 'cached' from cached""",
)
def j15(spark, sf):
    points = places(spark, sf)
    cache = v.table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("id"), (F.col("c_custkey") * F.lit(1.5)).alias("elevation"), F.lit("cached").alias("file")
    )
    found, _ = sp.point_elevation(points, cache, box_table(spark, sf), pixels(spark, sf), 0.04)
    return found.withColumn("elevation", F.round("elevation", 6))


_COVERED_SQL = f"""{_BOXES_SQL}, {_PIXELS_SQL}, covered as (select distinct id from boxes, pixels
          where x between min_lon and max_lon and y between min_lat and max_lat and elevation_m >= 2)"""


@query("j15_uncovered_points", f"with {_COVERED_SQL} select id, lat, lon from places where id not in (select id from covered)")
def j15_rejects(spark, sf):
    none = spark.createDataFrame([], "id bigint, elevation double, file string")
    # A sparser raster, so that some points lie in no file.
    sparse = pixels(spark, sf).filter("elevation_m >= 2")
    _, rejects = sp.point_elevation(places(spark, sf), none, box_table(spark, sf), sparse, 0.04)
    return rejects


@query(
    "j14_boxes_of_all_sizes",
    f"""with {_PLACES_SQL}, {_PIXELS_SQL},
        wide as (select id, lat - 0.02 * (id % 400) as min_lat, lat + 0.05 as max_lat, lon - 0.06 as min_lon, lon + 0.03 * (id % 300) as max_lon from places),
        s as (select id, count(*) as n, round(sum(elevation_m), 2) as total from wide, pixels
              where x between min_lon and max_lon and y between min_lat and max_lat and elevation_m >= 0 group by id)
        select * from s""",
)
def j14_sizes(spark, sf):
    k = F.col("id")
    wide = places(spark, sf).select(
        "id", (F.col("lat") - F.lit(0.02) * (k % 400)).alias("min_lat"), (F.col("lat") + 0.05).alias("max_lat"),
        (F.col("lon") - 0.06).alias("min_lon"), (F.col("lon") + F.lit(0.03) * (k % 300)).alias("max_lon"),
    )
    return sp.box_sums(wide, pixels(spark, sf), 0.04).select("id", "n", F.round("total", 2).alias("total"))


@query(
    "r5_raster_pixels",
    """select 'v' || (vec_id % 3) as file, round(-114 + (i - 1) % 8 * 0.01::double + 0.005::double, 6) as x,
              round(48 - (vec_id * 8 + (i - 1) // 8) * 0.02::double - 0.01::double, 6) as y, embedding[i]::double as elevation_m
       from embeddings, (select unnest(generate_series(1, 64)) as i)""",
)
def r5(spark, sf):
    strip = F.transform(
        F.sequence(F.lit(0), F.lit(7)), lambda r: F.slice(F.col("embedding").cast("array<double>"), r * 8 + 1, F.lit(8))
    )
    rasters = v.table(spark, sf, "embeddings").select(
        F.concat(F.lit("v"), (F.col("vec_id") % 3).cast("string")).alias("file"), F.lit(-114.0).alias("x0"),
        F.lit(48.0).alias("y0"), F.lit(0.01).alias("dx"), F.lit(-0.02).alias("dy"),
        (F.col("vec_id") * 8).alias("row0"), strip.alias("strip"),
    )
    return sp.raster_pixels(rasters).withColumns({"x": F.round("x", 6), "y": F.round("y", 6)})
