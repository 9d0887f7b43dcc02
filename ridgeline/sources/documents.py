"""JSON and GeoJSON documents.

A document is produced as ordered lines, not as one string: the lines of a
report sort and write in parallel, and the parts of the written folder in name
order are the document. No task ever holds a whole report.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.functions import local_midnight_epoch
from ridgeline.operators.checks import require_columns
from ridgeline.schemas import DISCUSSION_JSON, ELEVATION_CACHE_JSON, LOCAL_ZONE, METRICS_JSON

_POINT = T.StructType([T.StructField("coordinates", T.ArrayType(T.DoubleType()))])
_POLYGON = T.StructType([T.StructField("coordinates", T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))])


def _features(
    spark: SparkSession, path: str, properties: T.StructType, geometry: T.StructType, one_document: bool
) -> DataFrame:
    feature = T.StructType([T.StructField("properties", properties), T.StructField("geometry", geometry)])
    schema = T.StructType([T.StructField("features", T.ArrayType(feature))])
    return spark.read.schema(schema).option("multiLine", one_document).json(path).select(F.explode("features").alias("f"))


def read_points(spark: SparkSession, path: str, one_document: bool = True) -> DataFrame:
    """S3: GeoJSON points as ``id, latitude, longitude, zone_name``.

    With ``one_document`` false every line is a collection of its own, which
    lets a large set of points be read in parallel.
    """
    properties = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()), T.StructField("zone_name", T.StringType()),
    ])
    rows = _features(spark, path, properties, _POINT, one_document)
    place = F.col("f.geometry.coordinates")
    return rows.select(
        F.col("f.properties.id").alias("id"),
        F.coalesce(F.col("f.properties.lat"), F.get(place, F.lit(1))).alias("latitude"),
        F.coalesce(F.col("f.properties.lon"), F.get(place, F.lit(0))).alias("longitude"),
        F.col("f.properties.zone_name").alias("zone_name"),
    )


def read_outlines(spark: SparkSession, path: str, one_document: bool = True) -> DataFrame:
    """GeoJSON polygons as ``zone_name`` and the outer ring of positions."""
    properties = T.StructType([T.StructField("zone_name", T.StringType())])
    rows = _features(spark, path, properties, _POLYGON, one_document)
    ring = F.transform(
        F.get(F.col("f.geometry.coordinates"), F.lit(0)),
        lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat")),
    )
    return rows.select(F.col("f.properties.zone_name").alias("zone_name"), ring.alias("ring"))


def read_elevation_cache(spark: SparkSession, path: str) -> DataFrame:
    """The id -> elevation document as a keyed table."""
    # Cut at closing braces, so a document of any size and layout is read in parts; file names hold no braces.
    text = spark.read.option("lineSep", "}").text(path)
    entry = F.regexp_extract("value", r'("[^"]+"\s*:\s*\{[^{}]*)$', 1)
    entries = text.select(entry.alias("entry")).filter("entry != ''").select(
        F.explode(F.from_json(F.concat(F.lit("{"), "entry", F.lit("}}")), ELEVATION_CACHE_JSON)).alias("id", "v")
    )
    return entries.select(F.col("id").cast("bigint").alias("id"), "v.elevation", F.col("v.tif_file").alias("file"))


def read_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row per JSON document, typed."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def parse_json(df: DataFrame, column: str, schema: str | T.StructType) -> DataFrame:
    """Fields of a JSON text column."""
    return df.withColumn("_j", F.from_json(column, schema)).select(*df.columns, "_j.*")


def split_discussions(df: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(one row per zone, documents that do not fit the schema).

    A document fits if it parses, has a date and every zone has all its texts.
    """
    parsed = df.withColumn("_j", F.from_json(column, DISCUSSION_JSON))
    texts = ["zone", "primary_concern", "discussion", "travel_advice"]

    def whole(f: Column) -> Column:
        ok = f.isNotNull()
        for name in texts:
            ok = ok & f[name].isNotNull()
        return ok

    fits = F.coalesce(
        F.col("_j.date").isNotNull() & F.forall("_j.forecasts", whole), F.lit(False)
    )
    rows = parsed.filter(fits).select(F.col("_j.date").alias("date"), F.inline("_j.forecasts"))
    return rows, parsed.filter(~fits).drop("_j")


def _array_lines(items: DataFrame, order: Sequence[str], first_key: Column) -> DataFrame:
    """Item lines of a JSON array; all but the first carry the comma in front."""
    is_first = F.struct(*order) == first_key
    line = F.concat(F.when(is_first, "  ").otherwise(" ,"), F.col("_item"))
    return items.select(F.lit(1).alias("part"), *order, line.alias("line"))


def report_lines(df: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """The zone-day report as ordered lines of one JSON document.

    Slope rows only. The array is called predictions or dangers by the level
    column present. ``latest_day`` is null for an empty report. Sort by
    ``part, date_epoch, zone_name, elevation_band`` to read it.
    """
    require_columns(df, ["date", "zone_name", "elevation_band", "slope_angle"], non_empty=False)
    level = "predicted_danger" if "predicted_danger" in df.columns else "actual_danger"
    name = "predictions" if level == "predicted_danger" else "dangers"
    order = ["date_epoch", "zone_name", "elevation_band"]
    rows = df.filter(F.col("slope_angle") == "slope").select(
        local_midnight_epoch(F.col("date"), zone).alias("date_epoch"), "zone_name", "elevation_band", F.col(level)
    )
    item = F.to_json(
        F.struct(
            F.col("date_epoch").alias("date"), F.col("zone_name").alias("zone"),
            F.col("elevation_band").alias("elevation"), F.col(level),
        ),
        {"ignoreNullFields": "false"},
    )
    first = rows.agg(F.min(F.struct(*order))).scalar()
    items = _array_lines(rows.withColumn("_item", item), order, first)
    blank = [F.lit(None).cast(t).alias(c) for c, t in zip(order, ["bigint", "string", "string"])]
    latest = rows.agg(F.coalesce(F.max("date_epoch").cast("string"), F.lit("null")).alias("latest"))
    head = latest.select(
        F.lit(0).alias("part"), *blank,
        F.concat(F.lit('{"meta":{"latest_day":'), "latest", F.lit(f'}},"{name}":[')).alias("line"),
    )
    tail = df.sparkSession.range(1).select(F.lit(2).alias("part"), *blank, F.lit("]}").alias("line"))
    return head.unionByName(items).unionByName(tail)


def weather_lines(daily: DataFrame, day: str | Column) -> DataFrame:
    """The weather rows of a day as ordered lines of one JSON document."""
    wanted = (day if isinstance(day, Column) else F.lit(day)).cast("date")
    order = ["zone_name", "elevation_band", "slope_angle", "slope_azi"]
    rows = daily.filter(F.col("date") == wanted).drop("date")
    item = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    first = rows.agg(F.min(F.struct(*order))).scalar()
    items = _array_lines(rows.withColumn("_item", item), order, first)
    blank = [F.lit(None).cast(daily.schema[c].dataType).alias(c) for c in order]
    one = daily.sparkSession.range(1)
    head = one.select(
        F.lit(0).alias("part"), *blank,
        F.concat(F.lit('{"date":'), local_midnight_epoch(wanted).cast("string"), F.lit(',"weather":[')).alias("line"),
    )
    tail = one.select(F.lit(2).alias("part"), *blank, F.lit("]}").alias("line"))
    return head.unionByName(items).unionByName(tail)


def markdown_lines(daily: DataFrame, columns: Sequence[str], order: Sequence[str], by: Sequence[str] = ("zone_name",)) -> DataFrame:
    """Rows as lines of a markdown table per zone.

    Each table starts with its heading and rule; sort by the zone, ``part`` and
    the order columns to read it.
    """
    def bar(cells: list[Column]) -> Column:
        return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))

    body = daily.select(
        *by, F.lit(2).alias("part"), *order,
        bar([F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).alias("line"),
    )
    zones = daily.select(*by).distinct()
    blank = [F.lit(None).cast(daily.schema[c].dataType).alias(c) for c in order]
    tops = [
        zones.select(*by, F.lit(i).alias("part"), *blank, bar([F.lit(x) for x in cells]).alias("line"))
        for i, cells in enumerate([list(columns), ["---"] * len(columns)])
    ]
    return tops[0].unionByName(tops[1]).unionByName(body)


def write_lines(lines: DataFrame, path: str, order: Sequence[str]) -> None:
    """Write ordered lines; nulls of the head sort first within their part."""
    lines.orderBy(*order).select("line").write.mode("overwrite").text(path)


def read_framed(spark: SparkSession, path: str, item: T.StructType) -> tuple[dict, DataFrame]:
    """A written document of lines read back: (its head, its items).

    Items are parsed by all tasks, line by line. Only the two lines of the frame
    come to the driver: one head and one end must be there, or the document is not
    whole and an error is raised. An item that does not fit fails the read.
    """
    lines = spark.read.text(path)
    is_item = F.col("value").rlike(r"^( {2}| ,)\{")
    frame = [r["value"] for r in lines.filter(~is_item).limit(3).collect()]
    heads, ends = [x for x in frame if x.endswith("[")], [x for x in frame if x == "]}"]
    if len(frame) != 2 or len(heads) != 1 or len(ends) != 1:
        raise ValueError(f"{path} is not a whole document: {len(heads)} heads, {len(ends)} ends in {len(frame)} lines outside of items")
    parsed = F.from_json(F.substring("value", 3, 1 << 30), item, {"mode": "FAILFAST"}).alias("_item")
    head = json.loads(heads[0] + "]}")
    return head, lines.filter(is_item).select(parsed).select("_item.*")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """S11 read back: date_epoch, zone_name, elevation_band, the level, and the latest day of the report."""
    spans = {"predictions": "predicted_danger", "dangers": "actual_danger"}
    text = T.StructType([T.StructField("date", T.LongType()), T.StructField("zone", T.StringType()), T.StructField("elevation", T.StringType())])
    name = spark.read.text(path).select(F.regexp_extract("value", r'"(predictions|dangers)":\[$', 1).alias("n")).filter("n <> ''").limit(1).collect()
    if not name:
        raise ValueError(f"{path} is not a whole document: it has no head")
    level = spans[name[0]["n"]]
    head, items = read_framed(spark, path, T.StructType([*text.fields, T.StructField(level, T.IntegerType())]))
    latest = F.lit(head["meta"]["latest_day"]).cast("long").alias("latest_day")
    return items.select(F.col("date").alias("date_epoch"), F.col("zone").alias("zone_name"), F.col("elevation").alias("elevation_band"), level, latest)


def read_weather(spark: SparkSession, path: str, item: T.StructType) -> DataFrame:
    """S12 read back: the rows of the document (the fields of ``item``) and its day as ``document_epoch``."""
    head, items = read_framed(spark, path, item)
    return items.withColumn("document_epoch", F.lit(head["date"]).cast("long"))


def write_metrics(scores: DataFrame, path: str) -> None:
    """One-row metrics document."""
    scores.select(*[F.col(f.name).cast(f.dataType) for f in METRICS_JSON]).coalesce(1).write.mode("overwrite").json(path)
