"""Station text files: a header of ``key = value`` lines, then value rows.

Both directions work on lines. A file is never held as one string, so its size
does not matter. Where stations are many, files are packed: each line is led by
the name of its file and a tab, so one text holds the lines of many station files in
any order and is split at any line.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.functions import parse_stamp, season_of
from ridgeline.operators.checks import require_columns
from ridgeline.operators.repair import first_per_stamp, repair_outliers, station_units
from ridgeline.schemas import HOURLY_KEYS, PROFILE_MEASURES, SEASON_FIRST_MONTH, SENTINEL, STATION_FIELDS

_HEADER_LINE = r"^\s*([A-Za-z_]+)\s*=\s*(.*?)\s*$"
# Fixed first lines of the format.
_MARKS = ["SMET 1.1 ASCII", "[HEADER]", "[DATA]"]


def read_station_text(
    spark: SparkSession, path: str | list[str], measures: Sequence[str] = tuple(PROFILE_MEASURES), slope_digits: int = 1, packed: bool = False
) -> DataFrame:
    """Rows of many station files, keyed by the header of their file.

    Files of simulated slopes have a ``slope_angle``, and the last
    ``slope_digits`` characters of their ``station_id`` mark the slope; what
    stands before them, of any length, is the station. Other files name the
    station itself. Values that are no number are null. Repeated rows are removed. Files
    without a field list or a numeric station are an error. ``packed`` texts
    name the file of each line.
    """
    text = spark.read.text(path)
    return _parsed(_unpacked(text) if packed else _by_path(text), measures, slope_digits)


def packed_line(file: Column, line: Column) -> Column:
    """A line of a packed text. Names hold no tab and no line break."""
    return F.concat(file, F.lit("\t"), line)


def _unpacked(text: DataFrame) -> DataFrame:
    return text.withColumns({"file": F.substring_index("value", "\t", 1), "line": F.substr("value", F.instr("value", "\t") + 1)})


def _by_path(text: DataFrame) -> DataFrame:
    return text.withColumns({"file": F.col("_metadata.file_path"), "line": F.col("value")})


def read_station_folder(
    spark: SparkSession, path: str, measures: Sequence[str], stations: Sequence[int] | None = None,
    since: date | None = None, until: date | None = None, slope_digits: int = 1, buckets: int | None = None,
) -> DataFrame:
    """Rows of a folder that ``write_station_text`` wrote, of all stations or some, between two days.

    Station and season are folders, so a read of some stations or days opens
    their files only; days inside a season are cut after parsing. A folder that was
    written with ``buckets`` is read with as many: of it, the buckets of the stations are opened.
    """
    place = "station bigint" if buckets is None else "bucket int"
    text = spark.read.schema(f"value string, {place}, season int").option("basePath", path).text(path)
    if buckets is None:
        text = _by_path(text)
    else:
        text = _unpacked(text).withColumn("station", F.substring_index("file", "/", 1).try_cast("bigint"))
        if stations is not None:
            text = text.filter(F.col("bucket").isin(*_buckets_of(spark, stations, buckets)))
    if stations is not None:
        text = text.filter(F.col("station").isin(*stations))
    for day, beyond in ((since, F.col("season") >= F.lit(_season(since))), (until, F.col("season") <= F.lit(_season(until)))):
        if day is not None:
            text = text.filter(beyond)
    rows = _parsed(text, measures, slope_digits)
    if since is not None:
        rows = rows.filter(F.col("timestamp") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        rows = rows.filter(F.col("timestamp") < F.lit(until + timedelta(days=1)).cast("timestamp_ntz"))
    return rows


def _bucket(station: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(station.cast("bigint")), F.lit(buckets)).cast("int")


def _buckets_of(spark: SparkSession, stations: Sequence[int], buckets: int) -> list[int]:
    """The buckets of some stations, which the caller has listed."""
    named = spark.createDataFrame([(int(s),) for s in stations], "station bigint")
    return sorted(r[0] for r in named.select(_bucket(F.col("station"), buckets)).distinct().collect())


def _season(day: date | None) -> int | None:
    return None if day is None else day.year - (day.month < SEASON_FIRST_MONTH)


def _parsed(text: DataFrame, measures: Sequence[str], slope_digits: int) -> DataFrame:
    """Rows of lines (file, line) of station files; the header of each file is one row that its values are joined to."""
    lines = text.select("file", F.trim("line").alias("line"))
    lines = lines.filter((F.col("line") != "") & ~F.col("line").isin(*_MARKS))
    is_header = F.col("line").rlike(_HEADER_LINE)
    key = F.regexp_extract("line", _HEADER_LINE, 1)
    value = F.regexp_extract("line", _HEADER_LINE, 2)

    def entry(name: str) -> Column:
        return F.max(F.when(key == name, value))

    marked = F.when(entry("slope_angle").isNull(), F.lit(0)).otherwise(F.lit(slope_digits))
    station = F.left(entry("station_id"), F.length(entry("station_id")) - marked)
    # One row per file: only header lines reach this aggregate.
    header = lines.filter(is_header).groupBy("file").agg(
        station.try_cast("bigint").alias("id"),
        entry("altitude").try_cast("double").alias("altitude"),
        entry("slope_angle").try_cast("double").alias("slope_angle"),
        entry("slope_azi").try_cast("double").alias("slope_azi"),
        F.split(entry("fields"), r"\s+").alias("fields"),
    )
    values = lines.filter(~is_header).withColumn("values", F.split("line", r"\s+"))
    rows = values.join(header, "file", "left")
    usable = F.col("id").isNotNull() & F.col("fields").isNotNull()
    fields = F.when(usable, F.col("fields")).otherwise(
        F.raise_error(F.concat(F.lit("no station_id or fields in "), F.col("file"))).cast("array<string>")
    )

    def field(name: str) -> Column:
        place = F.array_position(fields, name).cast("int")
        return F.when(place > 0, F.get("values", place - 1))

    return rows.select(
        "id", "slope_angle", "slope_azi", "altitude",
        parse_stamp(field("timestamp")).alias("timestamp"),
        *[field(m).try_cast("double").alias(m) for m in measures],
    ).distinct()


def station_lines(
    hourly: DataFrame, points: DataFrame, source: str, created: str, fields: Mapping[str, str] = STATION_FIELDS
) -> DataFrame:
    """``station, season, ord, time, line`` of the station files to write.

    Outliers are repaired, humidity and precipitation brought to the units of
    the format, and one row kept per hour. ``points`` gives ``id, latitude,
    longitude, altitude``; rows of other stations have no header and are left
    out (``rows_without(hourly, points...)`` lists them). A file covers one station and season, so it holds at
    most one row per hour of a season, header lines in front.
    """
    require_columns(hourly, HOURLY_KEYS)
    rows = repair_outliers(hourly).drop("unrepaired")
    rows = station_units(rows) if {"r2", "prate"} <= set(rows.columns) else rows
    present = {c: f for c, f in fields.items() if c in rows.columns}
    rows = first_per_stamp(
        rows.select("point_id", "fxx", *present), F.col("fxx"), ["point_id", "time"]
    )

    def text(c: str) -> Column:
        if c == "time":
            return F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss")
        return F.coalesce(F.col(c).cast("string"), F.lit(str(int(SENTINEL))))

    known = points.select(F.col("id").alias("point_id")).distinct()
    data = rows.join(known, "point_id", "left_semi").select(
        F.col("point_id").alias("station"), season_of(F.col("time")).alias("season"),
        F.lit(100).alias("ord"), "time", F.concat_ws(" ", *[text(c) for c in present]).alias("line"),
    )
    sites = data.select("station", "season").distinct().join(points.withColumnRenamed("id", "station"), "station")
    # Header keys in the order the format lists them.
    entries: list[tuple[str, Column]] = [
        ("station_id", F.col("station").cast("string")),
        ("station_name", F.concat(F.lit("s_"), F.col("station").cast("string"))),
        ("latitude", F.col("latitude").cast("string")),
        ("longitude", F.col("longitude").cast("string")),
        ("altitude", F.col("altitude").cast("string")),
        ("epsg", F.lit("4326")),
        ("tz", F.lit("0")),
        ("nodata", F.lit(str(int(SENTINEL)))),
        ("source", F.lit(source)),
        ("creation", F.lit(created)),
        ("fields", F.lit(" ".join(present.values()))),
    ]
    head = [F.lit(_MARKS[0]), F.lit(_MARKS[1])]
    head += [F.concat(F.lit(f"{k} = "), F.coalesce(v, F.lit(str(int(SENTINEL))))) for k, v in entries]
    head.append(F.lit(_MARKS[2]))
    top = sites.select("station", "season", F.posexplode(F.array(*head)).alias("ord", "line")).withColumn(
        "time", F.lit(None).cast("timestamp_ntz")
    )
    return top.unionByName(data)


def write_station_text(lines: DataFrame, path: str, buckets: int | None = None) -> None:
    """One file per station and season, lines in order.

    Hundreds of thousands of stations would mean as many small files, which take longer to
    make, list and open than their lines. With ``buckets`` stations share as many
    folders of packed text for each season; the files inside are named
    ``station/season`` and their lines stand together and in order.
    """
    if buckets is None:
        ordered = lines.repartition("station", "season").sortWithinPartitions("station", "season", "ord", "time")
        ordered.select("station", "season", "line").write.mode("overwrite").partitionBy("station", "season").text(path)
        return
    by = ["season", "bucket"]
    ordered = lines.withColumn("bucket", _bucket(F.col("station"), buckets)).repartition(*by).sortWithinPartitions(*by, "station", "ord", "time")
    name = F.concat_ws("/", F.col("station").cast("string"), F.col("season").cast("string"))
    ordered.select(*by, packed_line(name, F.col("line")).alias("value")).write.mode("overwrite").partitionBy(*by).text(path)
