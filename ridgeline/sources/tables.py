"""Tabular files: CSV, partitioned Parquet, rejects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ridgeline.functions import season_of
from ridgeline.operators.repair import repair_outliers
from ridgeline.operators.resolve import distinct_rows
from ridgeline.schemas import HOURLY, REQUEST_LOG
from ridgeline.sources.commits import committed


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType = HOURLY) -> DataFrame:
    """CSV with a header line, typed by the declared schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_folder(
    spark: SparkSession, path: str, schema: StructType, skip_suffix: str | None = None, fmt: str = "csv"
) -> DataFrame:
    """All files of a folder as one table, without those whose stem ends in a suffix."""
    reader = spark.read.schema(schema).option("header", True).format(fmt)
    df = reader.load(path)
    if skip_suffix is None:
        return df
    stem = F.element_at(F.split(F.col("_metadata.file_name"), r"\."), 1)
    return df.filter(~stem.endswith(skip_suffix))


def append_table(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Append rows to a Parquet table; files carry their own header."""
    df.write.mode("append").partitionBy(*by).parquet(path)


def merge_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Add rows to the partitions they fall in, without repeats.

    Reads only the folders of the partitions the new rows touch and replaces
    those by one commit, so running it again changes nothing and no reader sees
    a partition twice or not at all.
    """
    committed(df.sparkSession, path, df.schema, by).merge(df)


def merged_rows(spark: SparkSession, path: str, schema: StructType | str, by: Sequence[str]) -> DataFrame:
    """The rows of a table that ``merge_partitions`` fills."""
    return committed(spark, path, schema, by).rows()


def write_seasons(
    df: DataFrame, path: str, time_col: str = "time", key: str = "point_id", buckets: int = 64, mode: str = "overwrite",
    repair: bool = True,
) -> None:
    """Split by season, point bucket and lead hour.

    Outliers are repaired first (C1), from the hours of the whole table, so an
    hour at the edge of a season has both of its sides; ``repair=False`` stores
    rows as they are. Only hours of a season, October 1 to the end of May, are
    written, without copies.

    A folder per point would mean millions of small files, so points share
    ``buckets`` folders; inside a file rows are in point order, and readers skip
    to a point by its statistics. The rebalance hint merges small buckets and
    splits one that a single point fills.
    """
    by = ["season", "bucket", "fxx"]
    in_season = ~F.month(time_col).between(6, 9)
    if repair:
        df = repair_outliers(df, time_col, [key, "fxx"]).select(*df.columns)
    placed = distinct_rows(df.filter(in_season)).withColumns({
        "season": season_of(F.col(time_col)),
        "bucket": F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"),
    })
    ordered = placed.hint("rebalance", *by).sortWithinPartitions(*by, key, time_col)
    ordered.write.mode(mode).partitionBy(*by).parquet(path)


def read_point(spark: SparkSession, path: str, point: int, key: str = "point_id", buckets: int = 64) -> DataFrame:
    """Rows of one point from ``write_seasons``: one folder per season is opened."""
    bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit(point).cast("bigint")), F.lit(buckets)).cast("int")).first()[0]
    return spark.read.parquet(path).filter((F.col("bucket") == bucket) & (F.col(key) == point))


def read_points(spark: SparkSession, path: str, points: DataFrame, key: str = "point_id", buckets: int = 64) -> DataFrame:
    """Rows of many points from ``write_seasons``: the bucket is part of the join, so their folders are opened and no others."""
    wanted = points.select(key).distinct().withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    return spark.read.parquet(path).join(wanted, ["bucket", key], "left_semi").drop("bucket")


def write_rejects(df: DataFrame, path: str, reason: str | Column) -> None:
    """Store rejected rows with a reason beside the output."""
    reason = F.lit(reason) if isinstance(reason, str) else reason
    df.withColumn("reason", reason).write.mode("append").parquet(path)


def read_request_log(spark: SparkSession, path: str) -> DataFrame:
    """The log of failed requests: logged, start, end, message."""
    return spark.read.schema(REQUEST_LOG).csv(path)


def not_yet_done(df: DataFrame, done: DataFrame, keys: Sequence[str] = ("date",)) -> DataFrame:
    """Rows whose keys are not among the finished ones."""
    return df.join(done.select(*keys).distinct(), list(keys), "left_anti")


def stored_or_new(spark: SparkSession, path: str, day: str, build, date_col: str = "date") -> DataFrame:
    """The stored rows of a day if there are any, else the built ones."""
    if _exists(spark, path):
        stored = spark.read.parquet(path).filter(F.col(date_col) == F.lit(day).cast("date"))
        if not stored.isEmpty():
            return stored
    return build()


def save_model(model: PipelineModel, path: str) -> None:
    """Store a fitted model."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Read a fitted model."""
    return PipelineModel.load(path)


def _exists(spark: SparkSession, path: str) -> bool:
    """Is there a table at the path, on whatever file system it names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
