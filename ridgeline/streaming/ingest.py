"""Hourly files into a table, without repeats.

The table is partitioned by day; a manifest lists the live folders of each day. A
batch compares its keys with the stored rows of the days it touches, opens only
their folders, and adds what is new by one commit. A batch that is run again
after a failure finds its rows there and adds none; rows that arrive very late
are still taken. Repaired days take the place of stored ones by one commit, too.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructField, StructType

from ridgeline.operators.calendar import _ntz
from ridgeline.operators.repair import repair_gaps
from ridgeline.operators.resolve import new_keys
from ridgeline.schemas import HOURLY_KEYS
from ridgeline.session import cut_lineage
from ridgeline.sources.commits import CommittedTable, committed

_DAY = "stored_day"


def day_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> CommittedTable:
    """The table at ``path``; its columns are read off a stored folder if no schema is named."""
    day = StructField(_DAY, DateType())
    if schema is None:
        folder = committed(spark, path, StructType([day]), [_DAY]).manifest().select("folder").first()
        if folder is None:
            raise ValueError(f"{path} has no rows yet: name its schema")
        schema = spark.read.parquet(f"{path}/{folder[0]}").schema
    elif isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    fields = [f for f in schema.fields if f.name != _DAY]
    return committed(spark, path, StructType([*fields, day]), [_DAY])


def dated(rows: DataFrame, time_col: str = "time") -> DataFrame:
    """Rows with the day they are stored under."""
    return rows.withColumn(_DAY, F.col(time_col).cast("date"))


def read_stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Landed files as a stream."""
    reader = spark.readStream.schema(schema).format(fmt).option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def within_delay(stream: DataFrame, keys: Sequence[str], time_col: str, delay: str = "2 days") -> DataFrame:
    """Drop repeats that follow within the delay, with bounded state.

    For sinks without a key comparison of their own. Rows later than the
    watermark are dropped by Spark, so those sinks need ``repair_days`` too.
    """
    event = F.col(time_col).cast("timestamp")
    marked = stream.withColumn("_event", event).withWatermark("_event", delay)
    return marked.dropDuplicatesWithinWatermark(list(keys)).drop("_event")


def start_ingest(
    stream: DataFrame, table: str, checkpoint: str, keys: Sequence[str] = tuple(HOURLY_KEYS), time_col: str = "time",
    available_now: bool = True,
) -> StreamingQuery:
    """Append new keys to the table; T2: the checkpoint is the resume point."""
    schema = stream.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        place = day_table(batch.sparkSession, table, schema)
        rows = dated(batch, time_col)
        place.add(new_keys(rows.dropDuplicates(list(keys)), place.rows(rows), [_DAY, *keys]))

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def ingest_available(
    stream: DataFrame, table: str, checkpoint: str, keys: Sequence[str] = tuple(HOURLY_KEYS), time_col: str = "time"
) -> None:
    """Take in all landed files, then stop."""
    start_ingest(stream, table, checkpoint, keys, time_col).awaitTermination()


def stored_rows(spark: SparkSession, table: str, schema: StructType | str | None = None) -> DataFrame:
    """Rows of the table without its bookkeeping column; with ``schema`` also of a table without data yet."""
    return day_table(spark, table, schema).rows().drop(_DAY)


def store_days(spark: SparkSession, table: str, days: DataFrame, time_col: str = "time") -> None:
    """Put whole days (as ``repair_days`` returns them) in the place of all that is stored of them.

    One commit: a reader sees the days as they were or as they are now, and a run
    that stops before it changes nothing.
    """
    rows = cut_lineage(dated(days, time_col), "repaired")
    day_table(spark, table, days.schema).replace(rows)


def compact_days(spark: SparkSession, table: str, days: DataFrame, schema: StructType | str | None = None) -> None:
    """Rewrite the named days (a column ``day``) as one folder each; their rows stay the same."""
    place = day_table(spark, table, schema)
    wanted = days.select(F.col("day").cast("date").alias(_DAY))
    place.replace(place.rows(wanted).join(wanted.distinct(), _DAY, "left_semi"), wanted)


def resume_point(table: DataFrame, time_col: str = "time") -> DataFrame:
    """Last stored stamp, from which a batch run goes on."""
    return table.agg(F.max(time_col).alias("resume_from"))


def repair_days(
    stored: DataFrame, replacements: DataFrame, keys: Sequence[str] = ("point_id", "fxx"), time_col: str = "time"
) -> DataFrame:
    """The days late rows fall in, merged with them and gap-filled.

    The neighbouring days are read as well, so that a gap at midnight can be
    filled; only the affected days are returned. A replacement wins over the
    stored row of its key. The affected days, a few dates, come to the driver,
    so the range of hours reaches the scan of the stored table.
    """
    day = F.col(time_col).cast("date")
    touched = sorted(r[0] for r in replacements.select(day.alias("d")).distinct().collect() if r[0] is not None)
    if not touched:
        return stored.limit(0)
    step = timedelta(days=1)
    around = sorted({d + i * step for d in touched for i in (-1, 0, 1)})
    in_range = (F.col(time_col) >= _ntz(around[0])) & (F.col(time_col) < _ntz(around[-1] + step))
    near = stored.filter(in_range & day.isin(around))
    old = near.join(replacements.select(*keys, time_col).distinct(), [*keys, time_col], "left_anti")
    return repair_gaps(old.unionByName(replacements), time_col, keys).filter(day.isin(touched))


def rows_after(df: DataFrame, stamp: str, time_col: str = "time") -> DataFrame:
    """Rows later than a resume point."""
    return df.filter(F.col(time_col) > _ntz(stamp))
