"""Missing hours of a stream (T1 with P13 and G1), found with keyed state and event-time timers.

Per key the state is the hour up to which all is settled, the last hour seen, and
a 24-bit mask for each day that is still open. An hour is missing for certain once
the watermark has passed it and the key has a later one, so it is reported exactly
once; masks of settled days are dropped, and a key that pauses keeps two numbers
and the mask of its last day. A timer stands at the next hour known to be missing,
so a key wakes up for gaps and not for time that passes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timedelta
from struct import Struct

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructField, StructType, TimestampNTZType

from ridgeline.functions import hour_stamp, seconds_of
from ridgeline.schemas import SUMMER_MONTHS

_HOUR_MS = 3_600_000
_EPOCH = datetime(1970, 1, 1)
#: Day since 1970 and its mask.
_DAY = Struct("<iI")
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class HourGaps(StatefulProcessor):
    """Hours are numbers since 1970. All hours after the first and up to ``told`` are settled.

    The state of a key is one value, the masks packed as (day, mask) pairs, so a call reads
    it once and writes it once, however many days are open.
    """

    def __init__(self, keys: Sequence[str], time_col: str, off_months: Sequence[int]):
        self.row, self.off = Row(*keys, time_col), frozenset(off_months)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "told long, last long, days binary")

    def _state(self) -> tuple[int | None, int | None, dict[int, int]]:
        found = self.open.get()
        if found is None:
            return None, None, {}
        told, last, days = found
        return told, last, dict(_DAY.iter_unpack(bytes(days)))

    @staticmethod
    def _absent(days: dict[int, int], after: int, before: int) -> Iterator[int]:
        """Hours between the two, both left out, that the masks do not have."""
        hour = after + 1
        while hour < before:
            day = hour // 24
            mask = days.get(day, 0)
            for h in range(hour, min(before, day * 24 + 24)):
                if not mask >> h % 24 & 1:
                    yield h
            hour = day * 24 + 24

    def _settle(self, key: tuple, told: int, last: int, days: dict[int, int], watermark: int) -> Iterator[Row]:
        until = min(watermark // _HOUR_MS, last)
        missing = self._absent(dict(days), told, until)
        if until - 1 > told:
            days = {day: mask for day, mask in days.items() if not (told + 1) // 24 <= day < until // 24}
            told = until - 1
        self.open.update((told, last, b"".join(_DAY.pack(*pair) for pair in days.items())))
        following = next(self._absent(days, told, last), None)
        if following is not None:
            self.handle.registerTimer((following + 1) * _HOUR_MS - 1)
        for hour in missing:
            stamp = _EPOCH + timedelta(hours=hour)
            if stamp.month not in self.off:
                yield self.row(*key, stamp)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        told, last, days = self._state()
        # Before anything was settled, an earlier hour moves the beginning.
        opened = told is None or bool(days.get(told // 24, 0) >> told % 24 & 1)
        for row in rows:
            hour = row.hour_number
            if told is None or (opened and hour < told):
                told = hour
            if hour >= told:
                last = hour if last is None else max(last, hour)
                days[hour // 24] = days.get(hour // 24, 0) | 1 << hour % 24
        yield from self._settle(key, told, last, days, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._settle(key, *self._state(), timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def stream_missing_hours(
    stream: DataFrame, keys: Sequence[str] = ("point_id",), time_col: str = "time", delay: str = "2 days", off_months: Sequence[int] = SUMMER_MONTHS
) -> DataFrame:
    """G1 on a stream: hours between the first and the last stamp of a key that it lacks, once they are certain.

    An hour is certain when the watermark, ``delay`` behind the newest stamp of
    all keys, has passed it. Rows that come later than that are dropped by Spark;
    ``repair_days`` takes them in batch. Stamps inside an hour are left out. The
    query needs a state store with timers: see ``state_store``.
    """
    stamps = stream.filter(F.col(time_col) == hour_stamp(F.col(time_col))).select(
        *keys, F.col(time_col).cast("timestamp").alias("stamped_at"), F.floor(seconds_of(F.col(time_col)) / 3600).alias("hour_number")
    )
    fields = [f for f in stream.schema.fields if f.name in keys]
    out = StructType([*sorted(fields, key=lambda f: list(keys).index(f.name)), StructField(time_col, TimestampNTZType())])
    grouped = stamps.withWatermark("stamped_at", delay).groupBy(*keys)
    return grouped.transformWithState(HourGaps(keys, time_col, off_months), out, "append", "eventTime")


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in the store that timers need."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_STORE)
        else:
            spark.conf.set(_STORE, before)


def gaps_available(stream: DataFrame, path: str, checkpoint: str, **options: object) -> None:
    """Report the missing hours of all landed files to a Parquet folder, then stop; goes on from the checkpoint."""
    with state_store(stream.sparkSession):
        found = stream_missing_hours(stream, **options)
        writer = found.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
