from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ridgeline import streaming as sm
from ridgeline.session import new_path
from ridgeline.streaming.ingest import rows_after

H = timedelta(hours=1)
START = datetime(2025, 1, 10, 22)
SCHEMA = "point_id bigint, time timestamp_ntz, t double"
KEYS = ["point_id", "time"]


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


@pytest.mark.parametrize("files_per_batch", [None, 1])
def test_ingest_takes_each_key_once(spark, files_per_batch):
    folder, table, check = (new_path(spark, n) for n in ("landing", "table", "check"))
    land(spark, folder, [(1, START + i * H, 1.0) for i in range(5)] + [(1, START, 1.0)])
    land(spark, folder, [(1, START + i * H, 1.0) for i in range(3, 8)])

    def run():
        stream = sm.read_stream(spark, folder, SCHEMA, files_per_batch=files_per_batch)
        sm.ingest_available(stream, table, check, KEYS)
        return sm.stored_rows(spark, table)

    assert sorted(r.time for r in run().collect()) == [START + i * H for i in range(8)]
    assert run().count() == 8  # nothing new
    # a row from long ago is still taken, and resuming goes on from the checkpoint
    land(spark, folder, [(1, START - 5000 * H, 9.0), (2, START, 2.0), (1, START, 1.0)])
    assert run().count() == 10
    assert sm.resume_point(run()).first()[0] == START + 7 * H
    assert rows_after(run(), "2025-01-11 00:00:00").count() == 5


def test_a_batch_run_again_replaces_its_rows(spark):
    folder, table = new_path(spark, "landing"), new_path(spark, "table")
    land(spark, folder, [(1, START, 1.0), (1, START + 3 * H, 1.0)])
    for _ in range(2):  # a lost checkpoint: batch 0 comes again
        sm.ingest_available(sm.read_stream(spark, folder, SCHEMA), table, new_path(spark, "check"), KEYS)
    assert sm.stored_rows(spark, table).count() == 2


def test_within_delay(spark):
    folder, table = new_path(spark, "landing"), new_path(spark, "table")
    land(spark, folder, [(1, START, 1.0)] * 3 + [(1, START + H, 1.0)])
    stream = sm.within_delay(sm.read_stream(spark, folder, SCHEMA), KEYS, "time")
    query = stream.writeStream.format("parquet").option("path", table).option("checkpointLocation", new_path(spark, "check"))
    query.trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(table).count() == 2


def test_late_rows_replace_and_fill(spark):
    stored = spark.createDataFrame(
        [(1, 1, START + i * H, float(i)) for i in (0, 2, 30, 60)], "point_id bigint, fxx int, time timestamp_ntz, t double"
    )
    late = spark.createDataFrame([(1, 1, START, 10.0)], stored.schema)
    got = {r.time: r.t for r in sm.repair_days(stored, late).collect()}
    # The hour between lies on the same day, the next hour on the day after.
    assert got == {START: 10.0, START + H: 6.0}
    assert sm.repair_days(stored, late.withColumn("time", F.col("time") + F.expr("interval 2 hours"))).count() == 1


def test_an_empty_first_file(spark):
    folder, table, check = (new_path(spark, n) for n in ("landing", "table", "check"))
    land(spark, folder, [])

    def run():
        sm.ingest_available(sm.read_stream(spark, folder, SCHEMA), table, check, KEYS)

    run()
    land(spark, folder, [(1, START, 1.0)])
    run()
    land(spark, folder, [(1, START, 1.0), (1, START + H, 2.0)])
    run()
    assert sorted(r.t for r in sm.stored_rows(spark, table).collect()) == [1.0, 2.0]


def test_repaired_days_replace_their_batches(spark):
    folder, table, check = (new_path(spark, n) for n in ("landing", "table", "check"))
    schema = "point_id bigint, fxx int, time timestamp_ntz, t double"
    rows = [(1, 1, START + i * H, float(i)) for i in (0, 1, 3, 4)]
    for part in (rows[:2], rows[2:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        sm.ingest_available(sm.read_stream(spark, folder, schema), table, check, ["point_id", "fxx", "time"])
    late = spark.createDataFrame([(1, 1, START + 4 * H, 40.0)], schema)
    for _ in range(2):
        sm.store_days(spark, table, sm.repair_days(sm.stored_rows(spark, table), late))
        assert sorted((r.time, r.t) for r in sm.stored_rows(spark, table).collect()) == [
            (START, 0.0), (START + H, 1.0), (START + 2 * H, 2.0), (START + 3 * H, 3.0), (START + 4 * H, 40.0)
        ]
    # what is stored as repaired is known to later batches
    sm.ingest_available(sm.read_stream(spark, folder, schema), table, check, ["point_id", "fxx", "time"])
    assert sm.stored_rows(spark, table).count() == 5


def test_days_are_replaced_and_compacted_at_once(spark, monkeypatch):
    table, schema = new_path(spark, "table"), "point_id bigint, fxx int, time timestamp_ntz, t double"
    first = spark.createDataFrame([(1, 1, START, 1.0), (1, 1, START + 5 * H, 2.0)], schema)
    sm.store_days(spark, table, first)
    place = sm.day_table(spark, table, schema)
    place.add(place.rows().limit(0).unionByName(spark.createDataFrame([(1, 1, START + H, 3.0, START.date())], place.schema)))
    assert place.manifest().count() == 3
    before = sm.stored_rows(spark, table)
    sm.compact_days(spark, table, spark.createDataFrame([(START.date(),)], "day date"))
    assert place.manifest().count() == 2
    monkeypatch.setattr(type(place), "_commit", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        sm.store_days(spark, table, first.withColumn("t", F.lit(9.0)))
    for rows in (before, sm.stored_rows(spark, table)):
        assert sorted(r.t for r in rows.collect()) == [1.0, 2.0, 3.0]


def test_missing_hours_of_a_stream(spark):
    """Gaps within a batch, across batches and days, a first stamp that moves, a pause, a key that ends."""
    folder, table, check = (new_path(spark, n) for n in ("landing", "gaps", "check"))
    day = datetime(2025, 1, 10)
    batches = [
        [(1, day + i * H) for i in (3, 4, 7)] + [(2, day + 5 * H)] + [(1, day + i * H) for i in (1, 9)] + [(3, day + 2 * H), (3, day + 4 * H)],
        [(1, day + i * H) for i in (10, 13, 30)] + [(2, day + 6 * H), (1, day + 8 * H), (4, day + 29 * H)],
        [(1, day + i * H) for i in (31, 60)] + [(2, day + 40 * H), (4, day + 28.5 * H), (2, day + 35.5 * H), (1, day + 45 * H)],
        [(2, day + i * H) for i in (100, 101)] + [(1, day + 70 * H)],
    ]
    seen = {}
    for rows in batches:
        land(spark, folder, [(p, t, 1.0) for p, t in rows])
        sm.gaps_available(sm.read_stream(spark, folder, SCHEMA), table, check, delay="12 hours", off_months=())
        for p, t in rows:
            if t.minute == 0:
                seen.setdefault(p, set()).add(t)
    cut = day + (101 - 12) * H
    want = sorted((p, t) for p, have in seen.items() for i in range(200) for t in [min(have) + i * H] if t < max(have) and t < cut and t not in have)
    assert sorted((r.point_id, r.time) for r in spark.read.parquet(table).collect()) == want
    again = [(1, day + 200 * H, 1.0)]
    land(spark, folder, again)
    sm.gaps_available(sm.read_stream(spark, folder, SCHEMA), table, check, delay="12 hours", off_months=())
    rows = spark.read.parquet(table)
    assert rows.count() == rows.distinct().count() == len(want) + len([h for h in range(71, 188)]) + len([h for h in range(89, 100)])


def test_a_call_reads_and_writes_the_state_of_a_key_once():
    """Each state call is a round trip to the executor: their number does not go with days or rows."""
    from types import SimpleNamespace

    from ridgeline.streaming.gaps import HourGaps

    calls, held, timers = [], {}, []
    value = SimpleNamespace(get=lambda: calls.append("get") or held.get("v"), update=lambda v: calls.append("update") or held.update(v=v))
    handle = SimpleNamespace(getValueState=lambda name, schema: value, registerTimer=lambda ms: calls.append("timer") or timers.append(ms))
    gaps = HourGaps(["point_id"], "time", (6,))
    gaps.init(handle)
    first = 24 * 365 * 50
    hours = [first + 5 * i for i in range(200)]
    now = lambda hour: SimpleNamespace(getCurrentWatermarkInMs=lambda: hour * 3_600_000)
    assert list(gaps.handleInputRows((7,), iter([SimpleNamespace(hour_number=h) for h in hours]), now(0))) == []
    assert sorted(calls) == ["get", "timer", "update"] and timers == [(first + 2) * 3_600_000 - 1]
    calls.clear()
    told = list(gaps.handleExpiredTimer((7,), now(first + 500), None))
    assert sorted(calls) == ["get", "timer", "update"] and timers[-1] == (first + 502) * 3_600_000 - 1
    want = [datetime(1970, 1, 1) + h * H for h in range(first, first + 500) if h not in hours]
    assert [(r.point_id, r.time) for r in told] == [(7, t) for t in want if t.month != 6]
    assert len(bytes(held["v"][2])) <= 8 * 23  # masks of settled days are gone


def test_missing_hours_beside_rows_without_a_point(spark):
    """A null point is a point of its own and takes nothing from the others."""
    folder, table, check = (new_path(spark, n) for n in ("landing", "gaps", "check"))
    day = datetime(2025, 1, 10)
    rows = [(p, day + h * H, 1.0) for p in (None, *range(1, 30)) for h in (0, 2, 5, 60)]
    land(spark, folder, rows)
    sm.gaps_available(sm.read_stream(spark, folder, SCHEMA), table, check, delay="12 hours", off_months=())
    want = [(p, day + h * H) for p in (None, *range(1, 30)) for h in (1, 3, 4, *range(6, 48))]
    found = [(r.point_id, r.time) for r in spark.read.parquet(table).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)
