import random

import pytest
from pyspark.sql import functions as F

from ridgeline.operators import repair
from ridgeline.operators import resolve


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    data = [(rng.randrange(60) if rng.random() < 0.9 else None, rng.choice("ab"), rng.choice([0.0, -0.0, float("nan"), 1.5, None]), rng.randrange(3)) for _ in range(300)]
    data += [(k, "z", 2.5, 1) for k in range(1000, 1400)] + [(7, "hot", 1.0, 1)] * 200
    return spark.createDataFrame(data, "k int, s string, v double, r int").repartition(5)


def test_distinct_rows(rows):
    got = resolve.distinct_rows(rows)
    assert got.exceptAll(rows.distinct()).count() == 0 and got.count() == rows.distinct().count()


def test_first_of_key(rows):
    got = resolve.first_of_key(rows, ["k", "s"], F.col("r"))
    rest = ["v", "r"]
    want = rows.groupBy("k", "s").agg(F.min(F.struct(F.col("r").alias("_r"), *rest)).alias("m")).select("k", "s", "m.v", "m.r")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_nothing_repeated_moves_no_row(spark):
    rows = spark.range(1000).selectExpr("id as k", "cast(id as string) as s", "id % 7 as r")
    for df in (resolve.first_of_key(rows, ["k"], F.col("r")), resolve.distinct_rows(rows)):
        assert "Exchange" not in plan_of(df) and df.count() == 1000


def test_few_repeated_keys_leave_the_rest_in_place(spark):
    once = spark.range(0, 100_000).selectExpr("id as k", "concat('some text of a row ', id) as s", "id % 7 as r")
    rows = once.union(once.filter("k % 1000 = 0").withColumn("r", F.lit(-1)))
    for df in (resolve.first_of_key(rows, ["k"], F.col("r")), repair.first_per_stamp(rows, "r", ["k"])):
        out = df.filter("k % 1000 = 0").agg(F.max("r")).first()[0]
        assert df.count() == 100_000 and out == -1
        plan = plan_of(df)
        # The large side meets a broadcast list; a sort is left for the rows of listed keys only.
        assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan


def test_new_keys(spark):
    stored = spark.createDataFrame([(1, None), (2, "b")], "k int, s string")
    fresh = spark.createDataFrame([(1, None, 5), (2, "c", 6), (None, "b", 7)], "k int, s string, v int")
    assert sorted(r.v for r in resolve.new_keys(fresh, stored, ["k", "s"]).collect()) == [6, 7]


def test_gap_repair_frees_only_what_it_needs(hourly_of):
    rows = hourly_of([(1, f"2025-01-10 {h:02d}:00", float(h)) for h in (0, 1, 3, 4)] + [(1, "2025-01-10 01:00", 1.0)] * 4 + [(1, "2025-01-10 03:00", 5.0)])
    got = sorted((r.time.hour, r.t) for r in repair.repair_gaps(rows).collect())
    # Copies of a row count once, two different rows of an hour are averaged.
    assert got == [(0, 0.0), (1, 1.0), (2, 2.5), (3, 3.0), (3, 5.0), (4, 4.0)]
