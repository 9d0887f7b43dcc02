import random
from functools import reduce

from ridgeline.operators.combine import merge_groups

KEYS = ["k", "t"]


def joined(parts):
    """Chain of full joins over distinct groups."""
    return reduce(lambda a, b: a.join(b, KEYS, "full"), [p.distinct() for p in parts])


def same(got, want):
    assert sorted(got.columns) == sorted(want.columns)
    assert got.select(*want.columns).exceptAll(want).count() == 0 and got.count() == want.count()


def frames(spark, several):
    rng = random.Random(several)
    out = []
    for name, kind in (("a", "double"), ("b", "string"), ("c", "int")):
        rows = []
        for _ in range(120):
            k, t = rng.choice([None, *range(12)]), rng.choice(["x", "y", None])
            n = rng.randrange(4) if several else hash((k, t)) % 3
            value = None if n == 2 else {"double": float(n) if n else float("nan"), "string": f"v{n}", "int": n}[kind]
            rows.append((k, t, value))
        out.append(spark.createDataFrame(rows, f"k int, t string, {name} {kind}"))
    return out


def test_merge_beside_full_joins(spark):
    for several in (0, 1, 2):
        parts = frames(spark, several)
        same(merge_groups(parts, KEYS), joined(parts))


def test_one_shuffle_whatever_the_number_of_groups(spark, monkeypatch):
    from ridgeline.operators import combine

    plans, cut = [], combine.cut_lineage
    monkeypatch.setattr(combine, "cut_lineage", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df, name))
    parts = [spark.range(50).selectExpr("id as k", "'x' as t", f"cast(id * {i} as double) as v{i}") for i in range(5)]
    out = merge_groups(parts, KEYS)
    assert out.count() == 50 and plans[0].count("Exchange") == 1 and "Join" not in plans[0] and "SortAggregate" not in plans[0]


def test_parts_of_a_group_and_shared_columns(spark):
    a = spark.createDataFrame([(1, "x", 1.0)], "k int, t string, v double")
    b = [spark.createDataFrame([(1, "x", 5.0)], a.schema), spark.createDataFrame([(2, "x", 6.0), (2, "x", 6.0)], a.schema)]
    got = merge_groups([a, b], KEYS)
    assert sorted(map(tuple, got.select("k", "v_0", "v_1").collect()), key=str) == [(1, 1.0, 5.0), (2, None, 6.0)]


def test_no_rows(spark):
    a = spark.createDataFrame([], "k int, t string, v double")
    assert merge_groups([a, a.withColumnRenamed("v", "w")], KEYS).count() == 0
