from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ridgeline.operators import aggregate as agg
from ridgeline.operators import checks as ck
from ridgeline.operators import combine as cb
from ridgeline.operators import metrics as m
from ridgeline.operators import ranking as rk

H = timedelta(hours=1)


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def profile(spark, first_utc, n, value=1.0):
    data = [(1, 0.0, 0.0, 100.0, first_utc + i * H, value) for i in range(n)]
    return spark.createDataFrame(data, "id int, slope_angle double, slope_azi double, altitude double, timestamp timestamp_ntz, TA double")


@pytest.mark.parametrize(
    "first, day, hours",
    [
        # Hours from well before to well after the clock change, in UTC.
        (datetime(2025, 3, 7), date(2025, 3, 9), 23),
        (datetime(2025, 10, 31), date(2025, 11, 2), 25),
        (datetime(2025, 1, 5), date(2025, 1, 7), 24),
    ],
)
def test_shifted_day_has_the_hours_of_the_clock(spark, first, day, hours):
    rows = profile(spark, first, 96).withColumn("n", F.lit(1.0))
    days = rows.withColumn("date", agg.shifted_day(F.col("timestamp"))).groupBy("date").count()
    assert {r.date: r["count"] for r in days.collect()}[day] == hours


def test_mean_skips_sentinel_and_empty_days(spark):
    rows = profile(spark, datetime(2025, 1, 5, 2), 2, 4.0).unionByName(profile(spark, datetime(2025, 1, 5, 4), 1, -999.0))
    rows = rows.unionByName(profile(spark, datetime(2025, 1, 9, 2), 1, -999.0))
    got = rows_of(agg.shifted_day_mean(rows), "date", "TA", "altitude")
    assert got == [(date(2025, 1, 5), 4.0, 100.0), (date(2025, 1, 9), None, 100.0)]


def test_mode_ties_go_up(spark):
    df = spark.createDataFrame([("a", v) for v in (1, 1, 2, 2, 3)] + [("b", None), ("c", 3), ("c", None), ("c", None)], "k string, v int")
    assert rows_of(agg.mode_highest(df, ["k"], "v")) == [("a", 2), ("b", None), ("c", 3)]


def test_zone_day_relabels_before_the_mode(spark):
    d = date(2025, 1, 1)
    df = spark.createDataFrame(
        [(d, "Swan", "upper", 38.0, 3), (d, "Swan", "upper", 30.0, 3), (d, "Swan", "upper", 30.0, 2), (d, "Swan", "upper", 0.0, 1)],
        "date date, zone_name string, elevation_band string, slope_angle double, predicted_danger int",
    )
    got = rows_of(agg.zone_day_levels(df), "slope_angle", "predicted_danger")
    assert got == [("flat", 1), ("slope", 3)]


def test_daily_weather(spark):
    d = date(2026, 2, 25)
    df = spark.createDataFrame(
        [(d, "Swan", "upper", 38.0, 90.0, -5.0, 10.0, 100.0, 2, 1.5), (d, "Swan", "upper", 38.0, 90.0, -4.0, 20.0, 14.0, 2, 0.5)],
        "date date, zone_name string, elevation_band string, slope_angle double, slope_azi double, "
        "TA double, VW double, ISWR double, predicted_danger int, hoar_size double",
    )
    row = agg.daily_weather(df).first().asDict()
    assert row["temp_avg"] == 23.9 and row["wind_avg"] == 33.6 and row["solar_in"] == 114.0
    assert row["hoar_size_max"] == 1.5 and row["danger_level"] == 2 and row["date_epoch"] == 1772002800
    assert "rh_avg" not in row


def test_reshape_round_trip(spark):
    wide = spark.createDataFrame([("Swan", 1, 2, 3), ("Whitefish", 4, None, 1)], "zone_name string, upper int, middle int, lower int")
    long = agg.wide_to_long(wide, ["zone_name"], ["upper", "middle", "lower"])
    assert long.count() == 6
    back = agg.long_to_wide(long, ["zone_name"], "elevation_band", "actual_danger", ["upper", "middle", "lower"])
    assert rows_of(back) == rows_of(wide)
    hot = agg.one_hot(wide.select("zone_name"), {"zone_name": ["Swan", "Whitefish"]})
    assert rows_of(hot) == [(0, 1), (1, 0)]


def test_shares_and_accuracy(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("b", 2, 2), ("a", 2, 2)], "k string, actual int, predicted int")
    assert rows_of(agg.value_shares(df, "actual")) == [(1, 2, 0.5), (2, 2, 0.5)]
    assert rows_of(agg.value_shares(df, "actual", ["k"]), "k", "actual", "share") == [
        ("a", 1, pytest.approx(2 / 3)), ("a", 2, pytest.approx(1 / 3)), ("b", 2, 1.0)
    ]
    assert rows_of(agg.group_accuracy(df, ["k"], "actual", "predicted"), "k", "accuracy") == [("a", pytest.approx(2 / 3)), ("b", 1.0)]


def test_accuracy_table_has_null_for_empty_cells(spark):
    df = spark.createDataFrame(
        [("Swan", "upper", 1, 1), ("Swan", "lower", 1, 2), ("Whitefish", "lower", 1, 1)],
        "zone_name string, elevation_band string, actual_danger int, predicted_danger int",
    )
    got = [tuple(r) for r in agg.accuracy_table(df, ["Swan", "Whitefish"]).collect()]
    assert got == [("lower", 0.0, 1.0), ("upper", 1.0, None)]
    full = cb.complete_bands(df.select("zone_name", "elevation_band").distinct().withColumn("n", F.lit(1)))
    assert full.count() == 6 and full.filter("n is null").count() == 3


def test_scores(spark):
    df = spark.createDataFrame(list(zip((1, 1, 2, 3), (1, 2, 2, 2))), "actual int, predicted int")
    assert tuple(m.evaluate(df).first()) == (0.5, 0.5, 0.5)
    extra = spark.createDataFrame([(1, 1), (1, 4)], "actual int, predicted int")
    assert tuple(m.evaluate(extra).first()) == (0.5, 0.5, 1.5)
    pairs = m.pair_counts(extra)
    matrix = [tuple(r) for r in m.confusion_matrix(pairs, normalise=True).select("actual", "predicted", "n", "share").collect()]
    assert matrix == [(4, 1, 0, 0.0), (4, 4, 0, 0.0), (1, 1, 1, 0.5), (1, 4, 1, 0.5)]
    assert tuple(m.evaluate(df.limit(0)).first()) == (None, None, None)
    assert m.confusion_matrix(pairs).agg(F.sum("n")).first()[0] == extra.count()


def test_class_report(spark):
    df = spark.createDataFrame(list(zip((1, 1, 2, 3), (1, 2, 2, 2))), "actual int, predicted int")
    got = {r.level: (r.precision, r.recall, r.support) for r in m.class_report(m.pair_counts(df)).collect()}
    assert got == {1: (1.0, 0.5, 2), 2: (pytest.approx(1 / 3), 1.0, 1), 3: (0.0, 0.0, 1)}


def test_weights_and_thresholds(spark):
    df = spark.createDataFrame([(1, 1)] * 3 + [(2, 1)], "actual int, predicted int")
    assert rows_of(m.class_weights(df, "actual", {2: 10}), "actual", "weight") == [(1, pytest.approx(2 / 3)), (2, 20.0)]
    got = rows_of(m.threshold_scores(df, thresholds=[1, 2]), "threshold", "accuracy", "balanced_accuracy")
    assert got == [(1, 0.75, 0.5), (2, 1.0, 1.0)]
    assert tuple(m.constant_baseline(df, "actual", 1).first()) == (0.75, 0.5, 0.25)


def test_latest_and_recent_levels(spark):
    def d(n):
        return date(2025, 3, n)

    rows = [(d(12), "Swan", "lower", 2), (d(11), "Swan", "upper", 3), (d(11), "Swan", "middle", 1), (d(10), "Swan", "middle", 4),
            (d(9), "Swan", "lower", 1), (d(7), "Swan", "upper", 2), (d(6), "Swan", "upper", 1), (d(11), "Whitefish", "lower", 1)]
    report = spark.createDataFrame(rows, "date date, zone_name string, elevation_band string, predicted_danger int")
    assert rows_of(rk.latest_levels(report).filter("zone_name = 'Swan'"), "elevation_band", "predicted_danger") == [
        ("lower", 2), ("middle", -1), ("upper", -1)
    ]
    # Across the clock change of March 9: days are matched by date.
    assert rows_of(rk.recent_levels(report), "date", "predicted_danger") == [(d(7), 2), (d(10), 4), (d(11), 3)]


def test_samples_are_stable_and_whole(spark):
    df = spark.range(1000).withColumn("c", F.when(F.col("id") < 900, 1).otherwise(F.col("id") % 3 + 2)).repartition(7)
    sizes = rk.stratified_sample(df, "c", 40, ["id"], slices=8).groupBy("c").count()
    assert sorted(n for _, n in rows_of(sizes)) == [33, 33, 34, 40]
    a = rows_of(rk.stratified_sample(df, "c", 40, ["id"]), "id")
    assert a == rows_of(rk.stratified_sample(df.repartition(3), "c", 40, ["id"], slices=5), "id")
    assert rows_of(rk.random_rows(df, 30, ["id"])) == rows_of(rk.random_rows(df.repartition(2), 30, ["id"]))
    train, test = rk.hash_split(df, ["id"])
    assert train.count() + test.count() == 1000 and 230 < test.count() < 370
    assert train.join(test, "id").count() == 0


def test_season_folds(spark):
    days = ["2021-09-30", "2021-10-01", "2022-05-01", "2022-05-02", "2022-12-31", "2023-01-01"]
    df = spark.createDataFrame([(date.fromisoformat(x),) for x in days], "date date")
    folds = rk.season_folds(df)
    assert rows_of(folds, "season") == [(2021,), (2021,), (2022,), (2022,)]
    train, test = rk.hold_out(folds, 2021)
    assert (train.count(), test.count()) == (2, 2)


def test_merge_groups(spark):
    keys = "valid_time int, time int, step int, point_id int"
    a1 = spark.createDataFrame([(1, 1, 1, 1, 5.0)], f"{keys}, t double")
    a2 = spark.createDataFrame([(2, 2, 1, 1, 6.0)], f"{keys}, t double")
    b = spark.createDataFrame([(1, 1, 1, 1, 7.0, 1)] * 3 + [(3, 3, 1, 1, 9.0, 1)], f"{keys}, r2 double, level int")
    c = spark.createDataFrame([(1, 1, 1, 1, 8.0, 2)], f"{keys}, si10 double, level int")
    got = cb.merge_groups([[a1, a2], b, c])
    assert got.count() == 3 and {"level_1", "level_2"} <= set(got.columns)
    assert rows_of(got.filter("time = 1"), "t", "r2", "si10") == [(5.0, 7.0, 8.0)]


def test_checks(spark, hourly_of):
    rows = hourly_of([(1, "2025-01-01 00:00", 1.0), (1, "2025-01-01 01:00", None)])
    with pytest.raises(KeyError, match="point_id"):
        ck.require_columns(rows.drop("point_id"))
    with pytest.raises(ValueError, match="empty"):
        ck.require_columns(rows.limit(0))
    good, bad = ck.split_incomplete(rows, ["point_id", "t", "sde"])
    assert good.count() == 0 and sorted(r.missing for r in bad.collect()) == ["sde", "t,sde"]
    report = rows_of(ck.null_report(rows, ["t", "sde"]))
    assert report == [("sde", False, 2), ("t", True, 1)]
    marked = spark.createDataFrame([(-999.0, -999.0, 1.0), (-999.0, None, -999.0)], "a double, b double, c double")
    assert ck.drop_all_sentinel(marked).columns == ["b", "c"]
    assert [r.c for r in ck.nulls_for_sentinel(marked.select("c")).collect()] == [1.0, None]
    ok, rejected = ck.split_intervals(spark.createDataFrame([(1, 2), (2, 1), (None, 1)], "start int, end int"))
    assert ok.count() == 1 and sorted(r.reason for r in rejected.collect()) == ["not a time", "start after end"]
    features, keys = ck.split_columns(rows, ["point_id", "time"], label="fxx")
    assert features == ["t", "valid_time"] and set(keys) == {"point_id", "time", "fxx"}


def test_pick_variables(spark):
    long = spark.createDataFrame(
        [(1, ":TMP:surface", 1.0), (1, ":TMP:500 mb", 2.0), (1, ":RH:2 m above ground", 3.0)], "k int, variable string, value double"
    )
    got = ck.pick_variables(long, [":TMP:surface", ":RH:2 m above ground", ":TMP:500 mb"], ["k"]).first()
    assert tuple(got) == (1, 1.0, 3.0, None)


def test_samples_are_cut_before_the_shuffle(spark, monkeypatch):
    from ridgeline.operators import ranking as rk

    rows = spark.range(5000).selectExpr("id", "if(id % 10 < 8, 1, 2) as level")
    small = rk.stratified_sample(rows, "level", 20, ["id"])
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    monkeypatch.setattr(rk, "_GROUP_LIMIT", 1)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, rk.stratified_sample(rows, "level", 20, ["id"]).collect()))
