from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from ridgeline import schemas
from ridgeline.plans import levels as pl

D = date(2025, 1, 11)


def test_from_hours_to_training_rows(spark):
    first = datetime(2025, 1, 11, 2)  # 19:00 local on the 10th
    hours = [(1, 38.0, 0.0, 1800.0, first + timedelta(hours=i), float(i), -999.0) for i in range(24)]
    profile = spark.createDataFrame(hours, "id bigint, slope_angle double, slope_azi double, altitude double, timestamp timestamp_ntz, TA double, HS_meas double")
    points = spark.createDataFrame([(1, "Glacier/Flathead")], "id bigint, zone_name string")
    observed = spark.createDataFrame([("flathead", D, 4, 4, 1)], schemas.OBSERVED_WIDE)
    row = pl.training_matrix(profile, points, observed, clip=3).collect()
    assert len(row) == 1 and "HS_meas" not in row[0].asDict()
    assert (row[0].date, row[0].TA, row[0].zone_name, row[0].elevation_band, row[0].danger_level) == (D, 11.5, "flathead", "middle", 3)
    assert pl.training_matrix(profile, points, observed).first().danger_level == 4


def test_rejects_outside_all_bands(spark):
    rows = spark.createDataFrame([(1, 100.0), (1, 9999.0), (1, None)], "id bigint, altitude double")
    points = spark.createDataFrame([(1, "Swan")], "id bigint, zone_name string")
    good, bad = pl.split_banded(rows, points)
    assert good.count() == 1 and bad.count() == 2


def test_weather_of_day_uses_the_zone_level(spark):
    predictions = spark.createDataFrame(
        [(1, D, 38.0, 90.0, 1800.0, 10.0, 1), (1, D, 0.0, 0.0, 1800.0, 99.0, 1), (1, date(2025, 1, 10), 38.0, 90.0, 1800.0, 50.0, 1)],
        "id bigint, date date, slope_angle double, slope_azi double, altitude double, TA double, predicted_danger int",
    )
    points = spark.createDataFrame([(1, "Swan")], "id bigint, zone_name string")
    zones = spark.createDataFrame([(D, "Swan", "middle", "slope", 4), (D, "Swan", "middle", "flat", 2)], schemas.ZONE_DAY)
    rows = pl.weather_of_day(predictions, points, zones, "2025-01-11").collect()
    assert len(rows) == 1 and (rows[0].temp_avg, rows[0].danger_level) == (50.0, 4)


def test_archive_update(spark):
    old = spark.createDataFrame([("swan range", D, 3, 2, 1), ("whitefish range", D, 3, 2, 1)], schemas.OBSERVED_WIDE)
    found = spark.createDataFrame(
        [("swan range", D, 3, 2, 1), ("flathead range & glacier np", D, 4, 4, None), ("swan range", date(2025, 1, 12), 1, 1, 1),
         ("swan range", date(2025, 2, 1), 1, 1, 1)], schemas.OBSERVED_WIDE)
    whole, long = pl.update_archive(old, found, date(2025, 1, 13))
    assert whole.count() == 4 and long.count() == 12
    names = {r.zone_name for r in long.select("zone_name").distinct().collect()}
    assert names == {"Swan", "Whitefish", "Glacier/Flathead"}
    again, _ = pl.update_archive(whole, found, date(2025, 1, 13))
    assert again.exceptAll(whole).count() == 0


def test_season_performance(spark):
    observed = spark.createDataFrame([(D, "Swan", b, v, "slope") for b, v in (("lower", 1), ("middle", 2), ("upper", 3))], schemas.OBSERVED_LONG)
    zones = spark.createDataFrame([(D, "Swan", b, "slope", v) for b, v in (("lower", 1), ("middle", 2), ("upper", 2))], schemas.ZONE_DAY)
    out = pl.season_performance(observed, zones, ["Swan", "Whitefish"])
    assert round(out["scores"].first().accuracy, 4) == 0.6667
    assert out["matrix"].count() == 9 and out["normalised"].agg(F.sum("share")).first()[0] == 3.0
    assert {r.elevation_band: (r.Swan, r.Whitefish) for r in out["accuracy"].collect()} == {
        "lower": (1.0, None), "middle": (1.0, None), "upper": (0.0, None)
    }
