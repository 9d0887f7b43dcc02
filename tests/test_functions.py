import pytest
from stamps import at
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridgeline import functions as fn
from ridgeline.schemas import FEET_PER_METRE


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_band_edges(spark):
    edges = [0.0, 5000 / FEET_PER_METRE, 6500 / FEET_PER_METRE, 13000 / FEET_PER_METRE, -1.0, None]
    df = spark.createDataFrame([(i, e) for i, e in enumerate(edges)], "i int, a double")
    got = [r[0] for r in df.orderBy("i").select(fn.elevation_band(F.col("a"))).collect()]
    assert got == ["lower", "middle", "upper", None, None, None]


def test_band_strict_names_the_value(spark):
    with pytest.raises(Exception, match="lies in no elevation band"):
        spark.range(1).select(fn.elevation_band(F.lit(9999.0), strict=True)).collect()


def test_aspects(spark):
    degrees = [-45.0, 0.0, 44.9, 45.0, 135.0, 225.0, 315.0, 720.0, -90.0]
    assert list(one(spark, *[fn.aspect(F.lit(d)) for d in degrees])) == ["N", "N", "N", "E", "S", "W", "N", "N", "W"]


def test_round_even(spark):
    assert one(spark, *[fn.round_even(F.lit(x), 1) for x in (0.25, 0.35, 0.45)]) == (0.2, 0.4, 0.4)


def test_local_midnight_epoch_and_back(spark):
    days = ["2026-02-25", "2025-07-01", "2025-03-09", "2025-11-02"]
    got = one(spark, *[fn.local_midnight_epoch(F.lit(d).cast("date")) for d in days])
    assert got == (1772002800, 1751349600, 1741503600, 1762063200)
    assert one(spark, fn.epoch_to_date(F.lit(1772002800))) == ("2/25/2026",)


def test_epoch_does_not_depend_on_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert one(spark, fn.local_midnight_epoch(F.lit("2026-02-25").cast("date"))) == (1772002800,)
        stamp = F.lit("2026-02-25 13:45:10.5").cast("timestamp_ntz")
        assert one(spark, fn.hour_stamp(stamp), fn.shifted_day(stamp))[0] == at("2026-02-25 13:00:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_local_clock_is_the_same_in_every_session(spark):
    stamps = [f"2025-{d} {h:02d}:30:00" for d in ("03-09", "11-02", "07-01") for h in range(0, 24, 1)]
    df = spark.createDataFrame([(s,) for s in stamps], "s string").selectExpr("cast(s as timestamp_ntz) as ts")
    fast = [r[0] for r in df.select(fn.to_local(F.col("ts"))).collect()]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(s,) for s in stamps], "s string").selectExpr("cast(s as timestamp_ntz) as ts")
        assert [r[0] for r in df.select(fn.to_local(F.col("ts"))).collect()] == fast
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_day_edges(spark):
    # 18:59 and 19:00 mountain standard time
    stamps = ["2025-01-11 01:59:00", "2025-01-11 02:00:00"]
    got = one(spark, *[fn.shifted_day(F.lit(s).cast("timestamp_ntz")).cast("string") for s in stamps])
    assert got == ("2025-01-10", "2025-01-11")


def test_forecast_run(spark):
    midnight, five = F.lit("2025-01-11 00:00:00").cast("timestamp_ntz"), F.lit("2025-01-11 05:00:00").cast("timestamp_ntz")
    assert one(spark, fn.forecast_run_date(midnight), fn.forecast_lead(midnight)) == (at("2025-01-10"), 24)
    assert one(spark, fn.forecast_run_date(five), fn.forecast_lead(five)) == (at("2025-01-11"), 5)


def test_season(spark):
    days = ["2025-02-01", "2025-09-30", "2025-10-01"]
    assert one(spark, *[fn.season_of(F.lit(d).cast("date")) for d in days]) == (2024, 2024, 2025)


def test_zone_names(spark):
    got = one(spark, fn.zone_name(F.lit(" Swan Range ")), fn.zone_name(F.lit("nowhere"), strict=False))
    assert got == ("Swan", None)
    with pytest.raises(Exception, match="unknown zone: nowhere"):
        spark.range(1).select(fn.zone_name(F.lit("nowhere"))).collect()
    assert one(spark, fn.training_zone(F.lit("Glacier/Flathead"))) == ("flathead",)


def test_labels(spark):
    got = one(spark, fn.label_band(F.lit("Mid-Elevation (5000ft)")), fn.label_band(F.lit("Low Elevation")),
              fn.label_band(F.lit("Upper Elevation")), fn.label_level(F.lit("3 - Considerable")), fn.label_level(F.lit("No Rating")))
    assert got == ("middle", "lower", "upper", 3, None)


def test_levels(spark):
    got = one(spark, fn.level_name(F.lit(3)), fn.level_name(F.lit(9)), fn.level_code(F.lit(-1)), fn.level_colour(F.lit(0)),
              fn.clip_level(F.lit(4)), fn.clip_level(F.lit(2)), fn.slope_label(F.lit(0.0)), fn.slope_label(F.lit(38.0)))
    assert got == ("Considerable", "Unknown", "unknown", "green", 3, 2, "flat", "slope")


def test_most_likely_class_takes_the_first(spark):
    assert one(spark, fn.most_likely_class(F.array(F.lit(0.2), F.lit(0.4), F.lit(0.4)), first=1)) == (2,)


def test_wind(spark):
    got = one(spark, fn.wind_direction(F.lit(0.0), F.lit(-5.0)), fn.wind_direction(F.lit(-5.0), F.lit(0.0)),
              fn.wind_speed(F.lit(3.0), F.lit(4.0)))
    assert got == pytest.approx((0.0, 90.0, 5.0))


def test_mixed_formats(spark):
    texts = ["2025-01-02 03:00:00", "2025-01-02T03:00:00", "01/02/2025 03:00:00", "2025-01-02", "noise"]
    got = one(spark, *[fn.parse_stamp(F.lit(t)) for t in texts])
    assert got == (at("2025-01-02 03:00"),) * 3 + (at("2025-01-02"), None)


def test_number_text(spark):
    assert one(spark, fn.as_percent(F.lit(0.47529)), fn.fixed_decimals(F.lit(24.06), 1)) == ("47.53%", "24.1")


@settings(max_examples=15, deadline=None)
@given(st.floats(-80, 80), st.floats(-170, 170), st.floats(-0.2, 0.2), st.floats(-0.2, 0.2))
def test_midpoint_is_half_way(spark, lat, lon, dlat, dlon):
    ends = [F.lit(x) for x in (lat, lon, lat + dlat, lon + dlon)]
    mid_lat, mid_lon = one(spark, fn.midpoint_lat(*ends), fn.midpoint_lon(*ends))
    assert mid_lat == pytest.approx(lat + dlat / 2, abs=2e-3)
    assert (mid_lon - (lon + dlon / 2) + 180) % 360 - 180 == pytest.approx(0, abs=2e-3)
