import json
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ridgeline import schemas
from ridgeline.operators.metrics import evaluate
from ridgeline.session import cut_lineage, new_path, shared_dir
from ridgeline.sources import documents as docs
from ridgeline.sources import pages as pg
from ridgeline.sources import station_text as st
from ridgeline.sources import tables as tb

H = timedelta(hours=1)
D = date(2026, 2, 25)


def test_shared_dir_is_kept(spark):
    assert shared_dir(spark) == shared_dir(spark)
    df = cut_lineage(spark.range(5))
    assert df.count() == 5 and "parquet" in df._jdf.queryExecution().toString().lower()


def test_csv_and_folder(spark, tmp_path):
    for name, body in [("a0.csv", "time,fxx\n2025-01-01 00:00:00,1\n"), ("a1.csv", "time,fxx\n2025-01-02 00:00:00,2\n")]:
        (tmp_path / name).write_text(body)
    schema = "time timestamp_ntz, fxx int"
    assert tb.read_csv(spark, str(tmp_path), schema).count() == 2
    kept = tb.read_folder(spark, str(tmp_path), schema, skip_suffix="1")
    assert [r.fxx for r in kept.collect()] == [1]


def test_geojson(spark, tmp_path):
    points = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"id": 7, "zone_name": "Swan"}, "geometry": {"type": "Point", "coordinates": [-113.5, 48.0]}},
        {"type": "Feature", "properties": {"id": 8, "lat": 1.0, "lon": 2.0}, "geometry": {"type": "Point", "coordinates": [2.0, 1.0]}},
    ]}
    zones = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"zone_name": "Swan"},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}]}
    (tmp_path / "p.json").write_text(json.dumps(points, indent=1))
    (tmp_path / "z.json").write_text(json.dumps(zones, indent=1))
    got = [tuple(r) for r in docs.read_points(spark, str(tmp_path / "p.json")).orderBy("id").collect()]
    assert got == [(7, 48.0, -113.5, "Swan"), (8, 1.0, 2.0, None)]
    ring = docs.read_outlines(spark, str(tmp_path / "z.json")).first()
    assert ring.zone_name == "Swan" and [(p.lon, p.lat) for p in ring.ring][2] == (1.0, 1.0)


def test_elevation_cache(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"159": {"elevation": 1337.9, "tif_file": "a.tif"}, "105": {"elevation": 2.0, "tif_file": "b"}}, indent=2))
    got = [tuple(r) for r in docs.read_elevation_cache(spark, str(tmp_path / "c.json")).orderBy("id").collect()]
    assert got == [(105, 2.0, "b"), (159, 1337.9, "a.tif")]


def report(spark, rows):
    return spark.createDataFrame(rows, schemas.ZONE_DAY)


def read_lines(lines, *order):
    return "\n".join(r.line for r in lines.orderBy("part", *order).collect())


def test_report_document(spark):
    rows = [(D, "Swan", "upper", "slope", 3), (D, "Swan", "lower", "slope", 1), (D, "Swan", "lower", "flat", 4),
            (date(2026, 2, 24), 'Gla"cier', "upper", "slope", None)]
    doc = json.loads(read_lines(docs.report_lines(report(spark, rows)), "date_epoch", "zone_name", "elevation_band"))
    assert doc["meta"] == {"latest_day": 1772002800}
    assert doc["predictions"] == [
        {"date": 1771916400, "zone": 'Gla"cier', "elevation": "upper", "predicted_danger": None},
        {"date": 1772002800, "zone": "Swan", "elevation": "lower", "predicted_danger": 1},
        {"date": 1772002800, "zone": "Swan", "elevation": "upper", "predicted_danger": 3},
    ]
    empty = json.loads(read_lines(docs.report_lines(report(spark, [])), "date_epoch"))
    assert empty == {"meta": {"latest_day": None}, "predictions": []}
    observed = report(spark, rows).withColumnRenamed("predicted_danger", "actual_danger")
    assert "dangers" in json.loads(read_lines(docs.report_lines(observed), "date_epoch", "zone_name", "elevation_band"))
    with pytest.raises(KeyError, match="slope_angle"):
        docs.report_lines(report(spark, rows).drop("slope_angle"))


def test_report_written_and_read(spark):
    path = new_path(spark, "report")
    lines = docs.report_lines(report(spark, [(D, "Swan", "upper", "slope", 3), (D, "Swan", "lower", "slope", 1)]))
    docs.write_lines(lines, path, ["part", "date_epoch", "zone_name", "elevation_band"])
    text = "".join(open(os.path.join(path, f)).read() for f in sorted(os.listdir(path)) if f.startswith("part-"))
    assert [p["predicted_danger"] for p in json.loads(text)["predictions"]] == [1, 3]


def test_weather_document(spark):
    daily = spark.createDataFrame(
        [(D, "Swan", "upper", 38.0, 90.0, 24.1, 1772002800), (D, "Swan", "lower", 38.0, 0.0, None, 1772002800)],
        "date date, zone_name string, elevation_band string, slope_angle double, slope_azi double, temp_avg double, date_epoch bigint",
    )
    doc = json.loads(read_lines(docs.weather_lines(daily, "2026-02-25"), "zone_name", "elevation_band"))
    assert doc["date"] == 1772002800 and [r["temp_avg"] for r in doc["weather"]] == [None, 24.1]
    none = json.loads(read_lines(docs.weather_lines(daily, "2026-02-26")))
    assert none["weather"] == []


def test_markdown(spark):
    rows = spark.createDataFrame([("Swan", "upper", 1.5), ("Swan", "lower", None)], "zone_name string, elevation_band string, t double")
    text = read_lines(docs.markdown_lines(rows, ["elevation_band", "t"], ["elevation_band"]), "elevation_band")
    assert text.split("\n") == ["| elevation_band | t |", "| --- | --- |", "| lower |  |", "| upper | 1.5 |"]


def test_discussions(spark):
    whole = {"zone": "Swan", "primary_concern": "a", "discussion": "b", "travel_advice": "c"}
    texts = [json.dumps({"date": "02-25-2026", "forecasts": [whole, whole]}), "no json",
             json.dumps({"date": "02-25-2026", "forecasts": [whole, {"zone": "x"}]}), json.dumps({"forecasts": [whole]})]
    rows, rejects = docs.split_discussions(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert rows.count() == 2 and rejects.count() == 3


def test_metrics_document(spark):
    path = new_path(spark, "metrics")
    docs.write_metrics(evaluate(spark.createDataFrame([(1, 1), (2, 1)], "actual int, predicted int")), path)
    assert docs.read_document(spark, path, schemas.METRICS_JSON).first().asDict() == {
        "accuracy": 0.5, "balanced_accuracy": 0.5, "mae": 0.5
    }


def test_station_text_round_trip(spark):
    start = datetime(2025, 1, 1)
    hourly = spark.createDataFrame(
        [(105, 1, start + i * H, start + (i + 1) * H, v, 80.0, 0.001) for i, v in enumerate([1.5, 10000.0, 2.5])]
        + [(106, 1, datetime(2024, 9, 30, 23), datetime(2024, 10, 1), 4.0, 50.0, 0.0)] * 2,
        "point_id bigint, fxx int, time timestamp_ntz, valid_time timestamp_ntz, t double, r2 double, prate double",
    )
    sites = spark.createDataFrame([(105, 48.0, -113.0, 1757.7), (106, 48.1, -113.2, 900.0)],
                                  "id bigint, latitude double, longitude double, altitude double")
    lines = st.station_lines(hourly, sites, "test", "2025-02-01T00:00:00")
    text = [r.line for r in lines.filter("station = 105").orderBy("ord", "time").collect()]
    assert text[:3] == ["SMET 1.1 ASCII", "[HEADER]", "station_id = 105"] and text[12:14] == ["fields = timestamp TSG RH PINT", "[DATA]"]
    assert text[14:] == ["2025-01-01T00:00:00 1.5 0.8 3.6", "2025-01-01T01:00:00 2.0 0.8 3.6", "2025-01-01T02:00:00 2.5 0.8 3.6"]
    path = new_path(spark, "stations")
    st.write_station_text(lines, path)
    files = [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".txt")]
    assert len(files) == 2 and open(files[0]).read().startswith("SMET 1.1 ASCII\n[HEADER]\n")
    back = st.read_station_text(spark, path, ["TSG", "RH", "absent"]).orderBy("id", "timestamp").collect()
    assert [(r.id, r.altitude, r.TSG, r.absent) for r in back] == [
        (105, 1757.7, 1.5, None), (105, 1757.7, 2.0, None), (105, 1757.7, 2.5, None), (106, 900.0, 4.0, None)
    ]


def test_station_file_without_header_is_an_error(spark, tmp_path):
    (tmp_path / "bad.smet").write_text("SMET 1.1 ASCII\n[HEADER]\nstation_id = 105\n[DATA]\n2025-01-01T00:00:00 1\n")
    with pytest.raises(Exception, match="no station_id or fields"):
        st.read_station_text(spark, str(tmp_path), ["TA"]).collect()


PAGE = """<h2 class="nac-gray-700 nac-m-0 nac-h2">  Swan Range </h2>
<div class="nac-dangerToday"><div class="nac-dangerDate">Wednesday, February 25, 2026</div>
<div class="nac-elevationBlock"><div class="nac-elevationLabel">Upper Elevation</div><div class="nac-dangerLabel">3 - Considerable</div></div>
<div class="nac-elevationBlock"><div class="nac-elevationLabel">Mid-Elevation</div><div class="nac-dangerLabel"><b>2 - Moderate</b></div></div>
</div><div class="nac-dangerToday"><div class="nac-dangerDate">Thursday, February 26, 2026</div></div>"""


def test_pages(spark):
    rows = pg.read_levels(spark.createDataFrame([(PAGE,), ("<p>nothing</p>",)], "html string")).collect()
    assert tuple(rows[0][c] for c in ("zone_name", "date", "upper", "middle", "lower")) == ("swan range", D, 3, 2, None)
    assert all(v is None for v in rows[1])
    summary = pg.page_summary(spark.createDataFrame([("<title>a &amp; b</title><h1 x='1'>c<i>d</i></h1><a href='x'>y</a>",)], "html string"))
    assert tuple(summary.first()) == ("a & b", "cd", 1)


def test_cards(spark):
    cards = spark.createDataFrame([("Feb 25, 2026Swan Range forecast",), ("Feb 25, 2026Swan Range forecast",), ("Feb 24, 2026x y",), ("junk",)], "text string")
    assert [r.date for r in pg.cards_of_day(cards, "2026-02-25").collect()] == [D]


def test_writers(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k int, p string")
    path = new_path(spark, "merge")
    for _ in range(2):
        tb.merge_partitions(rows, path, ["p"])
    tb.merge_partitions(spark.createDataFrame([(3, "b"), (4, None)], "k int, p string"), path, ["p"])
    tb.merge_partitions(spark.createDataFrame([(4, None), (5, None)], "k int, p string"), path, ["p"])
    assert sorted((r.k, r.p or "") for r in tb.merged_rows(spark, path, rows.schema, ["p"]).collect()) == [(1, "a"), (2, "b"), (3, "b"), (4, ""), (5, "")]
    two = new_path(spark, "merge2")
    both = rows.withColumn("q", F.col("k"))
    for _ in range(2):
        tb.merge_partitions(both, two, ["p", "q"])
    assert tb.merged_rows(spark, two, both.schema, ["p", "q"]).count() == 2


def test_season_split_keeps_early_rows(spark, hourly_of):
    rows = hourly_of([(1, "2021-02-01 00:00", 1.0), (1, "2021-11-01 00:00", 2.0), (2, "2022-02-01 00:00", 3.0), (2, "2022-02-01 00:00", 3.0)])
    path = new_path(spark, "seasons")
    tb.write_seasons(rows, path, buckets=4)
    got = spark.read.parquet(path)
    assert sorted((r.point_id, r.season) for r in got.collect()) == [(1, 2020), (1, 2021), (2, 2021)]
    assert tb.read_point(spark, path, 2, buckets=4).count() == 1


def test_done_and_log(spark, tmp_path):
    rows = spark.createDataFrame([(date(2025, 1, n), n) for n in (1, 2, 3)], "date date, v int")
    done = rows.filter("v = 2")
    assert sorted(r.v for r in tb.not_yet_done(rows, done).collect()) == [1, 3]
    path = new_path(spark, "done")
    assert tb.stored_or_new(spark, path, "2025-01-02", lambda: rows).count() == 3
    done.write.parquet(path)
    assert tb.stored_or_new(spark, path, "2025-01-02", lambda: rows).count() == 1
    assert tb.stored_or_new(spark, path, "2025-01-03", lambda: rows).count() == 3
    (tmp_path / "log.txt").write_text("01/01/2025 00:00:00,2025-01-01 00:00:00,2025-01-01 05:00:00,oops\n")
    assert tb.read_request_log(spark, str(tmp_path / "log.txt")).first().message == "oops"


def test_seasons_hold_repaired_rows(spark, hourly_of):
    rows = hourly_of([(1, "2022-05-31 22:00", 2.0), (1, "2022-05-31 23:00", 10000.0), (1, "2022-06-01 00:00", 4.0)])
    path = new_path(spark, "seasons")
    tb.write_seasons(rows, path, buckets=2)
    # The hour after the season still repairs the last one of it.
    assert sorted(r.t for r in spark.read.parquet(path).collect()) == [2.0, 3.0]
    tb.write_seasons(rows, path, buckets=2, repair=False)
    assert sorted(r.t for r in spark.read.parquet(path).collect()) == [2.0, 10000.0]


def test_reports_read_back(spark):
    from ridgeline import schemas

    zones = ["Swan", 'odd "name"\n,{', "Whitefish"]
    rows = spark.createDataFrame([(date(2025, 1, 1 + i % 9), zones[i % 3], b, "slope", 1 + i % 4) for i in range(27) for b in ("lower", "upper")], schemas.ZONE_DAY)
    path, order = new_path(spark, "report"), ["part", "date_epoch", "zone_name", "elevation_band"]
    docs.write_lines(docs.report_lines(rows).repartition(5), path, order)
    got = docs.read_report(spark, path)
    want = rows.selectExpr("unix_timestamp(to_utc_timestamp(date, 'America/Denver')) as date_epoch", "zone_name", "elevation_band", "predicted_danger")
    assert got.drop("latest_day").exceptAll(want).count() == 0 and got.count() == want.count()
    assert {r.latest_day for r in got.collect()} == {want.agg({"date_epoch": "max"}).first()[0]}
    actual = rows.withColumnRenamed("predicted_danger", "actual_danger").limit(0)
    docs.write_lines(docs.report_lines(actual), path, order)
    empty = docs.read_report(spark, path)
    assert "actual_danger" in empty.columns and empty.count() == 0


@pytest.mark.parametrize("lines", [['{"meta":{"latest_day":1}},"predictions":[', '  {"date":1}'], ['  {"date":1}', "]}"], ["]}"], []])
def test_torn_reports_are_refused(spark, lines):
    path = new_path(spark, "torn")
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    with pytest.raises(ValueError):
        docs.read_report(spark, path)


def test_a_station_opens_its_own_files(spark, hourly_of):
    rows = hourly_of([(p, t, float(p)) for p in (1, 2, 3) for t in ("2021-02-01 00:00", "2021-11-01 00:00", "2021-11-05 07:00", "2022-11-01 00:00")], fxx=0)
    sites = spark.createDataFrame([(p, 48.0, -114.0, 1500.0) for p in (1, 2, 3)], "id bigint, latitude double, longitude double, altitude double")
    path = new_path(spark, "stations")
    st.write_station_text(st.station_lines(rows, sites, "test", "2025-01-01T00:00:00"), path)
    assert st.read_station_folder(spark, path, ["TSG"]).count() == 12
    some = st.read_station_folder(spark, path, ["TSG"], stations=[2], since=date(2021, 11, 2), until=date(2021, 11, 5))
    assert [(r.id, r.timestamp, r.TSG) for r in some.collect()] == [(2, datetime(2021, 11, 5, 7), 2.0)]
    plan = some._jdf.queryExecution().executedPlan().toString()
    filters = [line.split("PartitionFilters: [")[1].split("]")[0] for line in plan.splitlines() if "PartitionFilters: [" in line]
    assert filters and all("station" in f and "season" in f for f in filters)
    for folder in ("station=1", "station=3"):  # other stations are not even opened
        for root, _, names in os.walk(os.path.join(path, folder)):
            for name in names:
                if name.endswith(".txt"):
                    open(os.path.join(root, name), "w").write("no header here\n1 2\n")
    assert st.read_station_folder(spark, path, ["TSG"], stations=[2]).count() == 4


def _texts(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".txt")]


def test_packed_stations_are_few_files(spark, hourly_of):
    """As many files as folders, whatever the stations; some stations open their buckets only."""
    rows = hourly_of([(p, t, float(p)) for p in range(-3, 60) for t in ("2021-02-01 00:00", "2021-11-01 00:00", "2021-11-05 07:00")], fxx=0)
    sites = spark.createDataFrame([(p, 48.0, -114.0, 1500.0) for p in range(-3, 60)], "id bigint, latitude double, longitude double, altitude double")
    lines, path = st.station_lines(rows, sites, "test", "2025-01-01T00:00:00"), new_path(spark, "stations")
    st.write_station_text(lines, path, buckets=4)
    assert len(_texts(path)) <= 8
    for name in _texts(path):  # the lines of a file stand together, its header first
        own = [line.split("\t") for line in open(name).read().splitlines()]
        firsts = [file for file, line in own if line == "SMET 1.1 ASCII"]
        assert len(set(firsts)) == len(firsts) and [f for i, (f, _) in enumerate(own) if not i or own[i - 1][0] != f] == firsts
    plain = new_path(spark, "stations")
    st.write_station_text(lines, plain)
    want = {(r.id, r.timestamp, r.TSG, r.altitude) for r in st.read_station_folder(spark, plain, ["TSG"]).collect()}
    assert {(r.id, r.timestamp, r.TSG, r.altitude) for r in st.read_station_folder(spark, path, ["TSG"], buckets=4).collect()} == want
    some = st.read_station_folder(spark, path, ["TSG"], stations=[-2, 7], since=date(2021, 11, 2), buckets=4)
    assert sorted((r.id, r.timestamp) for r in some.collect()) == [(-2, datetime(2021, 11, 5, 7)), (7, datetime(2021, 11, 5, 7))]
    plan = some._jdf.queryExecution().executedPlan().toString()
    filters = [line.split("PartitionFilters: [")[1].split("]")[0] for line in plan.splitlines() if "PartitionFilters: [" in line]
    assert filters and all("bucket" in f and "season" in f for f in filters)


def test_packed_text_in_any_order(spark, tmp_path):
    head = ["SMET 1.1 ASCII", "[HEADER]", "slope_angle = 38", "slope_azi = 90", "altitude = 900", "[DATA]"]
    own = {"a b": ["station_id = 52", "fields = timestamp TA", "2025-01-01T00:00:00 1"], "c": ["station_id = 71", "fields = TA timestamp", "x\t2025-01-01T00:00:00"]}
    lines = [f"{name}\t{line}" for name, rest in own.items() for line in (*head, *rest)]
    (tmp_path / "one.txt").write_text("\n".join(sorted(lines, reverse=True)[::2]) + "\n")
    (tmp_path / "two.txt").write_text("\r\n".join(sorted(lines, reverse=True)[1::2]))
    back = st.read_station_text(spark, str(tmp_path), ["TA"], packed=True).collect()
    assert sorted((r.id, r.altitude, r.timestamp, r.TA) for r in back) == [(5, 900.0, datetime(2025, 1, 1), 1.0), (7, 900.0, datetime(2025, 1, 1), None)]
    (tmp_path / "three.txt").write_text("d\t2025-01-01T00:00:00 1\n")
    with pytest.raises(Exception, match="no station_id or fields"):
        st.read_station_text(spark, str(tmp_path), ["TA"], packed=True).collect()


def test_station_queries_write_few_files(spark, tmp_path, monkeypatch):
    """Files go with the rows, not with stations, slopes and days."""
    from suite import sources
    from suite.registry import JOBS

    events = [(i, datetime(2024, 1, 1 + i % 28, i % 24), i % 60, "view" if i % 3 else "click", i / 7, '{"k": 1}') for i in range(600)]
    spark.createDataFrame(events, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string").write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(sources, "new_path", lambda spark, name: str(tmp_path / name))
    rows = JOBS["s6_station_text"](spark, str(tmp_path)).collect()
    assert len({(r.id, r.slope_angle, r.slope_azi, r.timestamp) for r in rows}) == len(rows) == 600
    assert len(_texts(tmp_path / "stations")) <= 30
