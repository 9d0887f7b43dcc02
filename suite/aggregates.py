"""Queries for aggregates, reshaping, ranking and metrics (A, R, L, M1 to M7, M18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ridgeline.functions import elevation_band
from ridgeline.operators import aggregate as agg
from ridgeline.operators import combine as cb
from ridgeline.operators import metrics as m
from ridgeline.operators import ranking as rk
from ridgeline.plans import levels as pl
from ridgeline.session import cut_lineage
from suite import views as v
from suite.registry import query

_MEANS = ", ".join(f'round(avg("{c}"), 6) as "{c}"' for c in ["TA", "RH", "VW"])


@query(
    "a1_shifted_day_mean",
    f"select id, slope_angle, slope_azi, date, avg(altitude) as altitude, {_MEANS} from v_profile group by id, slope_angle, slope_azi, date",
    "v_profile",
)
def a1(spark, sf):
    rows = v.profile(spark, sf).select("id", "slope_angle", "slope_azi", "altitude", "timestamp", "TA", "RH", "VW")
    out = agg.shifted_day_mean(rows)
    return out.withColumns({c: F.round(c, 6) for c in ["TA", "RH", "VW"]})


@query(
    "flagship_zone_day_levels",
    f"""with daily as (select id, slope_angle, slope_azi, date, avg(altitude) as altitude, avg("HN24") as hn from v_profile group by all),
        placed as (select d.*, zone_name, {v.BAND_SQL.replace('altitude', 'd.altitude')} as elevation_band,
                          least(4, 1 + cast(floor(hn / 8) as int)) as predicted_danger from daily d join v_points p on d.id = p.id),
        counts as (select date, zone_name, elevation_band, case when slope_angle = 0 then 'flat' else 'slope' end as slope_angle,
                          predicted_danger, count(*) as n from placed where elevation_band is not null group by all)
        select date, zone_name, elevation_band, slope_angle, arg_max(predicted_danger, n * 1000 + predicted_danger) as predicted_danger
        from counts group by date, zone_name, elevation_band, slope_angle""",
    "v_profile v_points",
)
def flagship(spark, sf):
    rows = v.profile(spark, sf).select("id", "slope_angle", "slope_azi", "altitude", "timestamp", "HN24")
    daily = agg.shifted_day_mean(rows)
    level = F.least(F.lit(4), F.floor(F.col("HN24") / 8).cast("int") + 1)
    return pl.zone_levels(daily.withColumn("predicted_danger", level), v.points(spark, sf).select("id", "zone_name"))


@query(
    "a2_training_matrix",
    f"""with daily as (select id, slope_angle, slope_azi, date, avg(altitude) as altitude, {_MEANS} from v_profile group by id, slope_angle, slope_azi, date),
        placed as (select d.*, lower(p.zone_name) as zone_name, {v.BAND_SQL.replace('altitude', 'd.altitude')} as elevation_band
                   from daily d join v_points p on d.id = p.id)
        select p.*, least(3, case elevation_band when 'lower' then w.lower when 'middle' then w.middle when 'upper' then w.upper end) as danger_level
        from placed p join v_observed_wide w on p.date = w.date and p.zone_name = lower(w.zone_name)""",
    "v_profile v_points v_observed_wide",
)
def a2(spark, sf):
    rows = v.profile(spark, sf).select("id", "slope_angle", "slope_azi", "altitude", "timestamp", "TA", "RH", "VW")
    rows = rows.withColumn("HS_meas", F.lit(-999.0))
    wide = v.observed_wide(spark, sf).withColumn("zone_name", F.lower("zone_name"))
    out = pl.training_matrix(rows, v.points(spark, sf), wide, clip=3)
    return out.withColumns({c: F.round(c, 6) for c in ["TA", "RH", "VW"]})


@query("a3_zone_day_mode", "select * from v_zone_day", "v_zone_day")
def a3(spark, sf):
    return v.zone_day(spark, sf)


@query(
    "a4_daily_weather",
    """with rows_ as (select p.*, b.zone_name, b.elevation_band from v_profile p
                      join (select id, zone_name from v_points) q on p.id = q.id
                      join (select distinct id, zone_name, elevation_band from v_banded) b on p.id = b.id where slope_angle = 38),
       joined as (select r.*, z.predicted_danger from rows_ r join v_zone_day z
                  on z.date = r.date and z.zone_name = r.zone_name and z.elevation_band = r.elevation_band and z.slope_angle = 'slope')
       select date, zone_name, elevation_band, slope_angle, slope_azi,
              round_even(round(avg("TA") * 9 / 5 + 32, 9), 1) as temp_avg, round_even(round(avg("RH"), 9), 0) as rh_avg,
              round_even(round(avg("VW") * 2.23694, 9), 1) as wind_avg, round_even(round(avg("HN24") * 0.393701, 9), 1) as new_snow_24,
              round_even(round(avg("SWE") / 25.4, 9), 2) as swe_avg, round_even(max(hoar_size), 2) as hoar_size_max,
              round_even(sum("ISWR"), 0) as solar_in, max(predicted_danger) as danger_level,
              cast(epoch(((date::timestamp) at time zone 'America/Denver')) as bigint) as date_epoch
       from joined group by date, zone_name, elevation_band, slope_angle, slope_azi""",
    "v_profile v_points v_banded v_zone_day",
)
def a4(spark, sf):
    rows = v.profile(spark, sf).filter("slope_angle = 38").withColumns({
        "date": F.expr("cast(convert_timezone('UTC', 'America/Denver', timestamp) + interval 5 hours as date)"),
        "TA": F.nullif(F.col("TA"), F.lit(-999.0)),
    })
    placed = pl.banded(rows, v.points(spark, sf))
    zones = v.zone_day(spark, sf).filter("slope_angle = 'slope'")
    return agg.daily_weather(cb.with_zone_prediction(placed, zones))


@query("a5_group_size", "select point_id, fxx, count(*) as n from v_hourly group by all", "v_hourly")
def a5(spark, sf):
    return agg.group_size(v.hourly(spark, sf), ["point_id", "fxx"])


@query("a6_time_span", "select min(time) as first_time, max(time) as last_time from v_hourly", "v_hourly")
def a6(spark, sf):
    return agg.time_span(v.hourly(spark, sf))


@query(
    "a8_value_shares",
    """select quality, toxic, count(*) as n, round(count(*) / sum(count(*)) over (partition by quality), 9) as share
       from labels group by quality, toxic""",
)
def a8(spark, sf):
    out = agg.value_shares(v.table(spark, sf, "labels"), "toxic", ["quality"])
    return out.withColumn("share", F.round("share", 9))


@query("a9_distinct_zones", "select distinct zone_name from v_observed", "v_observed")
def a9(spark, sf):
    return agg.distinct_values(v.observed(spark, sf), "zone_name")


@query(
    "a10_accuracy_by_slope",
    """select slope_angle, slope_azi, round(avg(case when actual_danger = predicted_danger then 1.0 else 0 end), 9) as accuracy,
              count(*) as n from v_levels group by slope_angle, slope_azi""",
    "v_levels",
)
def a10(spark, sf):
    out = agg.group_accuracy(v.levels(spark, sf), ["slope_angle", "slope_azi"])
    return out.withColumn("accuracy", F.round("accuracy", 9))


@query(
    "a11_latest_day",
    "select cast(epoch((max(date)::timestamp) at time zone 'America/Denver') as bigint) as latest_day from v_zone_day",
    "v_zone_day",
)
def a11(spark, sf):
    return agg.latest_day(v.zone_day(spark, sf))


@query(
    "r1_wide_to_long",
    """select zone_name, date, elevation_band, actual_danger from v_observed_wide
       unpivot include nulls (actual_danger for elevation_band in (upper, middle, lower))""",
    "v_observed_wide",
)
def r1(spark, sf):
    return agg.wide_to_long(v.observed_wide(spark, sf), ["zone_name", "date"], ["upper", "middle", "lower"])


@query(
    "r2_long_to_wide",
    "select elevation_band, date, "
    + ", ".join(f"max(case when zone_name = '{z}' then actual_danger end) as \"{z}\"" for z in v.REGIONS)
    + " from v_observed group by elevation_band, date",
    "v_observed",
)
def r2(spark, sf):
    return agg.long_to_wide(v.observed(spark, sf), ["elevation_band", "date"], "zone_name", "actual_danger", v.REGIONS)


@query(
    "r3_score_pivot",
    """select l_linenumber as iter, max(case when l_returnflag = 'A' then s end) as "A",
              max(case when l_returnflag = 'N' then s end) as "N", max(case when l_returnflag = 'R' then s end) as "R"
       from (select l_linenumber, l_returnflag, max(l_quantity) as s from lineitem group by all) group by l_linenumber""",
)
def r3(spark, sf):
    scores = v.table(spark, sf, "lineitem").groupBy(F.col("l_linenumber").alias("iter"), "l_returnflag").agg(
        F.max("l_quantity").alias("s")
    )
    return agg.long_to_wide(scores, ["iter"], "l_returnflag", "s", ["A", "N", "R"])


@query(
    "r4_one_hot",
    "select date, actual_danger, zone_name, "
    + ", ".join(f"case when elevation_band = '{b}' then 1 else 0 end as elevation_band_{b}" for b in ["lower", "middle", "upper"])
    + " from v_observed",
    "v_observed",
)
def r4(spark, sf):
    rows = v.observed(spark, sf).drop("slope_angle")
    return agg.one_hot(rows, {"elevation_band": ["lower", "middle", "upper"]})


@query("l1_sorted_report", "select * from v_zone_day order by date, zone_name, elevation_band", "v_zone_day")
def l1(spark, sf):
    return rk.sorted_rows(v.zone_day(spark, sf), ["date", "zone_name", "elevation_band"])


@query("l2_top_rows", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 15")
def l2(spark, sf):
    return rk.top_rows(v.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 15)


@query(
    "l3_latest_levels",
    """with rep as (select date, zone_name, elevation_band, predicted_danger from v_zone_day where slope_angle = 'slope'),
       today as (select * from rep where date = (select max(date) from rep))
       select z.zone_name, b.elevation_band, coalesce(t.predicted_danger, -1) as predicted_danger
       from (select distinct zone_name from rep) z cross join (values ('lower'), ('middle'), ('upper')) b(elevation_band)
       left join today t on t.zone_name = z.zone_name and t.elevation_band = b.elevation_band""",
    "v_zone_day",
)
def l3(spark, sf):
    return rk.latest_levels(cut_lineage(v.zone_day(spark, sf).filter("slope_angle = 'slope'"), "zone_day"))


@query(
    "l4_recent_levels",
    """with rep as (select date, zone_name, elevation_band, predicted_danger from v_zone_day where slope_angle = 'slope'),
       day as (select max(date) as d from rep)
       select zone_name, date, coalesce(max(case when elevation_band = 'upper' then predicted_danger end),
                                        max(case when elevation_band = 'middle' then predicted_danger end)) as predicted_danger
       from rep, day where date < d and date >= d - 5 group by zone_name, date
       having coalesce(max(case when elevation_band = 'upper' then predicted_danger end),
                       max(case when elevation_band = 'middle' then predicted_danger end)) is not null""",
    "v_zone_day",
)
def l4(spark, sf):
    return rk.recent_levels(cut_lineage(v.zone_day(spark, sf).filter("slope_angle = 'slope'"), "zone_day"))


@query(
    "l5_stratified_sample",
    """select event_id, actual_danger from (
         select *, row_number() over (partition by actual_danger order by md5('42|' || event_id), event_id) as r from v_levels) where r <= 20""",
    "v_levels",
)
def l5(spark, sf):
    out = rk.stratified_sample(v.levels(spark, sf), "actual_danger", 20, ["event_id"])
    return out.select("event_id", "actual_danger")


@query(
    "l5_stratified_sample_sizes",
    "select actual_danger, least(count(*), 20) as n, least(count(*), 20) as distinct_rows from v_levels group by actual_danger",
    "v_levels",
)
def l5_sizes(spark, sf):
    out = rk.stratified_sample(v.levels(spark, sf), "actual_danger", 20, ["event_id"])
    return out.groupBy("actual_danger").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("distinct_rows")
    )


@query("l6_random_rows", "select event_id, predicted_danger from v_levels order by md5('42|' || event_id), event_id limit 80", "v_levels")
def l6(spark, sf):
    return rk.random_rows(v.levels(spark, sf).select("event_id", "predicted_danger"), 80, ["event_id"])


@query(
    "l6_hash_split",
    """select event_id, case when cast('0x' || substr(md5('42|' || event_id), 1, 8) as bigint) % 10000 < 3000 then 'test' else 'train' end as part
       from events""",
)
def l6_split(spark, sf):
    train, test = rk.hash_split(v.table(spark, sf, "events").select("event_id"), ["event_id"])
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "l7_time_split",
    """select 'train' as part, count(*) as n, sum(price) as price from v_training where date < date '1998-10-01'
       union all select 'test', count(*), sum(price) from v_training where date >= date '1998-10-01'""".replace(
        "sum(price)", "round(sum(price), 2)"
    ),
    "v_training",
)
def l7(spark, sf):
    parts = rk.time_split(v.training(spark, sf).select("date", "price"), "1998-10-01")
    sums = [
        p.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("price"), 2).alias("price")).withColumn("part", F.lit(name))
        for name, p in zip(("train", "test"), parts)
    ]
    return sums[0].unionByName(sums[1])


@query(
    "l8_season_folds",
    """select case when month(date) < 10 then year(date) - 1 else year(date) end::int as season, count(*) as n
       from v_training where month(date) >= 10 or month(date) < 5 or (month(date) = 5 and day(date) = 1) group by 1""",
    "v_training",
)
def l8(spark, sf):
    return rk.season_folds(v.training(spark, sf)).groupBy("season").agg(F.count(F.lit(1)).alias("n"))


@query(
    "l9_level_series",
    """select zone_name, date, elevation_band, o.actual_danger, z.predicted_danger from v_observed o
       full join (select * exclude slope_angle from v_zone_day where slope_angle = 'slope') z using (zone_name, date, elevation_band)
       where elevation_band = 'upper'""",
    "v_observed v_zone_day",
)
def l9(spark, sf):
    return rk.level_series(v.observed(spark, sf), v.zone_day(spark, sf), band="upper")


@query("l10_zone_rows", "select * from v_zone_day where zone_name = 'ASIA'", "v_zone_day")
def l10(spark, sf):
    return rk.zone_rows(v.zone_day(spark, sf), "ASIA")


@query(
    "l11_zone_discussion",
    """select n_name as zone_name, d.discussion from nation left join
       (select 'NATION_' || (doc_id % 60) as zone, text as discussion from documents) d on d.zone = n_name""",
)
def l11(spark, sf):
    zones = v.table(spark, sf, "nation").select(F.col("n_name").alias("zone_name"))
    texts = v.table(spark, sf, "documents").select(
        F.concat(F.lit("NATION_"), (F.col("doc_id") % 60).cast("string")).alias("zone"), F.col("text").alias("discussion")
    )
    return rk.zone_discussion(zones, texts)


_SCORES = """pairs as (select {a} as a, {p} as p, count(*) as n from {t} group by all),
    recall as (select a, sum(case when a = p then n else 0 end) / sum(n) as r from pairs group by a),
    s as (select round(sum(case when a = p then n else 0 end) / sum(n), 9) as accuracy,
                 round((select avg(r) from recall), 9) as balanced_accuracy,
                 round(sum(n * abs(a - p)) / sum(n), 9) as mae from pairs)"""


def _rounded(df):
    return df.withColumns({c: F.round(c, 9) for c, t in df.dtypes if t == "double"})


@query("m1_scores", f"with {_SCORES.format(a='quality', p='toxic', t='labels')} select * from s")
def m1(spark, sf):
    return _rounded(m.evaluate(v.table(spark, sf, "labels"), "quality", "toxic"))


@query("m1_level_scores", f"with {_SCORES.format(a='actual_danger', p='predicted_danger', t='v_both')} select * from s", "v_both")
def m1_levels(spark, sf):
    both = cb.actual_and_predicted(v.observed(spark, sf), v.zone_day(spark, sf))
    return _rounded(m.evaluate(both, "actual_danger", "predicted_danger"))


_MATRIX = """pairs as (select actual_danger as actual, predicted_danger as predicted, count(*) as n from v_levels group by all),
    axis as (select actual as l from pairs union select predicted from pairs)"""


@query(
    "m2_confusion_matrix",
    f"""with {_MATRIX} select a.l as actual, p.l as predicted, coalesce(n, 0) as n,
        round(coalesce(n, 0) / sum(coalesce(n, 0)) over (partition by a.l), 9) as share
        from axis a cross join axis p left join pairs q on q.actual = a.l and q.predicted = p.l""",
    "v_levels",
)
def m2(spark, sf):
    pairs = m.pair_counts(v.levels(spark, sf), "actual_danger", "predicted_danger")
    return _rounded(m.confusion_matrix(pairs, normalise=True))


@query(
    "m3_class_report",
    f"""with {_MATRIX}, c as (select l, (select coalesce(sum(n), 0) from pairs where actual = l) as support,
          (select coalesce(sum(n), 0) from pairs where predicted = l) as picked,
          (select coalesce(sum(n), 0) from pairs where predicted = l and actual = l) as hits from axis)
        select l as level, round(hits / picked, 9) as precision, round(hits / support, 9) as recall,
               round(2 * hits / (picked + support), 9) as f1, support::bigint as support from c""",
    "v_levels",
)
def m3(spark, sf):
    return _rounded(m.class_report(m.pair_counts(v.levels(spark, sf), "actual_danger", "predicted_danger")))


@query(
    "m4_accuracy_table",
    "select elevation_band, "
    + ", ".join(
        f"round(avg(case when zone_name = '{z}' then case when actual_danger = predicted_danger then 1.0 else 0.0 end end), 9) as \"{z}\""
        for z in v.REGIONS
    )
    + " from v_both group by elevation_band",
    "v_both",
)
def m4(spark, sf):
    both = cb.actual_and_predicted(v.observed(spark, sf), v.zone_day(spark, sf))
    return _rounded(agg.accuracy_table(both, v.REGIONS))


@query(
    "m5_season_performance",
    f"with {_SCORES.format(a='actual_danger', p='predicted_danger', t='v_both')} select * from s",
    "v_both",
)
def m5(spark, sf):
    tables = pl.season_performance(v.observed(spark, sf), v.zone_day(spark, sf), v.REGIONS)
    return _rounded(tables["scores"])


@query(
    "m5_confusion_share",
    """with pairs as (select actual_danger as actual, predicted_danger as predicted, count(*) as n from v_both group by all),
       levels as (select actual as l from pairs union select predicted from pairs),
       grid as (select a.l as actual, p.l as predicted from levels a cross join levels p),
       whole as (select g.actual, g.predicted, coalesce(n, 0) as n from grid g left join pairs using (actual, predicted))
       select actual, predicted, round(case when sum(n) over (partition by actual) > 0 then n / sum(n) over (partition by actual) end, 9) as share from whole""",
    "v_both",
)
def m5_share(spark, sf):
    tables = pl.season_performance(v.observed(spark, sf), v.zone_day(spark, sf), v.REGIONS)
    return tables["normalised"].select("actual", "predicted", F.round("share", 9).alias("share"))


@query(
    "m5_accuracy_table",
    f"""select elevation_band, {', '.join(f"""round(avg(case when zone_name = '{z}' then (actual_danger = predicted_danger)::int end), 9) as "{z}" """ for z in v.REGIONS)}
        from v_both group by elevation_band""",
    "v_both",
)
def m5_table(spark, sf):
    table = pl.season_performance(v.observed(spark, sf), v.zone_day(spark, sf), v.REGIONS)["accuracy"]
    return table.select("elevation_band", *[F.round(z, 9).alias(z) for z in v.REGIONS])


@query(
    "a4_weather_of_day",
    """with rows_ as (select l.*, p.altitude, b.zone_name, b.elevation_band from (select id, date, 38.0 as slope_angle, slope_azi, avg("TA") as "TA", avg("VW") as "VW" from v_profile
                        where slope_angle = 38 group by id, date, slope_azi) l
                      join (select distinct id, altitude from v_profile) p on p.id = l.id
                      join (select distinct id, zone_name, elevation_band from v_banded) b on l.id = b.id)
       select r.zone_name, r.elevation_band, slope_azi, round_even(round(avg("TA") * 9 / 5 + 32, 9), 1) as temp_avg,
              round_even(round(avg("VW") * 2.23694, 9), 1) as wind_avg, max(z.predicted_danger) as danger_level
       from rows_ r join v_zone_day z on z.date = r.date and z.zone_name = r.zone_name and z.elevation_band = r.elevation_band and z.slope_angle = 'slope'
       where r.date = date '2024-01-15' group by r.zone_name, r.elevation_band, slope_azi""",
    "v_profile v_banded v_zone_day",
)
def a4_day(spark, sf):
    """The report of one day from daily point rows, as the pipeline makes it."""
    profile = v.profile(spark, sf).select("id", "slope_angle", "slope_azi", "altitude", "timestamp", F.nullif("TA", F.lit(-999.0)).alias("TA"), "VW")
    daily = agg.shifted_day_mean(profile).withColumn("predicted_danger", F.lit(0))
    out = pl.weather_of_day(daily, v.points(spark, sf).select("id", "zone_name"), v.zone_day(spark, sf), "2024-01-15")
    return out.select("zone_name", "elevation_band", "slope_azi", "temp_avg", "wind_avg", "danger_level")


@query(
    "m6_constant_baseline",
    """with f as (select case when month(date) < 10 then year(date) - 1 else year(date) end::int as season, danger_level as a
                  from v_training where month(date) >= 10 or month(date) < 5 or (month(date) = 5 and day(date) = 1)),
       recall as (select season, a, avg(case when a = 2 then 1.0 else 0.0 end) as r from f group by season, a)
       select season, round(avg(case when a = 2 then 1.0 else 0.0 end), 9) as accuracy,
              round((select avg(r) from recall x where x.season = f.season), 9) as balanced_accuracy,
              round(avg(abs(a - 2)), 9) as mae from f group by season""",
    "v_training",
)
def m6(spark, sf):
    return _rounded(m.constant_baseline(rk.season_folds(v.training(spark, sf)), "danger_level", 2, ["season"]))


@query(
    "m7_class_weights",
    """select danger_level, count(*) as n_class,
              round(sum(count(*)) over () / (count(*) over () * count(*)) * case when danger_level = 2 then 2 else 1 end, 9) as weight
       from v_training group by danger_level""",
    "v_training",
)
def m7(spark, sf):
    return _rounded(m.class_weights(v.training(spark, sf), "danger_level", {2: 2}))


_THRESH = " union all ".join(
    f"""(with b as (select case when actual_danger <= {k} then 1 else 0 end as a, case when predicted_danger <= {k} then 1 else 0 end as p from v_levels),
        recall as (select a, avg(case when a = p then 1.0 else 0.0 end) as r from b group by a)
        select {k} as threshold, round(avg(case when a = p then 1.0 else 0.0 end), 9) as accuracy,
               round((select avg(r) from recall), 9) as balanced_accuracy, round(avg(abs(a - p)), 9) as mae from b)"""
    for k in (1, 2, 3)
)


@query("m18_threshold_scores", f"select * from ({_THRESH})", "v_levels")
def m18(spark, sf):
    return _rounded(m.threshold_scores(v.levels(spark, sf), "actual_danger", "predicted_danger"))


@query(
    "f1_elevation_band",
    f"select id, {v.BAND_SQL} as elevation_band from v_points",
    "v_points",
)
def f1(spark, sf):
    return v.points(spark, sf).select("id", elevation_band(F.col("altitude")).alias("elevation_band"))
