"""Queries for training, search and scoring (M8 to M19), with the published settings.

Levels follow two features by a rule that SQL knows (``v_rated``), with a third
feature that says nothing; so every learner has to find the rule, and each level
it gives is compared.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from ridgeline.operators.aggregate import shifted_day_mean
from ridgeline.operators.ranking import season_folds, top_rows
from ridgeline.plans import levels as pl
from ridgeline.plans import models as md
from ridgeline.session import cut_lineage, new_path
from ridgeline.sources.tables import load_model, save_model
from suite import views as v
from suite.registry import query

FEATURES = v.RATED_FEATURES
LEVEL = "danger_level"
_SEASON = "(month(date) * 100 + day(date) >= 1001 or month(date) * 100 + day(date) <= 501)"
_LEVELS = f"select id, danger_level as predicted_danger from v_rated where {_SEASON}"
#: Tree settings of the published grid, as far as a single tree has them.
TREE_GRID = {"maxDepth": md.FOREST_GRID["maxDepth"], "minInstancesPerNode": md.FOREST_GRID["minInstancesPerNode"], "impurity": ["gini", "entropy"]}
TREE_SPACE = {"maxDepth": md.BOOSTED_SPACE["maxDepth"], "minInstancesPerNode": md.BOOSTED_SPACE["minInstancesPerNode"]}


def _rows(spark, sf):
    return cut_lineage(season_folds(v.rated(spark, sf)), "rated")


def _seasons(rows):
    """All seasons of the rows, a handful."""
    return sorted(r["season"] for r in rows.select("season").distinct().collect())


def _levels(rows, estimator, boosts=None):
    model = md.fit(rows, FEATURES, LEVEL, estimator, boosts)
    return md.predict(model, rows, FEATURES).select("id", "predicted_danger")


@query("m8_forest", _LEVELS, "v_rated")
def m8(spark, sf):
    return _levels(_rows(spark, sf), md.forest())


@query("m9_decision_tree", _LEVELS, "v_rated")
def m9(spark, sf):
    return _levels(_rows(spark, sf), md.decision_tree(), {2: 2, 3: 2})


@query("m10_boosted_trees", _LEVELS, "v_rated")
def m10(spark, sf):
    return _levels(_rows(spark, sf), md.boosted_trees())


@query("m11_ordinal_forest", _LEVELS, "v_rated")
def m11(spark, sf):
    """Stored and loaded before it scores."""
    rows, path = _rows(spark, sf), new_path(spark, "ordinal")
    save_model(md.fit(rows, FEATURES, LEVEL, md.ordinal_forest()), path)
    return md.predict(load_model(path), rows, FEATURES).select("id", "predicted_danger")


@query(
    "m12_season_scores",
    f"""with s as (select distinct (year(date) - (month(date) < 10)::int)::int as season from v_rated where {_SEASON})
        select season, part, 1.0::double as accuracy, 1.0::double as balanced_accuracy, 0.0::double as mae
        from s, (values ('train'), ('test')) p(part)""",
    "v_rated",
)
def m12(spark, sf):
    rows = _rows(spark, sf)
    return md.season_scores(rows, FEATURES, LEVEL, md.decision_tree(), _seasons(rows))


@query("m12_held_out_levels", _LEVELS, "v_rated")
def m12_levels(spark, sf):
    rows = _rows(spark, sf)
    return md.held_out_levels(rows, FEATURES, LEVEL, md.decision_tree(), _seasons(rows)).select("id", "predicted_danger")


@query("m13_halving_search", _LEVELS, "v_rated")
def m13(spark, sf):
    """The held-out levels of the selected candidate."""
    rows = _rows(spark, sf)
    found = md.halving_search(rows, FEATURES, LEVEL, md.decision_tree, TREE_GRID, _seasons(rows), ["id"])
    return _levels(rows, md.decision_tree(md.selected_params(found)))


@query("m14_random_search", _LEVELS, "v_rated")
def m14(spark, sf):
    """The levels of the selected trial of 25."""
    rows = _rows(spark, sf)
    found = md.random_search(rows, FEATURES, LEVEL, md.decision_tree, TREE_SPACE, _seasons(rows))
    return _levels(rows, md.decision_tree(md.selected_params(found)))


@query("m15_eliminate_features", "select 2 as n_features, 'snow,wind' as features, 1.0::double as score")
def m15(spark, sf):
    rows = _rows(spark, sf)
    found = md.eliminate_features(rows, FEATURES, LEVEL, md.decision_tree, _seasons(rows))
    return found.filter("selected").drop("selected")


@query("m16_importances", "select 1 as place, 'snow' as feature union all select 2, 'wind'")
def m16(spark, sf):
    model = md.fit(_rows(spark, sf), FEATURES, LEVEL, md.forest())
    best = top_rows(md.importances(model, FEATURES, spark), "importance", 2, positive_only=True)
    # Two rows.
    return best.select(F.row_number().over(Window.orderBy(F.desc("importance"))).alias("place"), "feature")


@query("m17_score_and_s14_stored_model", "select id, danger_level as predicted_danger from v_rated", "v_rated")
def m17(spark, sf):
    path = new_path(spark, "model")
    save_model(md.fit(_rows(spark, sf), FEATURES, LEVEL, md.decision_tree()), path)
    return md.predict(load_model(path), v.rated(spark, sf), FEATURES).select("id", "predicted_danger")


#: A level by altitude, which SQL knows and a tree finds.
_ALTITUDE_LEVEL = "1 + (altitude >= 900)::int + (altitude >= 1800)::int + (altitude >= 2400)::int"


def _backfilled(spark, sf):
    wanted = ["altitude", "VW", "HN24"]
    profile = v.profile(spark, sf).select("id", "slope_angle", "slope_azi", "altitude", "timestamp", "VW", "HN24")
    rule = F.lit(1)
    for edge in (900, 1800, 2400):
        rule = rule + (F.col("altitude") >= edge).cast("int")
    daily = cut_lineage(shifted_day_mean(profile).withColumn("predicted_danger", rule), "daily")
    stored = daily.filter("date < '2024-01-15' and not (id % 10 = 3 and date > '2024-01-08')")
    model = md.fit(daily, wanted, "predicted_danger", md.decision_tree())
    points = v.points(spark, sf).select("id", "zone_name")
    return pl.missing_predictions(stored, points, profile, model, wanted, date(2024, 1, 30))


_BACKFILLED = f"""
    rows_ as (select id, date, slope_angle, slope_azi, avg(altitude) as altitude from v_profile group by all),
    stored as (select * from rows_ where date < date '2024-01-15' and not (id % 10 = 3 and date > date '2024-01-08')),
    days as (select cast(unnest(generate_series(lo, date '2024-01-30', interval 1 day)) as date) as date from (select min(date) as lo from stored)),
    ids as (select distinct id from v_points),
    counts as (select s.date, s.id, count(*) as n from stored s join ids i on i.id = s.id group by s.date, s.id),
    lacking as (select d.date from days d left join (select date, sum(least(n, 5)) as n from counts group by date) c using (date)
                where (select count(*) from ids) * 5 - coalesce(n, 0) > 5),
    pairs as (select d.date, i.id from days d cross join ids i left join counts c on c.date = d.date and c.id = i.id
              where c.n is null or (c.n < 5 and d.date in (select date from lacking))),
    whole as (select * from stored
              union select r.* from rows_ r join pairs p on p.date = r.date and p.id = r.id),
    rated as (select id, date, slope_angle, slope_azi, altitude, {_ALTITUDE_LEVEL} as predicted_danger from whole)
"""


@query(
    "m19_missing_predictions",
    f"""with {_BACKFILLED},
        banded as (select r.date, z.zone_name, case when r.slope_angle = 0 then 'flat' else 'slope' end as slope_angle, r.predicted_danger,
                   case when r.altitude < 5000 / 3.281 then 'lower' when r.altitude < 6500 / 3.281 then 'middle' when r.altitude < 13000 / 3.281 then 'upper' end as elevation_band
                   from rated r join v_points z on z.id = r.id),
        c as (select date, zone_name, elevation_band, slope_angle, predicted_danger, count(*) as n from banded group by all)
        select date, zone_name, elevation_band, slope_angle, arg_max(predicted_danger, n * 1000 + predicted_danger)::int as predicted_danger
        from c group by date, zone_name, elevation_band, slope_angle""",
    "v_profile v_points",
)
def m19(spark, sf):
    return _backfilled(spark, sf)[1]


@query("m19_predictions", f"with {_BACKFILLED} select id, date, slope_angle, slope_azi, predicted_danger::int as predicted_danger from rated", "v_profile v_points")
def m19_rows(spark, sf):
    return _backfilled(spark, sf)[0].select("id", "date", "slope_angle", "slope_azi", "predicted_danger")
