import json
import math
import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ridgeline.operators.metrics import constant_baseline, evaluate
from ridgeline.operators.ranking import season_folds
from ridgeline.plans import forest, ordinal
from ridgeline.plans import levels as pl
from ridgeline.plans import models as md
from ridgeline.session import new_path
from ridgeline.sources.tables import load_model, save_model

FEATURES = ["snow", "wind", "noise"]
SMALL = {"numTrees": 8, "maxDepth": 5, "minInstancesPerNode": 1}


@pytest.fixture(scope="module")
def rows(spark):
    """Levels that follow snow and wind, over three seasons; some missing values."""
    rng = random.Random(5)
    data = []
    for i in range(600):
        snow, wind = rng.uniform(0, 100), rng.uniform(0, 100)
        level = 1 + (snow > 30) + (snow > 60) + (snow > 60 and wind > 50)
        day = date(2021 + i % 3, 12, 1) + timedelta(days=rng.randrange(100))
        data.append((i, day, snow, wind, None if i % 9 == 0 else rng.random(), int(level)))
    df = spark.createDataFrame(data, "id bigint, date date, snow double, wind double, noise double, danger_level int")
    return season_folds(df).cache()


def accuracy(model, rows):
    return evaluate(md.predict(model, rows, FEATURES), "danger_level", "predicted_danger").first().accuracy


@pytest.mark.parametrize("build, params", [
    (md.forest, SMALL), (md.decision_tree, {"minInstancesPerNode": 1}), (md.boosted_trees, {"maxIter": 5, "maxDepth": 3}),
])
def test_learners_beat_the_constant(rows, build, params):
    model = md.fit(rows, FEATURES, "danger_level", build(params))
    assert accuracy(model, rows) > 0.9 > constant_baseline(rows, "danger_level").first().accuracy
    levels = {r[0] for r in md.predict(model, rows, FEATURES).select("predicted_danger").distinct().collect()}
    assert levels == {1, 2, 3, 4}


def test_same_seed_same_forest(rows):
    a, b = (md.predict(md.fit(rows, FEATURES, "danger_level", md.forest(SMALL)), rows, FEATURES) for _ in range(2))
    assert a.exceptAll(b).count() == 0


def test_defaults_are_the_published_settings():
    forest = md.forest()
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getFeatureSubsetStrategy(), forest.getMinInstancesPerNode()) == (500, 20, "0.5", 4)
    assert (md.decision_tree().getMaxDepth(), md.decision_tree().getMinInstancesPerNode()) == (5, 5)


def test_ordinal_forest(rows):
    model = md.fit(rows, FEATURES, "danger_level", md.ordinal_forest(SMALL))
    got = md.predict(model, rows, FEATURES)
    assert evaluate(got, "danger_level", "predicted_danger").first().accuracy > 0.85
    assert got.columns == [*rows.columns, "predicted_danger"]
    # A threshold that no row fails is always met.
    easy = md.fit(rows.filter("danger_level <= 2"), FEATURES, "danger_level", md.ordinal_forest(SMALL))
    assert {r[0] for r in md.predict(easy, rows, FEATURES).select("predicted_danger").distinct().collect()} <= {1, 2}
    one = md.fit(rows.filter("danger_level = 1"), FEATURES, "danger_level", md.ordinal_forest(SMALL))
    assert {r[0] for r in md.predict(one, rows, FEATURES).select("predicted_danger").distinct().collect()} == {1}


def test_ordinal_stage_beside_its_thresholds(rows):
    """Probabilities are the differences of binary forests that are fitted one by one."""
    model = md.fit(rows, FEATURES, "danger_level", md.ordinal_forest(SMALL))
    got = model.transform(rows.na.fill(0.0, FEATURES)).select("id", "probability", "prediction").orderBy("id").collect()
    below = []
    for k in (1, 2, 3):
        binary = rows.withColumn("side", (F.col("danger_level") <= k).cast("int") + 1)
        one = md.fit(binary, FEATURES, "side", md.forest(SMALL))
        below.append([r.probability[1] for r in one.transform(rows.na.fill(0.0, FEATURES)).orderBy("id").collect()])
    for i, r in enumerate(got):
        p = [below[0][i], below[1][i] - below[0][i], below[2][i] - below[1][i], 1 - below[2][i]]
        assert list(r.probability) == pytest.approx(p) and r.prediction == p.index(max(p))


def test_ordinal_stage_is_stored_and_searched(spark, rows):
    path = new_path(spark, "ordinal")
    model = md.fit(rows, FEATURES, "danger_level", md.ordinal_forest(SMALL))
    save_model(model, path)
    a, b = (md.predict(m, rows, FEATURES) for m in (model, load_model(path)))
    assert a.exceptAll(b).count() == 0
    learner = md.ordinal_forest({"numTrees": 2, "maxDepth": 2})
    learner.write().overwrite().save(path + "-learner")
    back = type(learner).load(path + "-learner")
    assert back.uid == learner.uid and back.getClassifier().getNumTrees() == 2 and back.getLabelCol() == md.LABEL
    found = md.halving_search(rows, FEATURES, "danger_level", md.ordinal_forest, {"numTrees": [1, 3], "maxDepth": [1, 5]}, [2021], ["id"], factor=2)
    assert md.selected_params(found)["maxDepth"] == 5


def test_season_scores(rows):
    got = md.season_scores(rows, FEATURES, "danger_level", md.decision_tree(), [2021, 2022]).collect()
    assert [(r.season, r.part) for r in got] == [(2021, "train"), (2021, "test"), (2022, "train"), (2022, "test")]
    assert all(r.accuracy > 0.8 for r in got)


def test_halving_keeps_the_best_quarter(rows):
    grid = {"maxDepth": [1, 4], "minInstancesPerNode": [1, 200]}
    got = md.halving_search(rows, FEATURES, "danger_level", md.decision_tree, grid, [2021], ["id"], factor=2)
    # 1 + floor(log(4, 2)) rounds: the last has all rows
    assert [(r.iter, r.share, r.candidates) for r in got.collect()] == [(0, 0.25, 4)] * 4 + [(1, 0.5, 2)] * 2 + [(2, 1.0, 1)]
    (best,) = got.filter("selected").collect()
    assert best.iter == 2 and md.selected_params(got)["maxDepth"] == 4


def test_random_search_is_seeded(rows):
    space = {"maxDepth": ("choice", [1, 2]), "minInstancesPerNode": ("quniform", 1, 5)}
    a, b = (md.random_search(rows, FEATURES, "danger_level", md.decision_tree, space, [2021], trials=2) for _ in range(2))
    assert a.collect() == b.collect() and a.count() == 2 and a.filter("selected").count() == 1


def test_searches_beside_plain_fits(rows, monkeypatch):
    """A held-out score equals the evaluation of a plain fit on the other seasons; the source is read once."""
    learner = md.decision_tree({"maxDepth": 3})
    want = []
    for season in (2021, 2022, 2023):
        scored = md.held_out_levels(rows, FEATURES, "danger_level", learner, [season])
        want.append(evaluate(scored, "danger_level", "predicted_danger").first().balanced_accuracy)
    reads, prepared = [], md.prepared
    monkeypatch.setattr(md, "prepared", lambda *a, **k: reads.append(1) or prepared(*a, **k))
    assert md.held_out_score(rows, FEATURES, "danger_level", learner, [2021, 2022, 2023]) == pytest.approx(sum(want) / 3)
    space = {"maxDepth": ("choice", [3])}
    found = md.random_search(rows, FEATURES, "danger_level", md.decision_tree, space, [2021, 2022, 2023], trials=2).collect()
    assert [r.score for r in found] == pytest.approx([sum(want) / 3] * 2) and len(reads) == 2
    assert math.isnan(md.held_out_score(rows, FEATURES, "danger_level", learner, [1900]))


def test_elimination_drops_the_noise(spark, rows):
    got = md.eliminate_features(rows, FEATURES, "danger_level", md.decision_tree, [2021]).orderBy("n_features").collect()
    assert [r.n_features for r in got] == [1, 2, 3] and got[0].features == "snow" and got[1].features == "snow,wind"
    assert [r.selected for r in got] == [False, True, False]
    model = md.fit(rows, FEATURES, "danger_level", md.forest(SMALL))
    table = {r.feature: r.importance for r in md.importances(model, FEATURES, spark).collect()}
    assert table["snow"] > table["wind"] > table.get("noise", 0) and all(v > 0 for v in table.values())


def test_stored_model_scores_the_same(spark, rows):
    model = md.fit(rows, FEATURES, "danger_level", md.decision_tree())
    path = new_path(spark, "model")
    save_model(model, path)
    assert accuracy(load_model(path), rows) == accuracy(model, rows)


def test_missing_predictions(spark):
    """Two points, three days: one day is whole, one lacks a point, one is empty."""
    from datetime import datetime

    hours = [(p, a, z, 1000.0, datetime(2025, 1, d, 12) , float(p + d)) for p in (1, 2, 202) for d in (10, 11, 12)
             for a, z in ((0.0, 0.0), (38.0, 0.0), (38.0, 90.0), (38.0, 180.0), (38.0, 270.0))]
    profile = spark.createDataFrame(hours, "id bigint, slope_angle double, slope_azi double, altitude double, timestamp timestamp_ntz, TA double")
    points = spark.createDataFrame([(1, "Swan"), (2, "Swan"), (202, "Whitefish")], "id bigint, zone_name string")
    from ridgeline.operators.aggregate import shifted_day_mean

    daily = shifted_day_mean(profile).withColumn("predicted_danger", F.lit(2)).filter("id != 202")
    stored = daily.filter("date = '2025-01-10' or (date = '2025-01-11' and id = 1)")
    trained = daily.withColumn("predicted_danger", F.when(F.col("TA") > 12.5, 3).otherwise(1))
    model = md.fit(trained, ["TA"], "predicted_danger", md.decision_tree({"minInstancesPerNode": 1}))
    whole, zones = pl.missing_predictions(stored, points, profile, model, ["TA"], date(2025, 1, 12), tolerance=2, excluded=[202])
    got = {(str(r.date), r.id): r.n for r in whole.groupBy("date", "id").agg(F.count("*").alias("n")).collect()}
    assert got == {(f"2025-01-{d}", i): 5 for d in (10, 11, 12) for i in (1, 2)}
    assert {r.predicted_danger for r in whole.filter("date = '2025-01-10'").collect()} == {2}
    assert {r.predicted_danger for r in whole.filter("date = '2025-01-12'").collect()} == {3}
    assert zones.filter("elevation_band = 'lower' and zone_name = 'Swan'").count() == 6


def _few(spark, n=240):
    rows = [(i, 2020 + i % 3, float(i % 8), float(i % 5), 1 + (i % 8 >= 4)) for i in range(n)]
    return spark.createDataFrame(rows, "id int, season int, snow double, wind double, danger_level int").coalesce(1)


def test_a_parameter_set_drawn_again_is_not_fitted_again(spark, monkeypatch):
    """Each fit opens the folders of its seasons and knows the classes."""
    fits, fit_fold = [], md._fit_fold

    def counted(folds, sizes, estimator, held, keep, boosts):
        fits.append((estimator.getMaxDepth(), estimator.getMinInstancesPerNode(), held))
        plan = folds.rows.filter(F.col("season") == held)._jdf.queryExecution().executedPlan().toString()
        assert "season" in plan.split("PartitionFilters: [")[1].split("]")[0]
        return fit_fold(folds, sizes, estimator, held, keep, boosts)

    monkeypatch.setattr(md, "_fit_fold", counted)
    space = {"maxDepth": ("choice", [2, 3]), "minInstancesPerNode": ("quniform", 1, 1)}
    found = md.random_search(_few(spark), ["snow", "wind"], "danger_level", md.decision_tree, space, [2020, 2021, 2022], trials=8)
    rows = found.orderBy("trial").collect()
    assert len(rows) == 8 and [r.trial for r in rows if r.selected] == [0] and {r.score for r in rows} == {1.0}
    drawn = {(json.loads(r.params)["maxDepth"], 1) for r in rows}
    assert sorted(fits) == sorted((*d, season) for d in drawn for season in (2020, 2021, 2022))


def test_learners_get_a_part_for_each_core(spark, monkeypatch):
    """One small file would keep one core busy for all passes."""
    parts, fit = [], md.Pipeline.fit
    monkeypatch.setattr(md.Pipeline, "fit", lambda self, rows: parts.append(rows.rdd.getNumPartitions()) or fit(self, rows))
    model = md.fit(_few(spark), ["snow", "wind"], "danger_level", md.decision_tree())
    assert parts[0] >= spark.sparkContext.defaultParallelism
    assert md.predict(model, _few(spark), ["snow", "wind"]).filter("predicted_danger != danger_level").count() == 0


def _wide(spark, n, copies=1):
    """A feature of 8 values and one of many; level 3 is rare."""
    rows = spark.range(n * copies).selectExpr("id", "cast(id % 8 as double) as snow", f"cast(id % {n} * 7919 % 10007 / 100 as double) as wind")
    return rows.withColumn("danger_level", F.expr("1 + cast(snow >= 4 as int) + cast(snow >= 4 and wind > 96 as int)"))


def test_boosted_trees_are_fitted_on_cells(spark, monkeypatch):
    """Many times the rows are no more training rows; all of them are in the weights."""
    seen, fit = [], md.Pipeline.fit

    def counted(self, rows):
        seen.append(rows.agg(F.count("*"), F.sum(md.WEIGHT)).first())
        return fit(self, rows)

    monkeypatch.setattr(md.Pipeline, "fit", counted)
    small = {"maxIter": 2, "maxDepth": 2, "maxBins": 8}
    for copies in (1, 8):
        df = _wide(spark, 5000, copies)
        model = md.fit(df, ["snow", "wind"], "danger_level", md.boosted_trees(small))
        found = md.predict(model, df, ["snow", "wind"])
        assert found.columns == [*df.columns, "predicted_danger"] and found.count() == 5000 * copies
    # 8 values, 8 bins, 3 levels
    assert all(n <= 8 * 8 * 3 * md.SHARES for n, _ in seen) and seen[1][0] < 5000
    assert [w for _, w in seen] == [pytest.approx(5000), pytest.approx(40000)]
    # A least number of rows in a node needs the rows themselves.
    md.fit(df, ["snow", "wind"], "danger_level", md.boosted_trees({**small, "minInstancesPerNode": 2}))
    assert seen[2][0] == 40000


def test_trees_on_cells_beside_trees_on_binned_rows(spark):
    """Without draws the sums of weights and gradients are the same, and so are the trees."""
    features, learner = ["snow", "wind"], md.boosted_trees({"maxIter": 3, "maxDepth": 3, "subsamplingRate": 1.0})
    df = _wide(spark, 3000)
    rows = md.weighted_rows(df, "danger_level")
    bins = md.bins_of(rows, features, 32)
    plain = md.Pipeline(stages=[bins, md.VectorAssembler(inputCols=bins.getOutputCols(), outputCol=md.FEATURES), learner]).fit(rows)
    got, want = (
        [(r.id, r.prediction, *r.rawPrediction) for r in m.transform(df).orderBy("id").collect()]
        for m in (md.fit(df, features, "danger_level", learner), plain)
    )
    assert len(got) == 3000
    for a, b in zip(got, want):
        assert a == pytest.approx(b, abs=1e-6)


def test_bins_go_by_weight(spark):
    assert md._edges([(float(v), 1.0) for v in (3, 1, 1, 7)], 4) == [2.0, 5.0]
    assert md._edges([(2.0, 1.0)], 4) == [0.0] and len(md._edges([(float(v), 1.0) for v in range(1000)], 32)) == 31
    # One value with most of the weight has one bin; the others share the rest.
    edges = md._edges([(0.0, 900.0), *((float(v), 1.0) for v in range(1, 101))], 5)
    assert edges == [0.5, 25.5, 50.5, 75.5]
    # The rare level has a third of the weight and of the bins.
    df = _wide(spark, 9000)
    rare, rows = df.filter("danger_level = 3").count(), md.weighted_rows(df, "danger_level")
    high = [e for e in md.bins_of(rows, ["wind"], 30).getSplitsArray()[0] if 96 < e < 101]
    assert rare < 9000 / 40 and len(high) >= 8


def _trees(model):
    """Nodes in words, without the ids of the stage."""
    return model.toDebugString.split("\n", 1)[1]


def test_ordinal_forest_is_grown_over_cells(spark, monkeypatch):
    """No forest gets the rows, and rows of one cell are scored once; stored and loaded it is the same."""
    seen, fit, scored, transform = [], forest.RandomForestClassifier.fit, [], ordinal.OrdinalModel.transform
    monkeypatch.setattr(forest.RandomForestClassifier, "fit", lambda self, rows, *a: seen.append(rows.count()) or fit(self, rows, *a))
    monkeypatch.setattr(ordinal.OrdinalModel, "transform", lambda self, rows, *a: scored.append(rows.count()) or transform(self, rows, *a))
    df = _wide(spark, 4000, 3)
    learner = md.ordinal_forest({"numTrees": 20, "maxDepth": 6})
    model = md.fit(df, ["snow", "wind"], "danger_level", learner)
    path = new_path(spark, "ordinal")
    save_model(model, path)
    got = md.predict(load_model(path), df, ["snow", "wind"])
    assert got.columns == [*df.columns, "predicted_danger"] and got.count() == 12000
    assert evaluate(got, "danger_level", "predicted_danger").first().accuracy > 0.98
    assert seen == [2, 2] and len(scored) == 1 and scored[0] <= 8 * 63
    assert [(m.getNumTrees, len(m.trees), m.numClasses, m.numFeatures) for m in model.stages[-1].models] == [(20, 20, 2, 2)] * 2
    # Each tree draws for itself, and the same in the next run.
    assert len({t.toDebugString.split("\n", 1)[1] for t in model.stages[-1].models[1].trees}) > 1
    again = md.fit(df, ["snow", "wind"], "danger_level", learner)
    assert [_trees(m) for m in again.stages[-1].models] == [_trees(m) for m in model.stages[-1].models]
    assert model.stages[-1].featureImportances.toArray().sum() == pytest.approx(1)


def test_cells_are_scored_as_rows(spark):
    df = _wide(spark, 4000, 3)
    model = md.fit(df, ["snow", "wind"], "danger_level", md.ordinal_forest({"numTrees": 5, "maxDepth": 6}))
    rows = model.stages[0].transform(df)
    at_once, each = (f(rows).select("id", "probability", "prediction").orderBy("id").collect() for f in (model.stages[-1].transform_cells, model.stages[-1].transform))
    assert at_once == each and len(each) == 12000


@pytest.mark.parametrize("more", [{}, {"impurity": "entropy", "minInstancesPerNode": 40, "maxDepth": 3}, {"minInfoGain": 0.01}])
def test_trees_over_cells_beside_trees_over_rows(spark, more):
    """Without draws and with a bin for each value both are one tree."""
    rows = spark.range(6000).selectExpr("cast(id % 12 as double) as a", "cast(id * 7919 % 10007 % 20 as double) as b", "pmod(xxhash64(id), 100) as r")
    rows = rows.selectExpr("array(a, b) as f", "cast(a * 3 + b > 30 or r < 10 as double) as y").withColumns({"f": array_to_vector("f"), "w": F.expr("if(y = 1, 2.5, 0.75)")})
    learner = forest.RandomForestClassifier(
        labelCol="y", featuresCol="f", weightCol="w", numTrees=1, bootstrap=False, featureSubsetStrategy="all", **{"maxDepth": 6, "minInstancesPerNode": 4, **more}
    )
    edges = [[i + 0.5 for i in range(11)], [i + 0.5 for i in range(19)]]
    got, want = forest.fit_on_cells(learner, rows, edges, [0.75, 2.5], 6000), learner.fit(rows)
    assert _trees(got) == _trees(want) and want.totalNumNodes > 2
    a, b = ([(r.prediction, *r.rawPrediction) for r in m.transform(rows.select("f").distinct().orderBy(F.col("f").cast("string"))).collect()] for m in (got, want))
    assert len(a) == 240 and all(x == pytest.approx(y) for x, y in zip(a, b))
    assert got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray())
    assert got.uid == want.uid and got.getMaxDepth() == want.getMaxDepth() and got.getImpurity() == want.getImpurity()
    # Nothing is gained where cells are about as many as rows.
    assert forest.fit_on_cells(learner, rows, edges, [0.75, 2.5], 300) is None


def test_a_tree_draws_as_often_as_all_rows_would():
    """10,000 rows of a cell are drawn some 10,000 times, with the spread of single draws; rows of minInstancesPerNode are draws."""
    rng, p = np.random.default_rng(3), {"bootstrap": True, "share": 1.0}
    drawn = np.array([forest._drawn(np.array([[10_000, 0]]), p, rng)[0] for _ in range(2000)])
    assert abs(drawn[:, 0].mean() - 10_000) < 15 and 90 < drawn[:, 0].std() < 110 and not drawn[:, 1].any()
    assert forest._drawn(np.array([[7]]), {"bootstrap": False, "share": 1.0}, rng).tolist() == [[7]]
    assert 0 < forest._drawn(np.array([[1000]]), {"bootstrap": False, "share": 0.5}, rng)[0, 0] < 1000
    tree = {"depth": 5, "features": 1, "impurity": "gini", "rows": 4, "gain": 0.0, "weight": 0.0}
    for n, nodes in ((3, 1), (4, 3)):
        found = forest.grow(np.array([[0], [1]], np.uint8), np.array([[n, 0], [0, n]]), np.array([1.0, 1.0]), [[0.5]], tree, rng)
        assert len(found) == nodes and found["n"].iloc[0] == 2 * n
    assert [forest._features(s, 9, 5) for s in ("0.5", "sqrt", "auto", "all", "log2", "onethird", "4")] == [5, 3, 3, 9, 4, 3, 4]


def test_bins_lie_as_splits_see_them(spark):
    """A value at an edge goes to the left; a value above all and NaN go to the right."""
    values = [-math.inf, 0.5, 1.0, 1.0000001, 2.0, 9.0, math.inf, math.nan]
    rows = spark.createDataFrame([(i, [v]) for i, v in enumerate(values)], "id int, v array<double>").withColumn("f", array_to_vector("v"))
    assert [r.b for r in forest.in_bins(rows, "f", [[1.0, 2.0]], ["b"]).orderBy("id").collect()] == [0, 0, 0, 1, 1, 2, 2, 2]
    # The least and the largest value count, however rare.
    rare = spark.range(50_000).select(array_to_vector(F.array(F.expr("cast(id = 77 as double)"))).alias("f"), F.lit(0).alias("y"))
    points = forest.quantiles(rare, "f", F.col("y"), 1)
    assert forest.edges_of(points, {0: 50_000.0}, 32) == [[0.5]]
