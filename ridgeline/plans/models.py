"""Tree models over daily features.

Training runs on MLlib, which grows all trees of a forest over the distributed
rows at once. Loops on the driver go over folds, parameter sets or feature
counts, never over rows. Searches prepare their rows once, as vectors with season
and class, and run a bounded number of fits side by side on that table.
"""

from __future__ import annotations

import itertools
import json
import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler, VectorSlicer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ridgeline.functions import lookup, shift_label
from ridgeline.operators.metrics import class_weights
from ridgeline.operators.ranking import hold_out
from ridgeline.plans.forest import bin_edges as _edges
from ridgeline.plans.ordinal import OrdinalClassifier, OrdinalModel
from ridgeline.session import cut_lineage, new_path

LABEL, WEIGHT, FEATURES = "_label", "_weight", "_features"
#: Classes whose weights are brought to the driver, at most.
MOST_CLASSES = 100
#: Fits of a search that run at the same time.
PARALLELISM = 4
#: Quantiles of a feature within each class, from which the bins of boosted trees are made.
POINTS = 500
#: Training rows that a class keeps in each cell of bins, at most: a tree that leaves out one row in twenty leaves out one of these.
SHARES = 20

# --- fixed values: settings of the published forest, tree and boosted model, and their search spaces ---
FOREST = {"numTrees": 500, "maxDepth": 20, "featureSubsetStrategy": "0.5", "minInstancesPerNode": 4}
TREE = {"maxDepth": 5, "minInstancesPerNode": 5}
BOOSTED = {"maxIter": 100, "maxDepth": 4, "stepSize": 0.09641108065279469, "subsamplingRate": 0.950099043659659}
FOREST_GRID = {
    "numTrees": [300, 500, 800], "maxDepth": [10, 20, 30],
    "minInstancesPerNode": [1, 4, 10], "featureSubsetStrategy": ["sqrt", "0.5"],
}
BOOSTED_SPACE = {
    "stepSize": ("loguniform", 0.03, 0.2), "maxDepth": ("choice", [3, 4, 5, 6, 8]),
    "subsamplingRate": ("uniform", 0.6, 1.0), "maxIter": ("choice", [100, 200, 400]),
    "minInstancesPerNode": ("quniform", 1, 10),
}
# --- end of fixed values ---

Build = Callable[[Mapping], Estimator]


def forest(params: Mapping = FOREST, seed: int = 42) -> RandomForestClassifier:
    """M8: random forest."""
    return RandomForestClassifier(
        labelCol=LABEL, featuresCol=FEATURES, weightCol=WEIGHT, seed=seed, **{**FOREST, **params}
    )


def decision_tree(params: Mapping = TREE, seed: int = 42) -> DecisionTreeClassifier:
    """M9: single decision tree."""
    return DecisionTreeClassifier(
        labelCol=LABEL, featuresCol=FEATURES, weightCol=WEIGHT, seed=seed, **{**TREE, **params}
    )


def boosted_trees(params: Mapping = BOOSTED, seed: int = 42) -> OneVsRest:
    """Boosted trees, one binary model per class."""
    binary = GBTClassifier(
        labelCol=LABEL, featuresCol=FEATURES, weightCol=WEIGHT, seed=seed, **{**BOOSTED, **params}
    )
    return OneVsRest(classifier=binary, labelCol=LABEL, featuresCol=FEATURES, weightCol=WEIGHT, parallelism=PARALLELISM)


def weighted_rows(df: DataFrame, level: str, boosts: Mapping | None = None) -> DataFrame:
    """M7: class index (F18) and balanced weight as columns.

    The weights are as many numbers as there are levels; they travel as
    literals, so the training rows are not shuffled for them.
    """
    found = class_weights(df, level, dict(boosts or {})).select(level, "weight").limit(MOST_CLASSES + 1).collect()
    if len(found) > MOST_CLASSES:
        raise ValueError(f"{level} has more than {MOST_CLASSES} classes")
    table = {row[0]: float(row[1]) for row in found}
    return df.withColumns({
        LABEL: shift_label(F.col(level)).cast("double"), WEIGHT: lookup(F.col(level), table, F.lit(1.0)),
    })


def spread(rows: DataFrame) -> DataFrame:
    """Rows in as many parts as there are cores at least: learners pass over them some hundred times, and few files would keep as few cores busy."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def fit(df: DataFrame, features: Sequence[str], level: str, estimator: Estimator, boosts: Mapping | None = None) -> PipelineModel:
    """C7, M7 and a fit: missing features are 0, classes are balanced.

    Boosted trees are fitted on ``cells`` of the rows, and their model bins the features before it scores.
    """
    rows, inputs, first = weighted_rows(df.na.fill(0.0, list(features)), level, boosts), list(features), []
    if _in_cells(rows, features, estimator):
        bins = bins_of(rows, features, estimator.getClassifier().getMaxBins())
        rows, inputs, first = cells(rows, bins), bins.getOutputCols(), [bins]
    model = Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol=FEATURES), estimator]).fit(spread(rows))
    return PipelineModel(stages=[*first, *model.stages])


def _in_cells(rows: DataFrame, features: Sequence[str], estimator: Estimator) -> bool:
    """Whether the estimator sees no more of a row than its bins, class and weight; a least number of rows in a node would need them counted."""
    if not (isinstance(estimator, OneVsRest) and isinstance(estimator.getClassifier(), GBTClassifier)):
        return False
    return estimator.getClassifier().getMinInstancesPerNode() == 1 and all(isinstance(rows.schema[f].dataType, NumericType) for f in features)


def bins_of(rows: DataFrame, features: Sequence[str], most: int) -> Bucketizer:
    """At most ``most`` bins for each feature, from one pass: all rows count, with their weights, as MLlib's own bins have it.

    Weights belong to classes, so weighted quantiles follow from those of each class, some hundred numbers each.
    """
    shares = [(i + 0.5) / POINTS for i in range(POINTS)]
    quantiles = [F.percentile_approx(f, shares, 10 * POINTS).alias(f"_points_{i}") for i, f in enumerate(features)]
    found = rows.groupBy(LABEL).agg(F.sum(WEIGHT).alias("_total"), *quantiles).collect()
    edges = [_edges([(float(v), r["_total"] / POINTS) for r in found for v in r[f"_points_{i}"]], most) for i in range(len(features))]
    return Bucketizer(
        splitsArray=[[-math.inf, *e, math.inf] for e in edges], inputCols=list(features), outputCols=[f"_bin_{i}" for i in range(len(features))],
        handleInvalid="error",
    )


def cells(rows: DataFrame, bins: Bucketizer) -> DataFrame:
    """Rows of one class that fall into the same bins as at most ``SHARES`` rows, which weigh as much as they do.

    Trees choose among sums of weights and gradients by bin, and gradients depend on bins and class alone, so
    the sums stay what they are. However many rows there are, ``bins ** features * classes * SHARES`` bound the table.
    Each tree draws from these rows as it does from single ones.
    """
    share = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SHARES)).alias("_share")
    keys = [F.col(c) for c in (LABEL, *bins.getOutputCols())]
    return cut_lineage(bins.transform(rows).groupBy(*keys, share).agg(F.sum(WEIGHT).alias(WEIGHT)).drop("_share"), "cells")


def predict(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows with ``predicted_danger``, levels counted from 1. An ordinal model may run a job, as it scores cells of rows."""
    *first, last = model.stages
    rows = df.na.fill(0.0, list(features))
    scored = last.transform_cells(PipelineModel(stages=first).transform(rows)) if isinstance(last, OrdinalModel) else model.transform(rows)
    return scored.select(*df.columns, (F.col("prediction") + 1).cast("int").alias("predicted_danger"))


def ordinal_forest(params: Mapping = FOREST, seed: int = 42) -> OrdinalClassifier:
    """One forest for each threshold; class probabilities by difference."""
    binary = RandomForestClassifier(seed=seed, **{**FOREST, **params})
    return OrdinalClassifier(classifier=binary, labelCol=LABEL, featuresCol=FEATURES)


@dataclass(frozen=True)
class Folds:
    """Rows prepared once for many fits: features as a vector, class index, season, and a place between 0 and 1.

    ``rows`` is a written table with a folder for each season; fits and scores open the folders of their seasons and nothing else.
    """

    rows: DataFrame
    features: tuple[str, ...]

    def part(self, share: float) -> Folds:
        """A nested sample: rows whose place lies below ``share``."""
        return self if share >= 1 else Folds(self.rows.filter(F.col(_PLACE) < share), self.features)

    def sizes(self) -> dict[int, dict[float, int]]:
        """Rows of each season and class, a handful of numbers."""
        found = self.rows.groupBy("season", LABEL).agg(F.count(F.lit(1)).alias("n")).limit(MOST_CLASSES * 1000).collect()
        out: dict[int, dict[float, int]] = {}
        for r in found:
            out.setdefault(r["season"], {})[r[LABEL]] = r["n"]
        return out


_PLACE = "_place"


def prepared(df: DataFrame, features: Sequence[str], level: str, keys: Sequence[str] = (), seed: int = 42) -> Folds:
    """One scan of the rows for all fits of a search; ``keys`` give each row its place in the nested samples."""
    rows = VectorAssembler(inputCols=list(features), outputCol=FEATURES).transform(df.na.fill(0.0, list(features)))
    place = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1_000_000)) / 1_000_000
    rows = rows.select(FEATURES, shift_label(F.col(level)).cast("double").alias(LABEL), "season", place.alias(_PLACE))
    path = new_path(df.sparkSession, "folds")
    rows.write.partitionBy("season").parquet(path)
    return Folds(df.sparkSession.read.schema(rows.schema).parquet(path), tuple(features))


def _balanced(sizes: Mapping[float, int], boosts: Mapping | None = None) -> Column:
    """M7 from the class sizes: every class weighs the same; ``boosts`` go by level."""
    total = sum(sizes.values())
    table = {c: total / (len(sizes) * n) * (boosts or {}).get(int(c) + 1, 1.0) for c, n in sizes.items()}
    return lookup(F.col(LABEL), table, F.lit(1.0))


def _metrics(pairs: Mapping[tuple[float, float], int]) -> dict[str, float]:
    """M1 from the counts of (actual, predicted) pairs."""
    total = sum(pairs.values())
    hits, actual = {}, {}
    for (a, p), n in pairs.items():
        actual[a] = actual.get(a, 0) + n
        hits[a] = hits.get(a, 0) + n * (a == p)
    return {
        "accuracy": sum(hits.values()) / total,
        "balanced_accuracy": sum(hits[a] / n for a, n in actual.items()) / len(actual),
        "mae": sum(abs(a - p) * n for (a, p), n in pairs.items()) / total,
    }


def _fit_fold(folds: Folds, sizes: Mapping[int, Mapping[float, int]], estimator: Estimator, held: int | None, keep: Sequence[int] | None, boosts: Mapping | None):
    """A model of all seasons but ``held``, on the features numbered ``keep`` (all if None)."""
    classes: dict[float, int] = {}
    for season, own in sizes.items():
        if season != held:
            for c, n in own.items():
                classes[c] = classes.get(c, 0) + n
    rows = folds.rows if held is None else folds.rows.filter(F.col("season") != held)
    stages: list = [estimator]
    if keep is not None:
        stages = [VectorSlicer(inputCol=FEATURES, outputCol="_kept", indices=list(keep)), estimator.copy({estimator.featuresCol: "_kept"})]
    rows = rows.withColumn(WEIGHT, _balanced(classes, boosts))
    if classes:  # known from the sizes: else every fit reads all rows for it first
        rows = rows.withMetadata(LABEL, {"ml_attr": {"type": "nominal", "name": LABEL, "num_vals": int(max(classes)) + 1}})
    return Pipeline(stages=stages).fit(rows)


def _scored(model: PipelineModel, rows: DataFrame) -> dict[str, float]:
    pairs = model.transform(rows).groupBy(LABEL, "prediction").agg(F.count(F.lit(1)).alias("n")).collect()
    return _metrics({(r[LABEL], r["prediction"]): r["n"] for r in pairs})


def _at_once(jobs: Sequence[Callable[[], object]], spark: SparkSession, parallelism: int) -> list:
    """Run fits side by side, a bounded number at a time; results in order."""
    pool = ThreadPool(max(1, parallelism))
    try:
        return pool.map(inheritable_thread_target(spark)(lambda job: job()), jobs, chunksize=1)
    finally:
        pool.close()


def _held_out(folds: Folds, candidates: Sequence[tuple[Estimator, Sequence[int] | None]], seasons: Sequence[int], metric: str, parallelism: int) -> list[float]:
    """Mean score of each candidate (estimator, features) over the held-out seasons that have rows on both sides."""
    sizes = folds.sizes()
    usable = [k for k in seasons if k in sizes and len(sizes) > 1]

    def job(estimator: Estimator, keep: Sequence[int] | None, season: int) -> Callable[[], float]:
        return lambda: _scored(_fit_fold(folds, sizes, estimator, season, keep, None), folds.rows.filter(F.col("season") == season))[metric]

    found = _at_once([job(e, keep, k) for e, keep in candidates for k in usable], folds.rows.sparkSession, parallelism)
    n = len(usable)
    return [sum(found[i * n : i * n + n]) / n if n else math.nan for i in range(len(candidates))]


def season_scores(
    df: DataFrame, features: Sequence[str], level: str, estimator: Estimator, seasons: Sequence[int],
    boosts: Mapping | None = None, parallelism: int = PARALLELISM,
) -> DataFrame:
    """Scores on the training seasons and on each held-out season, from one prepared table."""
    folds = prepared(df, features, level)
    sizes = folds.sizes()

    def job(season: int) -> Callable[[], list[tuple]]:
        def run() -> list[tuple]:
            model, held = _fit_fold(folds, sizes, estimator, season, None, boosts), F.col("season") == season
            out = []
            for part, rows in (("train", folds.rows.filter(~held)), ("test", folds.rows.filter(held))):
                found = _scored(model, rows) if part == "train" or season in sizes else dict.fromkeys(("accuracy", "balanced_accuracy", "mae"))
                out.append((season, part, found["accuracy"], found["balanced_accuracy"], found["mae"]))
            return out

        return run

    rows = [row for part in _at_once([job(s) for s in seasons], df.sparkSession, parallelism) for row in part]
    return _result_rows(df.sparkSession, rows, "season int, part string, accuracy double, balanced_accuracy double, mae double")


def held_out_levels(df: DataFrame, features: Sequence[str], level: str, estimator: Estimator, seasons: Sequence[int], boosts: Mapping | None = None) -> DataFrame:
    """Every row with the level that a model of all other seasons gives it."""
    out = None
    for season in seasons:
        train, test = hold_out(df, season)
        scored = predict(fit(train, features, level, estimator, boosts), test, features)
        out = scored if out is None else out.unionByName(scored)
    return out


def held_out_score(
    df: DataFrame, features: Sequence[str], level: str, estimator: Estimator, seasons: Sequence[int],
    metric: str = "balanced_accuracy", parallelism: int = PARALLELISM,
) -> float:
    """Mean score over the held-out seasons."""
    return _held_out(prepared(df, features, level), [(estimator, None)], seasons, metric, parallelism)[0]


def _result_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def halving_search(
    df: DataFrame, features: Sequence[str], level: str, build: Build, grid: Mapping[str, Sequence],
    seasons: Sequence[int], keys: Sequence[str], factor: int = 4, metric: str = "balanced_accuracy", seed: int = 42,
    parallelism: int = PARALLELISM,
) -> DataFrame:
    """Successive halving over a parameter grid.

    Every round keeps the best ``1/factor`` of the candidates and gives them
    ``factor`` times the rows; the last round has all rows. There are
    ``1 + floor(log(candidates, factor))`` rounds. They are nested hash samples, so
    a candidate is compared on rows it has seen before. ``selected`` marks the best
    candidate of the last round. All fits read one prepared table.
    """
    candidates = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    folds, rounds = prepared(df, features, level, keys, seed), 1
    while factor**rounds <= len(candidates):
        rounds += 1
    rows = []
    for i in range(rounds):
        share = 1 / factor ** (rounds - 1 - i)
        found = _held_out(folds.part(share), [(build(p), None) for p in candidates], seasons, metric, parallelism)
        scored = sorted(zip(found, candidates), key=lambda sp: (math.isnan(sp[0]), -sp[0]))
        rows += [(i, share, len(candidates), json.dumps(p), float(s), i == rounds - 1 and k == 0) for k, (s, p) in enumerate(scored)]
        candidates = [p for _, p in scored[: max(1, math.ceil(len(candidates) / factor))]]
    return _result_rows(df.sparkSession, rows, "iter int, share double, candidates int, params string, score double, selected boolean")


def selected_params(search: DataFrame) -> dict:
    """The parameters a search has selected."""
    return json.loads(search.filter("selected").first()["params"])


def draw(space: Mapping[str, tuple], rng: random.Random) -> dict:
    """One parameter set from a search space."""
    out = {}
    for name, (kind, *spec) in space.items():
        if kind == "choice":
            out[name] = rng.choice(spec[0])
        elif kind == "loguniform":
            out[name] = math.exp(rng.uniform(math.log(spec[0]), math.log(spec[1])))
        elif kind == "quniform":
            out[name] = int(round(rng.uniform(*spec)))
        else:
            out[name] = rng.uniform(*spec)
    return out


def random_search(
    df: DataFrame, features: Sequence[str], level: str, build: Build, space: Mapping[str, tuple],
    seasons: Sequence[int], trials: int = 25, seed: int = 42, parallelism: int = PARALLELISM,
) -> DataFrame:
    """Random parameter sets, scored on the held-out seasons; the first of the best is ``selected``."""
    rng = random.Random(seed)
    drawn = [draw(space, rng) for _ in range(trials)]
    # Fits depend on nothing but their parameters, so a set that is drawn again has the score of the first.
    names = [json.dumps(p, sort_keys=True) for p in drawn]
    once = dict(zip(names, drawn))
    scores = dict(zip(once, _held_out(prepared(df, features, level), [(build(p), None) for p in once.values()], seasons, "balanced_accuracy", parallelism)))
    found = [scores[name] for name in names]
    best = min(range(trials), key=lambda i: (math.isnan(found[i]), -found[i], i), default=None)
    rows = [(i, json.dumps(p), float(s), i == best) for i, (p, s) in enumerate(zip(drawn, found))]
    return _result_rows(df.sparkSession, rows, "trial int, params string, score double, selected boolean")


def importances(model: PipelineModel, features: Sequence[str], spark: SparkSession) -> DataFrame:
    """Importance per feature, positive ones only."""
    stage: Transformer = model.stages[-1]
    values = stage.featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(features, values) if v > 0]
    return _result_rows(spark, rows, "feature string, importance double")


def eliminate_features(
    df: DataFrame, features: Sequence[str], level: str, build: Build, seasons: Sequence[int],
    step: int = 1, least: int = 1, metric: str = "accuracy", parallelism: int = PARALLELISM,
) -> DataFrame:
    """Drop the least important features one step at a time.

    One row per feature count with the mean held-out score; the row with the
    best score, the fewest features on a tie, is ``selected``.
    """
    folds = prepared(df, features, level)
    sizes, left, rows = folds.sizes(), list(range(len(features))), []
    while True:
        score = _held_out(folds, [(build({}), left)], seasons, metric, parallelism)[0]
        rows.append((len(left), ",".join(features[i] for i in left), float(score)))
        if len(left) <= least:
            break
        model = _fit_fold(folds, sizes, build({}), None, left, None)
        ranked = sorted(zip(model.stages[-1].featureImportances.toArray(), left))
        drop = {i for _, i in ranked[: min(step, len(left) - least)]}
        left = [i for i in left if i not in drop]
    best = min(range(len(rows)), key=lambda i: (math.isnan(rows[i][2]), -rows[i][2], rows[i][0]))
    return _result_rows(df.sparkSession, [(*r, i == best) for i, r in enumerate(rows)], "n_features int, features string, score double, selected boolean")
