"""An ordinal classifier as a pipeline stage, with storage.

One binary model for each threshold answers "at most k"; class probabilities are
the differences of neighbouring thresholds. The stage takes any MLlib
classifier with probabilities, fits in a ``Pipeline``, in searches and in
``save`` and ``load`` like a built-in one. Forests are grown over cells of bins
(``forest``) where these are fewer than the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasParallelism, HasPredictionCol, HasProbabilityCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions import lookup, most_likely_class
from ridgeline.plans.forest import LEAST_ROWS, edges_of, fit_on_cells, in_bins, quantiles, suits
from ridgeline.session import cut_lineage

#: Levels that an ordinal label may have, at most: one model for each but the last.
MOST_LEVELS = 100


class _OrdinalParams(HasLabelCol, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasParallelism):
    classifier: Param[Any] = Param(Params._dummy(), "classifier", "binary classifier with probabilities, fitted for each threshold")
    levels: Param[int] = Param(Params._dummy(), "levels", "number of levels; 0: one more than the highest label", typeConverter=TypeConverters.toInt)

    def __init__(self, *args: Any):
        super().__init__(*args)
        self._setDefault(labelCol="label", featuresCol="features", predictionCol="prediction", probabilityCol="probability", parallelism=1, levels=0)

    def getClassifier(self) -> Estimator:
        return self.getOrDefault(self.classifier)

    def _plain(self) -> dict[str, Any]:
        """Parameters that are written with the metadata."""
        return {p.name: v for p, v in self.extractParamMap().items() if p.name != "classifier"}


class OrdinalClassifier(Estimator, _OrdinalParams, MLReadable, MLWritable):
    """Labels are 0, 1, 2, ...; each threshold's two sides weigh the same."""

    @keyword_only
    def __init__(self, *, classifier=None, labelCol=None, featuresCol=None, predictionCol=None, probabilityCol=None, levels=None, parallelism=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> OrdinalModel:
        label = F.col(self.getLabelCol()).cast("int")
        # A row for each level, however long the table is.
        found = dataset.groupBy(label.alias("level")).agg(F.count(F.lit(1)).alias("n")).filter("level is not null").limit(MOST_LEVELS + 1).collect()
        if len(found) > MOST_LEVELS:
            raise ValueError(f"{self.getLabelCol()} has more than {MOST_LEVELS} levels")
        counts = {r["level"]: r["n"] for r in found}
        if not counts or min(counts) < 0:
            raise ValueError(f"{self.getLabelCol()} must hold levels from 0")
        top, total = (self.getOrDefault(self.levels) or max(counts) + 1) - 1, sum(counts.values())
        target, weight = f"{self.getLabelCol()}_at_most", f"{self.getLabelCol()}_weight"
        points = quantiles(dataset.filter(label.isNotNull()), self.getFeaturesCol(), label, len(counts)) if suits(self.getClassifier(), dataset, self.getFeaturesCol()) else None
        between: dict[int, list[list[float]]] = {}

        def one(k: int):
            low = sum(n for level, n in counts.items() if level <= k)
            share = {1: total / (2 * low) if low else 1.0, 0: total / (2 * (total - low)) if total > low else 1.0}
            side = (label <= k).cast("int")
            rows = dataset.filter(label.isNotNull()).withColumns({target: side.cast("double"), weight: lookup(side, share, F.lit(1.0))})
            names = {"labelCol": target, "featuresCol": self.getFeaturesCol(), "weightCol": weight}
            learner = self.getClassifier()
            learner = learner.copy({learner.getParam(p): v for p, v in names.items() if learner.hasParam(p)})
            if points and 0 < low < total:
                edges = edges_of(points, {level: n * share[level <= k] for level, n in counts.items()}, learner.getMaxBins())
                if model := fit_on_cells(learner, rows, edges, [share[0], share[1]], total):
                    between[k] = edges
                    return model
            return learner.fit(rows)

        pool = ThreadPool(max(1, min(self.getParallelism(), top)))
        try:
            models = pool.map(inheritable_thread_target(dataset.sparkSession)(one), range(top))
        finally:
            pool.close()
        model = self._copyValues(OrdinalModel(models=models))
        if models and len(between) == len(models):
            model._set(edges=[sorted({e for own in f for e in own}) for f in zip(*between.values())])
        return model

    def copy(self, extra=None) -> OrdinalClassifier:
        twin = Params.copy(self, extra)
        if self.isDefined(self.classifier):
            twin._set(classifier=twin.getClassifier().copy(extra))
        return twin

    def write(self) -> MLWriter:
        return _Writer(self, [("classifier", self.getClassifier())])

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class OrdinalModel(Model, _OrdinalParams, MLReadable, MLWritable):
    """The models of the thresholds 0, 1, 2, ... in order; with none of them all rows have level 0."""

    edges: Param[Any] = Param(Params._dummy(), "edges", "for each feature the values at which its models may split; empty: not known")

    def __init__(self, models: Sequence[Model] = ()):
        super().__init__()
        self._setDefault(edges=[])
        self.models = list(models)

    def transform_cells(self, dataset: DataFrame) -> DataFrame:
        """``transform`` that scores one row of each cell between ``edges`` for all rows in it: no model tells them apart.

        Runs a job; where cells are about as many as rows, each row is scored.
        """
        edges = self.getOrDefault(self.edges)
        if not edges or dataset.isStreaming:
            return self.transform(dataset)
        names, n = [f"_{self.uid}_{i}" for i in range(len(edges))], f"_{self.uid}_n"
        rows = in_bins(dataset, self.getFeaturesCol(), edges, names)
        cells = cut_lineage(rows.groupBy(*names).agg(F.first(self.getFeaturesCol()).alias(self.getFeaturesCol()), F.count(F.lit(1)).alias(n)), "cells")
        found = cells.agg(F.count(F.lit(1)).alias("cells"), F.sum(n).alias("rows")).first()
        if not found["rows"] or found["cells"] > found["rows"] // LEAST_ROWS:
            return self.transform(dataset)
        out = [self.getProbabilityCol(), self.getPredictionCol()]
        cores = dataset.sparkSession.sparkContext.defaultParallelism
        scored = cut_lineage(self.transform(cells.repartition(cores)).select(*names, *out), "scored")
        kept = [c for c in dataset.columns if c not in out]
        return rows.select(*kept, *names).join(scored, names).select(*kept, *out)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        columns, rows, taken = dataset.columns, dataset, set(dataset.columns)
        below: list[Column] = []
        names = []
        for k, model in enumerate(self.models):
            name = f"at_most_{k}"
            while name in taken:
                name = "_" + name
            taken.add(name)
            names.append(name)
            outputs = {"predictionCol": f"{name}_prediction", "probabilityCol": f"{name}_probability", "rawPredictionCol": f"{name}_raw"}
            model = model.copy({model.getParam(p): v for p, v in outputs.items()})
            probability = F.coalesce(F.get(vector_to_array(outputs["probabilityCol"]), F.lit(1)), F.lit(0.0))
            rows = model.transform(rows).withColumn(name, probability).drop(*outputs.values())
            below.append(F.col(name))
        steps = [*below, F.lit(1.0)]
        classes = F.array(steps[0], *[b - a for a, b in zip(steps, steps[1:])])
        out = {self.getProbabilityCol(): array_to_vector(classes), self.getPredictionCol(): most_likely_class(classes, first=0).cast("double")}
        kept = [c for c in columns if c not in out]
        return rows.withColumns({f"{names[0] if names else 'only'}_{k}_out": v for k, v in out.items()}).select(
            *kept, *[F.col(f"{names[0] if names else 'only'}_{k}_out").alias(k) for k in out]
        )

    @property
    def featureImportances(self):
        """Mean importance over the thresholds, as of the models."""
        from pyspark.ml.linalg import Vectors

        return Vectors.dense(sum(m.featureImportances.toArray() for m in self.models) / len(self.models))

    def copy(self, extra=None) -> OrdinalModel:
        twin = Params.copy(self, extra)
        twin.models = [m.copy(extra) for m in self.models]
        return twin

    def write(self) -> MLWriter:
        return _Writer(self, [(f"threshold-{k}", m) for k, m in enumerate(self.models)])

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, stage: Any, parts: list[tuple[str, Any]]):
        super().__init__()
        self.stage, self.parts = stage, parts

    def saveImpl(self, path: str) -> None:
        extra = {"parts": [name for name, _ in self.parts]}
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata=extra, paramMap=self.stage._plain())
        for name, part in self.parts:
            part.write().session(self.sparkSession).save(f"{path}/{name}")


class _Reader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> Any:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        parts = {name: DefaultParamsReader.loadParamsInstance(f"{path}/{name}", spark) for name in metadata["parts"]}
        stage = self.kind(models=list(parts.values())) if self.kind is OrdinalModel else self.kind(**parts)
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata, skipParams=["classifier"])
        return stage


