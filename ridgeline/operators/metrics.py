"""Evaluation of ordinal levels.

Every metric is read off the counts of (actual, predicted) pairs. That is one
pass with map-side counting; the rest works on as many rows as there are pairs
of levels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.functions import cumulative_targets


def pair_counts(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted", by: Sequence[str] = ()
) -> DataFrame:
    """Rows per (actual, predicted) pair, optionally per group."""
    return df.groupBy(*by, F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def scores(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """M1: accuracy, balanced accuracy and mean absolute error.

    Balanced accuracy is the mean recall over the levels that occur as actual
    ones. An empty table gives nulls.
    """
    n, hit = F.col("n"), F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    per_level = pairs.groupBy(*by, "actual").agg(
        F.sum(n).alias("rows"), F.sum(hit).alias("hits"),
        F.sum(n * F.abs(F.col("actual") - F.col("predicted"))).alias("error"),
    )
    total = F.sum("rows")
    return per_level.groupBy(*by).agg(
        F.try_divide(F.sum("hits"), total).alias("accuracy"),
        F.avg(F.col("hits") / F.col("rows")).alias("balanced_accuracy"),
        F.try_divide(F.sum("error"), total).alias("mae"),
    )


def evaluate(df: DataFrame, actual: str = "actual", predicted: str = "predicted", by: Sequence[str] = ()) -> DataFrame:
    """M1 over rows."""
    return scores(pair_counts(df, actual, predicted, by), by)


def confusion_matrix(pairs: DataFrame, normalise: bool = False) -> DataFrame:
    """M2: all pairs of levels that occur, zero where there is no row.

    ``normalise`` divides by the rows of the actual level. Ordered with the
    highest actual level first.
    """
    levels = F.array_sort(F.collect_set("level"))
    both = pairs.select(F.explode(F.array("actual", "predicted")).alias("level"))
    # At most one entry per level, so the array is as short as the level scale.
    axis = both.agg(levels.alias("axis")).select(F.explode("axis").alias("actual"), "axis")
    grid = axis.select("actual", F.explode("axis").alias("predicted"))
    full = grid.join(pairs, ["actual", "predicted"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
    if normalise:
        rows = F.sum("n").over(Window.partitionBy("actual"))
        full = full.withColumn("share", F.coalesce(F.try_divide(F.col("n"), rows), F.lit(0.0)))
    return full.orderBy(F.desc("actual"), F.asc("predicted"))


def class_report(pairs: DataFrame) -> DataFrame:
    """M3: precision, recall, F1 and support per level; zero where undefined."""
    as_actual = pairs.select(
        F.col("actual").alias("level"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("picked"),
        F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hits"),
    )
    as_predicted = pairs.select(
        F.col("predicted").alias("level"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("picked"),
        F.lit(0).cast("bigint").alias("hits"),
    )
    sums = as_actual.unionByName(as_predicted).groupBy("level").agg(
        F.sum("support").alias("support"), F.sum("picked").alias("picked"), F.sum("hits").alias("hits")
    )

    def ratio(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    return sums.select(
        "level",
        ratio(F.col("hits"), F.col("picked")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hits"), F.col("picked") + F.col("support")).alias("f1"),
        "support",
    )


def constant_baseline(df: DataFrame, actual: str = "actual", level: int = 2, by: Sequence[str] = ()) -> DataFrame:
    """M6: scores of always predicting one level."""
    return evaluate(df.withColumn("_constant", F.lit(level)), actual, "_constant", by)


def class_weights(df: DataFrame, label: str, boosts: dict | None = None) -> DataFrame:
    """M7: balanced weight n / (k * n_class) per class, with manual factors."""
    counts = df.groupBy(F.col(label)).agg(F.count(F.lit(1)).alias("n_class"))
    all_rows = Window.partitionBy(F.lit(1))
    weighted = counts.withColumn(
        "weight", F.sum("n_class").over(all_rows) / (F.count(F.lit(1)).over(all_rows) * F.col("n_class"))
    )
    for value, factor in (boosts or {}).items():
        weighted = weighted.withColumn(
            "weight", F.when(F.col(label) == value, F.col("weight") * factor).otherwise(F.col("weight"))
        )
    return weighted


def threshold_scores(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted", thresholds: Sequence[int] = (1, 2, 3)
) -> DataFrame:
    """Scores of "at most k" for every threshold, from one pair count."""
    pairs = pair_counts(df, actual, predicted)
    spread = pairs.withColumn("threshold", F.explode(F.array(*[F.lit(k) for k in thresholds])))
    binary = spread.select(
        "threshold",
        (F.col("actual") <= F.col("threshold")).cast("int").alias("actual"),
        (F.col("predicted") <= F.col("threshold")).cast("int").alias("predicted"),
        "n",
    ).groupBy("threshold", "actual", "predicted").agg(F.sum("n").alias("n"))
    return scores(binary, ["threshold"])


def with_targets(df: DataFrame, level: str, thresholds: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """F19 as columns of a table."""
    return df.select("*", *cumulative_targets(F.col(level), thresholds))
