"""Column selection and validation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions import sentinel_to_null
from ridgeline.schemas import HOURLY_COLUMNS, HOURLY_KEYS, NOT_FEATURES, SENTINEL, VARIABLE_PATTERNS


def keep_columns(df: DataFrame, columns: Sequence[str] = HOURLY_COLUMNS) -> DataFrame:
    """The expected columns in their order; absent ones are left out."""
    return df.select(*[c for c in columns if c in df.columns])


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by map; names that do not occur are ignored."""
    return df.withColumnsRenamed(dict(names))


def split_columns(
    df: DataFrame, keys: Iterable[str], label: str | None = None, never: Iterable[str] = NOT_FEATURES
) -> tuple[list[str], list[str]]:
    """(feature columns, key columns) of one frame.

    Features stay beside their keys, so nothing has to be aligned by row later.
    """
    keys = set(keys) | ({label} if label else set())
    features = [c for c in df.columns if c not in keys and c not in set(never)]
    return features, [c for c in df.columns if c in keys]


def measure_columns(df: DataFrame, keys: Iterable[str] = HOURLY_KEYS) -> list[str]:
    """Numeric columns that are not keys."""
    keys = set(keys)
    return [n for n, kind in df.dtypes if n not in keys and kind in ("double", "float")]


def drop_all_sentinel(df: DataFrame, columns: Sequence[str] | None = None, sentinel: float = SENTINEL) -> DataFrame:
    """Drop columns that hold the sentinel in every row. Runs one aggregate.

    A null counts as not sentinel. Columns of an empty table are all dropped.
    """
    columns = list(columns or measure_columns(df, ()))
    if not columns:
        return df
    row = df.agg(
        *[F.min(F.coalesce(F.col(c) == sentinel, F.lit(False))).alias(c) for c in columns]
    ).first()
    return df.drop(*[c for c in columns if row[c] is None or row[c]])


def pick_variables(
    df: DataFrame, values: Sequence[str], keys: Sequence[str],
    patterns: Sequence[str] = VARIABLE_PATTERNS, name_col: str = "variable", value_col: str = "value",
) -> DataFrame:
    """Choose parameters of a long table by pattern and make them columns.

    ``values`` names the columns wanted, so the job needs no extra pass.
    """
    matches = reduce(or_, [F.col(name_col).rlike(p) for p in patterns])
    return (
        df.filter(matches & F.col(name_col).isin(list(values))).groupBy(*keys).pivot(name_col, list(values)).agg(F.first(value_col, ignorenulls=True))
    )


def require_columns(df: DataFrame, required: Sequence[str] = HOURLY_KEYS, non_empty: bool = True) -> DataFrame:
    """Raise unless the columns exist and there is a row."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise KeyError(f"missing required columns: {missing}")
    if non_empty and df.isEmpty():
        raise ValueError("the table is empty")
    return df


def null_report(df: DataFrame, expected: Sequence[str] = HOURLY_COLUMNS) -> DataFrame:
    """One row per expected column: is it present, how many nulls."""
    counts = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(c in df.columns).alias("present"),
            (F.count_if(F.col(c).isNull()) if c in df.columns else F.count(F.lit(1))).alias("nulls"),
        )
        for c in expected
    ]
    return df.agg(F.array(*counts).alias("r")).select(F.inline("r"))


def any_null(columns: Sequence[str]) -> Column:
    """True if one of the columns is null."""
    return reduce(or_, [F.col(c).isNull() for c in columns])


def split_incomplete(df: DataFrame, expected: Sequence[str] = HOURLY_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """(complete rows, rejected rows). The reject names its null columns.

    An expected column the table lacks rejects every row, as one null does.
    """
    for c in expected:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("double"))
    bad = any_null(expected)
    reasons = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in expected]))
    return df.filter(~bad), df.filter(bad).withColumn("missing", F.array_join(reasons, ","))


def series_violations(
    df: DataFrame, missing: DataFrame, last: Column, keys: Sequence[str] = ("point_id",), time_col: str = "time"
) -> DataFrame:
    """Points whose series lacks hours or does not end at ``last``.

    ``missing`` is the table of absent hours of the same points.
    """
    keys = list(keys)
    ends = df.groupBy(*keys).agg(F.max(time_col).alias("last_time"))
    gaps = missing.groupBy(*keys).agg(F.count(F.lit(1)).alias("missing_hours"))
    return (
        ends.join(gaps, keys, "left")
        .withColumn("missing_hours", F.coalesce("missing_hours", F.lit(0).cast("bigint")))
        .filter((F.col("missing_hours") > 0) | (F.col("last_time") != last))
    )


def split_intervals(df: DataFrame, start: str = "start", end: str = "end") -> tuple[DataFrame, DataFrame]:
    """(usable intervals, rejected ones with a reason)."""
    reason = (
        F.when(F.col(start).isNull() | F.col(end).isNull(), "not a time")
        .when(F.col(start) > F.col(end), "start after end")
    )
    marked = df.withColumn("reason", reason)
    return marked.filter(F.col("reason").isNull()).drop("reason"), marked.filter(F.col("reason").isNotNull())


def nulls_for_sentinel(df: DataFrame, columns: Sequence[str] | None = None, sentinel: float = SENTINEL) -> DataFrame:
    """Sentinel to null over the double columns."""
    columns = list(columns or measure_columns(df, ()))
    return df.withColumns({c: sentinel_to_null(F.col(c), sentinel) for c in columns})
