"""One row for each key, and distinct rows, in two phases.

Copies are few in tables that are filled hour by hour, and full rows are wide. So
the keys that have several rows are found first, on the key columns alone: a
hash aggregate with a partial sum on the map side. They are written, which
gives the planner their real size. Then rows of all other keys pass as they are,
without a shuffle while the list is small, and only the rows of listed keys are
grouped. Where every key has copies the list is as long as the table, joins are
sorted ones and the second phase is the plain grouping.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.session import cut_lineage

_KEY = "_resolved"


def _split(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """(rows of keys that have one row, rows of keys with several or None without such keys); null keys are keys."""
    repeated = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(_KEY)).filter(F.col(_KEY) > 1).drop(_KEY)
    repeated = cut_lineage(repeated, "repeated").toDF(*[f"{_KEY}_{i}" for i in range(len(keys))])
    if repeated.isEmpty():
        return rows, None
    same = F.lit(True)
    for i, key in enumerate(keys):
        same = same & rows[key].eqNullSafe(repeated[f"{_KEY}_{i}"])
    return rows.join(repeated, same, "left_anti"), rows.join(repeated, same, "left_semi")


def first_of_key(rows: DataFrame, keys: Sequence[str], rank: Column) -> DataFrame:
    """The row of each key with the lowest rank; equal ranks are settled by the remaining columns in order.

    Runs the first phase while the plan is built.
    """
    single, several = _split(rows, keys)
    if several is None:
        return rows
    rest = [c for c in rows.columns if c not in keys]
    best = F.min(F.struct(rank.alias("_rank"), *rest)).alias("_row")
    chosen = several.groupBy(*keys).agg(best).select(*keys, *[f"_row.{c}" for c in rest])
    return single.unionByName(chosen)


def distinct_rows(rows: DataFrame) -> DataFrame:
    """The rows without copies: only rows that share a 64-bit hash with another are compared as a whole.

    Runs the first phase while the plan is built.
    """
    marked = rows.withColumn(_KEY + "_hash", F.xxhash64(*rows.columns))
    single, several = _split(marked, [_KEY + "_hash"])
    if several is None:
        return rows
    return single.drop(_KEY + "_hash").unionByName(several.drop(_KEY + "_hash").distinct())


def new_keys(rows: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key no stored row has; null keys are keys. The stored side reads its key columns only."""
    stored = stored.select(*keys).toDF(*[f"{_KEY}_{i}" for i in range(len(keys))])
    same = F.lit(True)
    for i, key in enumerate(keys):
        same = same & rows[key].eqNullSafe(stored[f"{_KEY}_{i}"])
    return rows.join(stored, same, "left_anti")
