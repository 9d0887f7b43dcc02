"""Places of rows inside their group, without a task that sees a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridgeline.llm.common import write_step


def ranked(rows: DataFrame, group: str, order: list[Column], name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` written in order of (group, order), and the stretches of groups in the written parts.

    The rows get ``at`` (an id that ascends within a part) and ``part``. The
    stretches have part, group, ``first`` (the least ``at``), ``before`` (rows
    of the group in parts ahead) and ``size`` (rows of the group). The place of
    a row in its group is ``at - first + before``. Rows are dealt by ranges of
    the whole order, so a group may be spread over any number of tasks; the
    window over the stretches of a group has one row for each of these. Nulls
    come first. Rows that are equal in all of ``order`` have any order among
    themselves.
    """
    rows = write_step(rows, f"{name}_in")  # ranges are sampled first, which would make every row twice
    by = [F.col(group).asc_nulls_first(), *order]
    at = F.monotonically_increasing_id()
    rows = write_step(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", at), name)
    rows = rows.withColumn("part", F.shiftright("at", 33))
    spans = rows.groupBy("part", group).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    own = Window.partitionBy(group)
    ahead = F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    spans = spans.select("part", group, "first", ahead.alias("before"), F.sum("n").over(own).alias("size"))
    return rows, write_step(spans, f"{name}_spans")


def placed(rows: DataFrame, spans: DataFrame, group: str) -> DataFrame:
    """``rows`` of ``ranked`` with ``pos``, their place in the group from 0, and the other columns of ``spans``."""
    # A key holds the rows of one written part at most, however large the group is.
    spans = spans.withColumnsRenamed({"part": "_part", group: "_group"})
    near = (F.col("part") == F.col("_part")) & F.col(group).eqNullSafe(F.col("_group"))
    return rows.join(spans, near).withColumn("pos", F.col("at") - F.col("first") + F.col("before")).drop("_part", "_group", "at", "part", "first", "before")
