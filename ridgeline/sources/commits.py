"""Partitioned Parquet tables whose live folders are listed by a manifest.

Rows of one partition (a day, say) lie in folders of their own that are written
once and never changed. Which folders count is said by the newest manifest, a
small table of (partition columns, folder, rows). A change writes new folders,
then a whole new manifest beside the old ones, and gives it the next number by
one rename that fails if the number is taken. So a reader sees the table before
a change or after it and nothing between, a run that stops half way leaves the
table as it was, and two writers cannot both win. Replacing days, compaction
and repair are all the same step.

The manifest has a row for each partition and folder. Readers and writers that
name partitions open those folders only; nothing lists the table.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ridgeline.operators.resolve import distinct_rows

#: Manifests that stay after a commit, so that readers which began with one can finish.
KEEP_VERSIONS = 10


class ConcurrentCommit(RuntimeError):
    """Another writer has changed the table since it was read."""


@dataclass(frozen=True)
class CommittedTable:
    """A table at ``path`` with rows of ``schema``, partitioned by the columns ``by``."""

    spark: SparkSession
    path: str
    schema: StructType
    by: tuple[str, ...]

    # Files -------------------------------------------------------------------

    def _hadoop(self, *parts: str):
        """(file system path, file context) of a place in the table."""
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path("/".join([self.path.rstrip("/"), *parts]))
        return place, jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Numbers of the manifests there are, ascending; a few, whatever the size of the table."""
        folder, context = self._hadoop("_commits")
        if not context.util().exists(folder):
            return []
        names = [s.getPath().getName() for s in context.util().listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    # Reading -----------------------------------------------------------------

    def manifest(self, version: int | None = None) -> DataFrame:
        """Partition columns, ``folder`` and ``n_rows`` of the live folders."""
        fields = [self.schema[name] for name in self.by]
        columns = StructType([*fields, StructField("folder", StringType()), StructField("n_rows", LongType())])
        known = self.versions()
        if version is None:
            version = known[-1] if known else None
        if version is None:
            return self.spark.createDataFrame([], columns)
        return self.spark.read.schema(columns).parquet(f"{self.path.rstrip('/')}/_commits/{version:010d}")

    def rows(self, only: DataFrame | None = None, version: int | None = None) -> DataFrame:
        """The rows of the table, or of the partitions that ``only`` (the partition columns) names."""
        listed = self.manifest(version)
        if only is not None:
            listed = self._of(listed, only)
        folders = sorted(r["folder"] for r in listed.select("folder").distinct().collect())
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path.rstrip('/')}/{f}" for f in folders])

    def _of(self, rows: DataFrame, only: DataFrame, how: str = "left_semi") -> DataFrame:
        """Rows whose partition is one of ``only`` (or none of them); a null is a partition, too."""
        names = [f"_part_{i}" for i in range(len(self.by))]
        asked = only.select(*self.by).distinct().toDF(*names)
        same = F.lit(True)
        for own, name in zip(self.by, names):
            same = same & rows[own].eqNullSafe(asked[name])
        return rows.join(asked, same, how)

    # Changing ----------------------------------------------------------------

    def _written(self, rows: DataFrame) -> DataFrame:
        """Write rows to folders of their own and list these. Values are in the files; a folder is named by a digest of them."""
        home = f"data/{uuid.uuid4().hex}"
        digest = F.substring(F.sha2(F.concat_ws(",", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in self.by]), 256), 1, 32)
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        rows = rows.withColumn("_folder", digest).hint("rebalance", "_folder")
        rows.write.partitionBy("_folder").parquet(f"{self.path.rstrip('/')}/{home}")
        stored = StructType([*self.schema.fields, StructField("_folder", StringType())])
        found = self.spark.read.schema(stored).parquet(f"{self.path.rstrip('/')}/{home}")
        return found.groupBy(*self.by, F.concat(F.lit(f"{home}/_folder="), F.col("_folder")).alias("folder")).agg(F.count(F.lit(1)).alias("n_rows"))

    def _commit(self, listed: DataFrame, base: int) -> int:
        """Make ``listed`` the manifest that follows ``base``."""
        draft, number = f".draft-{uuid.uuid4().hex}", base + 1
        listed.coalesce(1).write.parquet(f"{self.path.rstrip('/')}/_commits/{draft}")
        source, context = self._hadoop("_commits", draft)
        target, _ = self._hadoop("_commits", f"{number:010d}")
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(source, target, options)
        except Exception as refused:
            context.delete(source, True)
            if not context.util().exists(target):
                raise
            raise ConcurrentCommit(f"{self.path}: version {number} is there already") from refused
        for old in self.versions()[:-KEEP_VERSIONS]:
            context.delete(self._hadoop("_commits", f"{old:010d}")[0], True)
        return number

    def _base(self) -> int:
        known = self.versions()
        return known[-1] if known else 0

    def add(self, rows: DataFrame) -> int:
        """Add rows beside those that are stored; the version that has them. No rows, no version."""
        base = self._base()
        new = self._written(rows)
        if new.isEmpty():
            return base
        return self._commit(self.manifest(base or None).unionByName(new), base)

    def replace(self, rows: DataFrame, partitions: DataFrame | None = None) -> int:
        """Put rows in the place of all that is stored in their partitions (and in ``partitions``)."""
        base = self._base()
        new = self._written(rows)
        gone = new.select(*self.by) if partitions is None else new.select(*self.by).unionByName(partitions.select(*self.by))
        return self._commit(self._of(self.manifest(base or None), gone, "left_anti").unionByName(new), base)

    def merge(self, rows: DataFrame) -> int:
        """Add rows to their partitions without repeats; only these partitions are read and replaced."""
        base = self._base()
        rows = rows.select(*self.schema.names)
        both = distinct_rows(self.rows(rows, base or None).unionByName(rows))
        new = self._written(both)
        return self._commit(self._of(self.manifest(base or None), new, "left_anti").unionByName(new), base)

    def vacuum(self) -> int:
        """Delete data folders that no kept manifest names; how many went. Not beside a running change."""
        used = {r["folder"].split("/_folder=")[0] for v in self.versions() for r in self.manifest(v).select("folder").distinct().collect()}
        folder, context = self._hadoop("data")
        if not context.util().exists(folder):
            return 0
        stale = [s.getPath() for s in context.util().listStatus(folder) if f"data/{s.getPath().getName()}" not in used]
        for path in stale:
            context.delete(path, True)
        return len(stale)


def committed(spark: SparkSession, path: str, schema: StructType | str, by: Sequence[str]) -> CommittedTable:
    """The table at ``path``; it need not be there yet."""
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    missing = [c for c in by if c not in schema.names]
    if missing or not by:
        raise ValueError(f"partition columns {list(by)} must be columns of the schema")
    return CommittedTable(spark, path, StructType([StructField(f.name, f.dataType) for f in schema.fields]), tuple(by))


__all__ = ["CommittedTable", "ConcurrentCommit", "committed"]
