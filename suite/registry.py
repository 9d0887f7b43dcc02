"""Where query modules register their jobs and SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from suite.views import with_views

Job = Callable[[SparkSession, str], DataFrame]
JOBS: dict[str, Job] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = "") -> Callable[[Job], Job]:
    """Register a job; ``views`` names the derived tables its SQL uses."""

    def add(job: Job) -> Job:
        if name in JOBS:
            raise ValueError(f"query {name} is registered twice")
        JOBS[name] = job
        if sql is not None:
            SQL[name] = with_views(sql, views.split())
        return job

    return add
