"""Registration of queries with their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.frames import Frames, frames_for

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}
FUNCTIONS: dict[str, Callable[[Frames], DataFrame]] = {}


def query(name: str, check: str | None = None):
    """Register ``fn(frames)`` under ``name``; ``check`` is its DuckDB query."""

    def wrap(fn):
        FUNCTIONS[name] = fn
        QUERIES[name] = lambda spark, sf_dir: fn(frames_for(spark, sf_dir))
        if check is not None:
            CHECKS[name] = check
        return fn

    return wrap
