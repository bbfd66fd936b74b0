"""Choosing the newest partition."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cairnlake.storage import Storage


def newest_partition(table: DataFrame, column: str = "dt", until: Column | None = None) -> DataFrame:
    """The rows of the largest partition value, optionally the largest up to ``until``.

    The value is a one-row aggregate used as a scalar subquery, which a partitioned file scan turns
    into a partition filter.
    """
    candidates = table if until is None else table.where(F.col(column) <= until)
    newest = candidates.agg(F.max(column).alias("newest")).scalar()
    return table.where(F.col(column) == newest)


def newest_directories(spark: SparkSession, path: str, column: str) -> Iterator[str]:
    """The ``column=value`` folders of a path, newest value first, from one directory listing."""
    names = Storage(spark, path).names(path, folders=True)
    dated = sorted((name for name in names if name.startswith(f"{column}=")), reverse=True)
    for name in dated:
        if not name.endswith("__HIVE_DEFAULT_PARTITION__"):
            yield f"{path.rstrip('/')}/{name}"
