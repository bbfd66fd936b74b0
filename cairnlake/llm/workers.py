"""Running Arrow batches in Python workers."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if _ROOT not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, _ROOT]))


def map_batches(
    table: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with the package importable in the workers."""
    importable(table.sparkSession)
    return table.mapInArrow(function, schema)


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted batches cut at group borders: tables of whole groups, with the bounds of the groups in each.

    Only the group that a batch ends in is held back for the next one.
    """
    held: list[pa.RecordBatch] = []

    def cut(table: pa.Table, last: bool) -> tuple[pa.Table, np.ndarray, pa.Table]:
        changed = np.zeros(max(table.num_rows - 1, 0), dtype=bool)
        for key in keys:
            values = table.column(key).to_numpy()
            changed |= values[1:] != values[:-1]
        bounds = np.r_[0, np.flatnonzero(changed) + 1]
        if last:
            return table, np.r_[bounds, table.num_rows], table.slice(table.num_rows)
        return table.slice(0, bounds[-1]), bounds, table.slice(bounds[-1])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        first, last = held[0], batch
        if len(held) > 1 and all(
            first.column(key)[0].as_py() == last.column(key)[last.num_rows - 1].as_py() for key in keys
        ):
            continue
        ready, bounds, rest = cut(pa.Table.from_batches(held), False)
        held = rest.to_batches()
        if ready.num_rows:
            yield ready, bounds
    if held:
        ready, bounds, _ = cut(pa.Table.from_batches(held), True)
        yield ready, bounds
