"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cairnlake.session import scratch_path, without_shuffle_files
from cairnlake.storage import Storage

_paths = "_cairnlake_scratch_path"


def stored(table: DataFrame, label: str) -> DataFrame:
    """The table written to the shared folder and read back: it is computed once, and its lineage ends there.

    Parquet files in the shared folder outlive any executor.  A table of counts that is joined back to the rows it counts
    is stored for another reason too: adaptive execution splits a hot key's partition only where both sides of the join come
    straight from a shuffle, not where one is aggregated in the join's own stage.  The write's shuffle files go when it has ended.
    """
    path = scratch_path(table.sparkSession, label)
    with without_shuffle_files(table.sparkSession):
        table.write.parquet(path)
    read = table.sparkSession.read.schema(table.schema).parquet(path)
    setattr(read, _paths, path)
    return read


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that :func:`stored` returned; nothing that is still to be computed may read them."""
    for table in tables:
        Storage(table.sparkSession, path := getattr(table, _paths)).delete(path)
