"""Row numbers and the first row of every key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def number_rows(table: DataFrame, key: str, order: tuple[str, ...], name: str = "rownum") -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY key ORDER BY order)`` as a further column."""
    return table.withColumn(name, F.row_number().over(Window.partitionBy(key).orderBy(*order)))


def first_row_per_key(table: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """The first row of every key that is not NULL.

    Spark turns the rank filter into a group limit ahead of the shuffle: a task sends at most one
    row per key, so a key with a third of the table costs as little as any other.  NULL keys go
    first, or they would form one large group.

    The limit sorts all rows of a task, and a join of narrow columns makes many wide rows in one.  So rows are
    dealt out before it, on the key and its first order column: adaptive execution makes partitions of
    its advisory size by the bytes of these rows, whatever number of tasks the table came from.
    """
    keyed = table.where(F.col(key).isNotNull()).hint("rebalance", F.col(order[0]), F.col(key))
    return number_rows(keyed, key, order).where(F.col("rownum") == 1)
