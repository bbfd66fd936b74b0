"""Small helpers of the tests."""

from __future__ import annotations

from collections import Counter


def rows(table, *columns):
    """Rows as a multiset of tuples, over the given or all columns."""
    chosen = table.select(*columns) if columns else table
    return Counter(
        tuple(tuple(value) if isinstance(value, list) else value for value in row)
        for row in chosen.collect()
    )


def plan(table, execute=True):
    """The physical plan; after execution it is the adaptive one."""
    if execute:
        table.collect()
    return table._jdf.queryExecution().executedPlan().toString()
