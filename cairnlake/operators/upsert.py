"""Keyed upsert without a transactional table format."""

from __future__ import annotations

from pyspark.sql import DataFrame


def keyed_upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The target after an upsert: source rows replace target rows of the same key or are added.

    The source holds each key once.  A key with a NULL part matches nothing, so such a source row
    is always added.  Only the key columns of the source take part in the shuffle of the match.
    """
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.select(*target.columns).unionByName(source)
