"""Equi-joins and row repetition that stay even when one key holds a large share of the rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

#: A key is heavy from this share of all rows on, or from so many mean partitions if that is less.
HEAVY_SHARE = 0.005
HEAVY_PARTITIONS = 2
#: Counters of the frequency sketch for each heavy key there can be; its error is below one row in all counters.
COUNTERS_PER_KEY, MOST_COUNTERS = 50, 1_000_000
#: Rows one task writes for a single repeated row before the repetition is split up.
REPEAT_CHUNK = 65_536


def heavy_share(partitions: int) -> float:
    """The share of all rows from which a key is too much for one of so many partitions."""
    return min(HEAVY_SHARE, HEAVY_PARTITIONS / partitions)


def heavy_keys(table: DataFrame, key: str, share: float = HEAVY_SHARE) -> DataFrame:
    """The keys with at least ``share`` of the rows, as ``(key, share)``: never over ``1 / share`` rows.

    One pass over the key column with a frequency sketch per task; only the sketches travel.  The
    answer steers how rows are spread, never which rows are kept, so an estimate is good enough.
    """
    most = math.ceil(1 / share)
    counters = min(MOST_COUNTERS, most * COUNTERS_PER_KEY)
    found = (
        table.select(F.col(key).alias("item"))
        .where(F.col("item").isNotNull())
        .agg(
            F.expr(f"approx_top_k(item, {most}, {counters})").alias("top"),
            F.count(F.lit(1)).alias("total"),
        )
        .select(F.explode("top").alias("top"), "total")
    )
    return found.select(
        F.col("top.item").alias(key), (F.col("top.count") / F.col("total")).alias("_share")
    ).where(F.col("_share") >= share)


def split_join(
    probe: DataFrame, build: DataFrame, key: str, how: str = "inner", share: float | None = None
) -> DataFrame:
    """Join ``probe`` to ``build`` on ``key`` (inner, or left keeping every probe row).

    The probe side may be skewed; ``build`` has a few rows per key at most, as an aggregate by the key has.  The probe rows of
    normal keys go to where the build rows of their key are; an aggregate or ranking by the key is not shuffled again.  Those of
    heavy keys stay where they are and meet a broadcast of the build rows of these keys only.  So do rows without a
    key, which match nothing.

    Two things are broadcast: the heavy keys, one for each part of ``share`` (half as many as there are partitions, or 200),
    and their build rows.  The probe side is read three times, its key column alone once; store it if it is costly.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"split_join supports inner and left, not {how}")
    partitions = int(probe.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = F.broadcast(heavy_keys(probe, key, share or heavy_share(partitions)).select(F.col(key).alias("_heavy")))
    listed = F.col(key) == F.col("_heavy")
    has_key = F.col(key).isNotNull()
    normal = probe.where(has_key).join(heavy, listed, "left_anti").join(build, key, how)
    # An inner join is not pushed below an aggregate, so both branches share the build side's shuffle.
    few = F.broadcast(build.join(heavy, listed).drop("_heavy"))
    joined = normal.unionByName(probe.join(heavy, listed, "left_semi").join(few, key, how))
    if how == "left":
        nothing = {f.name: F.lit(None).cast(f.dataType) for f in build.schema.fields if f.name != key}
        joined = joined.unionByName(probe.where(~has_key).withColumns(nothing) if nothing else probe.where(~has_key))
    return joined


def repeat_rows(table: DataFrame, times: str, keys: tuple[str, ...]) -> DataFrame:
    """Every row as often as its ``times`` column says; the column is dropped.

    A long repetition is cut into chunks that are spread over the cluster before they are written out.
    """
    chunks = F.sequence(F.lit(0), F.floor((F.col(times) - 1) / REPEAT_CHUNK))
    size = F.least(F.lit(REPEAT_CHUNK), F.col(times) - F.col("_chunk") * REPEAT_CHUNK)
    return (
        table.where(F.col(times) > 0)
        .withColumn("_chunk", F.explode(chunks))
        .repartition(*keys, "_chunk")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), size)))
        .drop(times, "_chunk", "_copy")
    )
