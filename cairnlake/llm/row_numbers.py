"""Row numbers over a whole table, without bringing it into one task.

Rows are dealt to ranges of a sort key.  Each range has its count; the counts before a range are its offset; inside a
range a window counts on.  Only the counts of the ranges meet in one task.  The number of ranges grows with the
rows, so that a range stays small.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Cut points of the sort key by quantile, and rows a range is to hold; ranges between cut points are cut evenly on.
CUTS = 255
ROWS_PER_RANGE = 100_000


@dataclass(frozen=True)
class Ranges:
    """Ascending cut points, the smallest and largest key, and parts that each piece between them is cut into."""

    bounds: list[int]
    least: int
    most: int
    parts: int

    def number(self, key: str) -> Column:
        """The range of a key, in the order of keys."""

        def between(low: int, high: int) -> Column:
            if low == high:
                return self._part(key, low)
            middle = (low + high) // 2
            return F.when(F.col(key) < F.lit(self.bounds[middle]), between(low, middle)).otherwise(
                between(middle + 1, high)
            )

        return between(0, len(self.bounds))

    def _part(self, key: str, piece: int) -> Column:
        if self.parts == 1:
            return F.lit(piece).cast("long")
        edges = [self.least, *self.bounds, self.most]
        low, width = float(edges[piece]), float(edges[piece + 1] - edges[piece] + 1)
        part = F.floor((F.col(key).cast("double") - low) / width * self.parts)
        return F.lit(piece * self.parts).cast("long") + F.least(F.greatest(part, F.lit(0)), F.lit(self.parts - 1))


def ranges_of(table: DataFrame, key: str, rows_per_range: int = ROWS_PER_RANGE) -> Ranges:
    """Ranges of a numeric key that is not null, from a quantile sketch.  Any ranges give right results."""
    shares = [i / (CUTS + 1) for i in range(1, CUTS + 1)]
    row = table.agg(
        F.percentile_approx(key, shares, 10 * CUTS).alias("cuts"),
        F.min(key).alias("least"),
        F.max(key).alias("most"),
        F.count(F.lit(1)).alias("rows"),
    ).first()
    parts = max(1, -(-row["rows"] // ((CUTS + 1) * rows_per_range)))
    return Ranges(sorted(set(row["cuts"] or [])), row["least"] or 0, row["most"] or 0, parts)


def with_row_number(table: DataFrame, key: str, ties: list[str], name: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add gapless numbers from 0 in ascending order of (key, ties).  The key is a long and not null.

    Rows equal in all of these are numbered in any order.  The table is read three times, so store it before if it
    is costly; its rows are shuffled once.
    """
    ranged = table.withColumn("_range", ranges_of(table, key, rows_per_range).number(key))
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_count"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_range").orderBy(key, *ties)
    return (
        ranged.withColumn("_place", F.row_number().over(inside) - 1)
        .join(offsets, "_range")
        .withColumn(name, F.col("_offset") + F.col("_place"))
        .drop("_range", "_place", "_offset")
    )
