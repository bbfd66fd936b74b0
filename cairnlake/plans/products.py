"""Product dimension: the newest catalog date with its types applied."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cairnlake.operators.partitions import newest_partition

TAGS = {"silver"}


def apply_types(catalog: DataFrame) -> DataFrame:
    """The columns of the dimension; ``subcategory`` and ``dt`` are left behind."""
    return catalog.select(
        "product_id",
        "name",
        "category",
        F.col("price").cast("double").alias("price"),
        F.col("cost").cast("double").alias("cost"),
        F.col("stock_quantity").cast("bigint").alias("stock_quantity"),
        "supplier_id",
        "attributes",
        "last_updated",
        "tags",
    )


def d_products(catalog: DataFrame) -> DataFrame:
    return apply_types(newest_partition(catalog, "dt"))
