"""Sales fact: one row per item of a completed transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cairnlake.functions.json_text import explode_records

TAGS = {"silver"}
ITEM_MEMBERS = ("product_id", "quantity", "price")
REQUIRED = ["transaction_id", "user_id", "product_id", "transaction_timestamp"]


def flatten_items(sales: DataFrame) -> DataFrame:
    """One row per element of the ``items`` array of a completed transaction with a user.

    A transaction whose items are empty, missing or not an array gives no row.  The filters run
    before any JSON is parsed, and each text is parsed once for all three members.
    """
    completed = sales.where(F.col("user_id").isNotNull() & (F.col("status") == "completed")).select(
        "transaction_id",
        "user_id",
        F.col("timestamp").alias("transaction_timestamp"),
        F.col("status").alias("transaction_status"),
        "items",
    )
    return explode_records(completed, "items", ITEM_MEMBERS)


def f_sales(sales: DataFrame, products: DataFrame, lenient: bool = False) -> DataFrame:
    """Items of known products with typed quantity, price and line total.

    A quantity or price that is not a number stops the query; ``lenient`` makes it NULL instead.
    Only the key of the product table takes part.  The join strategy is left to adaptive execution:
    it broadcasts the keys if their measured size allows, else it shuffles both sides and splits
    the partition of a product that sells too well.
    """
    cast = (lambda c, t: c.try_cast(t)) if lenient else (lambda c, t: c.cast(t))
    quantity = cast(F.col("quantity"), "bigint")
    price = cast(F.col("price"), "double")
    return (
        flatten_items(sales)
        .join(products.select("product_id"), "product_id")
        .select(
            "transaction_id",
            "user_id",
            "product_id",
            "transaction_timestamp",
            quantity.alias("quantity"),
            price.alias("price"),
            (quantity * price).alias("total_amount"),
        )
    )
