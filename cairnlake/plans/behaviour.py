"""Gold: purchase and browsing behaviour per user."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cairnlake.operators.skew import split_join
from cairnlake.plans.customers import current_customers

TAGS = {"gold", "user_behavior"}


def user_purchase_patterns(sales: DataFrame, money_scale: int | None = None) -> DataFrame:
    """Orders, spend and products per user.

    ``average_order_value`` is the mean per line item, as its predecessor computed it.  Sums of
    doubles depend on the order of the rows in their last digits; with ``money_scale`` every amount
    is first rounded to that many decimals and summed exactly, so that reruns agree.

    The two distinct counts are expanded to (user, transaction) and (user, product) groups, which
    are combined in each task and shuffled on both columns, so a busy user is spread out.
    """
    amount = F.col("total_amount")
    if money_scale is None:
        spend, average = F.sum(amount), F.avg(amount)
    else:
        exact = F.sum(amount.cast(f"decimal(28,{money_scale})")).cast("double")
        spend, average = exact, exact / F.count(amount)
    return sales.groupBy("user_id").agg(
        F.count_distinct("transaction_id").alias("total_orders"),
        spend.alias("total_lifetime_spend"),
        average.alias("average_order_value"),
        F.max("transaction_timestamp").alias("last_purchase_date"),
        F.count_distinct("product_id").alias("distinct_products_purchased"),
    )


def browsed_categories(clickstream: DataFrame) -> DataFrame:
    """The sorted distinct categories a user viewed; NULL when none of the views had one.

    Views are reduced to distinct (user, category) pairs first, on both columns, so that neither a
    busy user nor a popular category meets in one task; only the pairs are then collected.
    """
    return (
        clickstream.where(F.col("event_type") == "page_view")
        .select("user_id", F.col("properties.category").alias("category"))
        .distinct()
        .groupBy("user_id")
        .agg(F.array_sort(F.collect_list("category")).alias("found"))
        .select("user_id", F.when(F.size("found") > 0, F.col("found")).alias("browsed_categories"))
    )


def user_behavior_summary(
    sales: DataFrame,
    customers: DataFrame,
    clickstream: DataFrame,
    money_scale: int | None = None,
) -> DataFrame:
    """Purchases of every user with an open customer version, with the categories they browsed.

    Both aggregates leave their rows partitioned by user, so neither their join nor that with the customers shuffles them
    again.  ``customers`` should be a stored table: its user column is read once more to find users with
    very many versions.  A user with several open versions appears once for each; the versions of a user with very many of them
    stay where they are and meet a broadcast of that user's row.
    """
    purchases = user_purchase_patterns(sales, money_scale)
    behaviour = purchases.join(browsed_categories(clickstream), "user_id", "left")
    countries = current_customers(customers).select("user_id", "billing_country")
    return split_join(countries, behaviour, "user_id").select(
        "user_id",
        "billing_country",
        "total_orders",
        "total_lifetime_spend",
        "average_order_value",
        "last_purchase_date",
        "distinct_products_purchased",
        "browsed_categories",
    )
