"""Customer dimension with type-2 history.

Two readings exist for the snapshot and for the change set.  The *literal* one is the default: it
keeps every quirk of the SQL this model replaces.  The *intended* one is a parameter away.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cairnlake.functions.text import address_hash, row_hash
from cairnlake.operators.ranking import first_row_per_key
from cairnlake.operators.skew import repeat_rows, split_join

TAGS = {"silver", "customer"}
KEY = ["user_id", "row_hash"]
#: Ties on the timestamp are broken by the transaction, so that reruns agree.
FIRST_ORDER = ("timestamp", "transaction_id")


def first_transaction_per_user(sales: DataFrame) -> DataFrame:
    return first_row_per_key(sales, "user_id", FIRST_ORDER)


def customer_snapshots(
    sales: DataFrame, latest_only: bool = False, until: Column | None = None
) -> DataFrame:
    """The customer as of the first transaction, if that has an address.

    The rank is taken over the whole history, before any other filter.  Literally, every row with
    a date passes the date filter.  ``latest_only`` keeps customers whose first transaction lies
    in the newest date partition; ``until`` then moves the end of the history.
    """
    history = sales if until is None else sales.where(F.col("dt") <= until)
    first = first_transaction_per_user(history).where(F.col("shipping_address").isNotNull())
    if latest_only:
        newest = history.agg(F.max("dt").alias("newest")).scalar()
        dated = first.where(F.col("dt") == newest)
    else:
        dated = first.where(F.col("dt").isNotNull())
    return dated.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("billing_country").cast("string").alias("billing_country"),
        address_hash(F.col("shipping_address")).alias("address_hash"),
        row_hash().alias("row_hash"),
        F.col("timestamp").cast("timestamp").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )


def _as_changes(snapshot: DataFrame) -> DataFrame:
    return snapshot.select(
        "user_id",
        F.col("row_hash").alias("_new_hash"),
        F.col("valid_from").alias("_new_from"),
    )


def close_out(snapshot: DataFrame, current: DataFrame, only_open: bool = False) -> DataFrame:
    """Stored versions whose customer changed, closed at the start of the new version.

    Literally, versions closed earlier are closed again; ``only_open`` leaves them alone.
    """
    stored = current.where(F.col("valid_to").isNull()) if only_open else current
    return (
        split_join(stored, _as_changes(snapshot), "user_id")
        .where(F.col("_new_hash") != F.col("row_hash"))
        .select(
            "user_id",
            "billing_country",
            "address_hash",
            "row_hash",
            "valid_from",
            F.col("_new_from").alias("valid_to"),
        )
    )


def new_rows(snapshot: DataFrame, current: DataFrame) -> DataFrame:
    """Every snapshot row, once per stored version of its user and once when there is none.

    This is a left join that takes no column from its right side, so the versions are counted per
    user first (combined in each task) and the rows repeated by that count.
    """
    versions = current.groupBy("user_id").agg(F.count(F.lit(1)).alias("_versions"))
    counted = snapshot.join(versions, "user_id", "left").withColumn(
        "_versions", F.coalesce(F.col("_versions"), F.lit(1))
    )
    return repeat_rows(counted, "_versions", ("user_id",)).select(*snapshot.columns)


def delta(snapshot: DataFrame, current: DataFrame, only_open: bool = False) -> DataFrame:
    """Closed versions and new rows together, repetitions included."""
    return close_out(snapshot, current, only_open).union(new_rows(snapshot, current))


def merge(snapshot: DataFrame, current: DataFrame, only_open: bool = False) -> DataFrame:
    """The dimension after the change set, without repetitions, is upserted on user and row hash.

    Building the change set and upserting it would shuffle the stored versions three times.  Seen
    as one step, every snapshot row ends up in the result, a stored version of the same key gives
    way to it, and other stored versions of its user get their end: one join and a union.
    The snapshot has one row per user, the stored table one per user and row hash.
    """
    matched = split_join(current, _as_changes(snapshot), "user_id", "left")
    replaced = F.coalesce(F.col("row_hash") == F.col("_new_hash"), F.lit(False))
    changed = F.col("row_hash") != F.col("_new_hash")
    if only_open:
        changed = changed & F.col("valid_to").isNull()
    kept = matched.where(~replaced).select(
        "user_id",
        "billing_country",
        "address_hash",
        "row_hash",
        "valid_from",
        F.when(changed, F.col("_new_from")).otherwise(F.col("valid_to")).alias("valid_to"),
    )
    return kept.unionByName(snapshot)


def touched_dates(snapshot: DataFrame, current: DataFrame, only_open: bool = False) -> DataFrame:
    """``date``: the dates of ``valid_from`` on which :func:`merge` adds, drops or changes a row.

    Partitions of all other dates stay as they are.  There are as many dates as the history has days.
    """
    fields = [c for c in snapshot.columns if c != "user_id"]
    new = snapshot.select("user_id", *(F.col(c).alias(f"_new_{c}") for c in fields))
    matched = split_join(current, new, "user_id")
    same_key = F.col("row_hash") == F.col("_new_row_hash")
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in fields))
    ended = ~F.col("valid_to").eqNullSafe(F.col("_new_valid_from"))
    if only_open:
        ended = ended & F.col("valid_to").isNull()
    both = F.array(F.to_date("valid_from"), F.to_date("_new_valid_from"))
    changed = matched.select(
        F.explode(F.when(same_key & ~same, both).when(~same_key & ended, F.slice(both, 1, 1))).alias("date")
    )
    added = snapshot.join(current.select(*KEY), KEY, "left_anti").select(F.to_date("valid_from").alias("date"))
    return changed.unionByName(added).distinct()


def current_customers(customers: DataFrame) -> DataFrame:
    """Open versions only."""
    return customers.where(F.col("valid_to").isNull())


def open_versions_per_user(customers: DataFrame) -> DataFrame:
    """Users with several open versions; each of them repeats in the gold summary."""
    return (
        current_customers(customers)
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )
