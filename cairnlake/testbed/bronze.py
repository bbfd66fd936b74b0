"""Bronze inputs derived from the supplied tables with Spark.

Every row comes from a bounded number of source rows: nothing is collected per order, user or day.
``oracle.py`` states the same inputs in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cairnlake import schemas
from cairnlake.functions import topics
from cairnlake.storage import Storage

PROJECT = "demo"
OWNER = "demo"
#: Bytes that are no UTF-8: sequences cut short, a byte that only goes on, an overlong sign, half of a pair.
BROKEN_BYTES = ("C3", "E282", "80FF", "F09F98", "C0AF", "EDA080")


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def bytes_of(table: DataFrame) -> int:
    """Size of the files that a table is read from, as the planner knows it."""
    return int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _of_part(key: Column, part: tuple[int, int]) -> Column:
    number, parts = part
    return F.pmod(F.xxhash64(key), F.lit(parts)) == number


def _item(product: Column, quantity: Column, price: Column) -> Column:
    return F.struct(
        product.cast("string").alias("product_id"),
        quantity.cast("bigint").alias("quantity"),
        price.alias("price"),
    )


def _instant(column: str) -> Column:
    return F.col(column).cast("timestamp")


def sales_transactions(spark: SparkSession, folder: str, part: tuple[int, int] = (0, 1)) -> DataFrame:
    """One transaction per order line, and one without items per order that has no line.

    The two cases are joined apart: adaptive execution can split a long order in an inner join, but
    not on the optional side of an outer join.  ``part`` is a number and how many parts there are: each order is in one of
    them with all its lines, orders without a key are in the same.
    """
    orders = load(spark, folder, "orders")
    lines = load(spark, folder, "lineitem")
    if part[1] > 1:
        orders, lines = orders.where(_of_part(F.col("o_orderkey"), part)), lines.where(_of_part(F.col("l_orderkey"), part))
    customers = load(spark, folder, "customer")
    nations = load(spark, folder, "nation")
    main = _item(F.col("l_partkey"), F.col("l_quantity"), F.col("l_extendedprice"))
    extra = _item(F.col("l_suppkey"), F.col("l_linenumber"), F.col("l_linenumber") + F.lit(0.25))
    items = (
        F.when(F.col("l_orderkey").isNull(), F.lit(None))
        .when(F.col("o_orderkey") % 101 == 0, F.lit("[]"))
        .when(F.col("o_orderkey") % 103 == 0, F.lit("no list"))
        .when(F.col("l_linenumber") % 3 == 0, F.to_json(F.array(main, extra)))
        .otherwise(F.to_json(F.array(main)))
    )
    status = (
        F.when(F.col("o_orderstatus") == "F", "completed")
        .when(F.col("o_orderstatus") == "O", "pending")
        .otherwise("refunded")
    )
    same_order = F.col("o_orderkey") == F.col("l_orderkey")
    with_lines = lines.join(orders, same_order)
    without = orders.join(lines.select("l_orderkey").distinct(), same_order, "left_anti")
    return (
        with_lines.unionByName(without, allowMissingColumns=True)
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat_ws("-", "o_orderkey", F.coalesce("l_linenumber", F.lit(0))).alias("transaction_id"),
            F.when(F.col("o_orderkey") % 97 != 0, F.col("o_custkey").cast("string")).alias("user_id"),
            _instant("o_orderdate").alias("timestamp"),
            F.coalesce("l_extendedprice", "o_totalprice").alias("amount"),
            F.lit("USD").alias("currency"),
            F.col("o_orderpriority").alias("payment_method"),
            status.alias("status"),
            items.alias("items"),
            F.when(
                F.col("o_orderkey") % 89 != 0,
                F.concat(F.lit(" "), (F.col("o_orderkey") % 3).cast("string"), F.lit(" Main St ")),
            ).alias("shipping_address"),
            F.col("n_name").alias("billing_country"),
            F.trunc("o_orderdate", "month").alias("dt"),
        )
    )


def product_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Every part on two dates, the later one dearer and without every fiftieth part."""
    early, late = F.lit("2024-01-01").cast("date"), F.lit("2024-01-02").cast("date")
    dated = (
        load(spark, folder, "part")
        .withColumn("dt", F.explode(F.array(early, late)))
        .where((F.col("dt") == early) | (F.col("p_partkey") % 50 != 0))
        .withColumn(
            "price",
            F.when(F.col("dt") == late, F.col("p_retailprice")).otherwise(
                F.round(F.col("p_retailprice") * 0.9, 2)
            ),
        )
    )
    attributes = F.to_json(F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")))
    return dated.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        "price",
        F.round(F.col("price") * 0.6, 2).alias("cost"),
        F.col("p_size").cast("bigint").alias("stock_quantity"),
        (F.col("p_partkey") % 100).cast("string").alias("supplier_id"),
        F.col("dt").cast("timestamp").alias("last_updated"),
        F.parse_json(attributes).alias("attributes"),
        F.split("p_name", " ").alias("tags"),
        "dt",
    )


def clickstream_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the category of the part they point at; none for every tenth user."""
    viewed = F.get_json_object("props", "$.k")
    parts = load(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("part"), F.col("p_type").alias("part_type")
    )
    properties = F.struct(
        viewed.alias("product_id"),
        F.when(F.col("user_id") % 10 != 0, F.col("part_type")).alias("category"),
        F.col("value").alias("price"),
        (F.col("event_id") % 7).cast("bigint").alias("quantity"),
        (F.col("value") * 2).alias("cart_value"),
        (F.col("event_id") % 11).cast("bigint").alias("items_count"),
        F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("find "), viewed)).alias("search_query"),
        (F.col("user_id") % 13).cast("bigint").alias("results_count"),
    )
    event_type = F.when(F.col("event_type") == "view", "page_view").otherwise(F.col("event_type"))
    return (
        load(spark, folder, "events")
        .join(parts, viewed == F.col("part"), "left")
        .select(
            F.col("event_id").cast("string").alias("event_id"),
            F.col("user_id").cast("string").alias("user_id"),
            F.concat_ws("-", "user_id", F.to_date("ts")).alias("session_id"),
            _instant("ts").alias("timestamp"),
            event_type.alias("event_type"),
            F.concat(F.lit("/products/"), viewed).alias("page_url"),
            F.concat(F.lit("agent/"), F.col("event_id") % 5).alias("user_agent"),
            F.concat_ws(".", F.lit("10.0.0"), F.col("user_id") % 256).alias("ip_address"),
            F.when(F.col("event_id") % 2 == 0, "/home").alias("referrer"),
            F.when(F.col("event_id") % 4 == 0, "phone").otherwise("desk, top").alias("device_type"),
            F.concat(F.lit("C"), F.col("user_id") % 9).alias("country"),
            properties.alias("properties"),
            F.to_date("ts").alias("dt"),
        )
    )


def support_tickets(spark: SparkSession, folder: str) -> DataFrame:
    """A ticket for every message of every conversation."""
    opened = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.col("conv_id") % 28)
    return load(spark, folder, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("ticket_id"),
        (F.col("conv_id") % 150).cast("string").alias("user_id"),
        opened.alias("created_at"),
        F.col("role").alias("category"),
        F.when(F.col("conv_id") % 2 == 0, "high").otherwise("low").alias("priority"),
        F.lit("open").alias("status"),
        F.concat(F.lit("Turn "), F.col("turn").cast("string")).alias("subject"),
        F.col("text").alias("description"),
        ((F.col("conv_id") % 21 - 10) / F.lit(10.0)).alias("sentiment_score"),
        F.when(F.col("role") != "user", F.lit("agent")).alias("agent_id"),
        (F.col("turn") / F.lit(4.0)).alias("resolution_time_hours"),
        (F.col("conv_id") % 5 + 1).alias("satisfaction_score"),
        F.to_date(opened).alias("dt"),
    )


def stored_customers(snapshot: DataFrame) -> DataFrame:
    """A stand-in for the stored dimension: users with an even number, half of them changed since.

    Every eighth user also has a version that was closed before.
    """
    user = F.col("user_id").cast("bigint")
    even = snapshot.where(user % 2 == 0)
    versions = even.withColumn(
        "row_hash", F.when(user % 4 == 0, F.md5("row_hash")).otherwise(F.col("row_hash"))
    )
    closed = (
        snapshot.where(user % 8 == 0)
        .withColumn("row_hash", F.md5("address_hash"))
        .withColumn("valid_to", F.col("valid_from"))
    )
    return versions.unionByName(closed).select(*schemas.CUSTOMERS.fieldNames())


def topic_of(number: Column) -> Column:
    """Four configured topics and one that is not, by ``number % 5``."""
    names = [*topics.RAW_TABLES, "unmapped-topic"]
    choice = F.array(*(F.lit(topics.topic_path(PROJECT, name)) for name in names))
    return F.element_at(choice, (number % len(names) + 1).cast("int"))


def messages(events: DataFrame) -> DataFrame:
    """Events (a table or a stream) as messages: JSON, CSV text, broken UTF-8 and NDJSON by turns."""
    number = F.col("event_id")
    viewed = F.get_json_object("props", "$.k")
    click = F.to_json(
        F.struct(
            number.cast("string").alias("event_id"),
            F.col("user_id").cast("string").alias("user_id"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
            F.col("event_type"),
            F.struct(viewed.alias("product_id"), F.col("value").alias("price")).alias("properties"),
        )
    )
    data = (
        F.when(number % 4 == 0, click.cast("binary"))
        .when(number % 4 == 1, F.concat_ws(",", number, "user_id", "event_type").cast("binary"))
        .when(number % 4 == 2, F.get(F.array(*(F.unhex(F.lit(b)) for b in BROKEN_BYTES)), (F.floor(number / 4) % len(BROKEN_BYTES)).cast("int")))
        .otherwise(F.concat_ws("\n", "props", "props").cast("binary"))
    )
    attributes = F.when(
        number % 3 == 0, F.create_map(F.lit("kind"), F.col("event_type"))
    ).otherwise(F.expr("cast(map() as map<string, string>)"))
    return events.select(
        number.cast("string").alias("message_id"),
        _instant("ts").alias("publish_time"),
        topic_of(number).alias("source_topic"),
        data.alias("data"),
        attributes.alias("attributes"),
    )


def event_files(spark: SparkSession, folder: str) -> tuple[str, str | None]:
    """Folder and file pattern to stream the events table from, be it a file or a folder of files."""
    path = f"{folder}/events.parquet"
    if Storage(spark, path).is_folder(path):
        return path, None
    return folder, "events.parquet"


def message_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The messages as a stream over the files of the events table."""
    path, pattern = event_files(spark, folder)
    reader = spark.readStream.schema(load(spark, folder, "events").schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return messages(reader.parquet(path))
