"""The registered queries: every operator on inputs that Spark derives from the supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cairnlake import schemas
from cairnlake.functions import messages as msg, text, topics
from cairnlake.operators import quality
from cairnlake.operators.partitions import newest_partition
from cairnlake.operators.upsert import keyed_upsert
from cairnlake.plans import behaviour, customers, products, sales
from cairnlake.plans.batch import BatchJob, Bronze
from cairnlake.plans.typed_payload import typed_payload
from cairnlake.session import configure, scratch_path, without_shuffle_files
from cairnlake.sinks.versioned import VersionedTable, with_date, write_table
from cairnlake.sources import documents, tables
from cairnlake.sources.messages import file_messages, merge_topics, of_topic
from cairnlake.streaming import landing, raw_ingest
from cairnlake.testbed import bronze

#: Amounts are whole cents; summing them exactly makes the totals independent of row order.
CENTS = 2
#: Records in one file that is to travel as a message.
RECORDS_PER_MESSAGE = 10_000
#: Bytes of order lines whose sales are joined and written as text at once, unless that makes more than MOST_PARTS: each part
#: reads the tables anew, which takes little beside joining and writing them.
PART_BYTES = 64 << 20
MOST_PARTS = 8

Query = Callable[[SparkSession, str], DataFrame]


def present(table: DataFrame) -> DataFrame:
    """Output form of a query: instants without a zone, text arrays as one text, JSON opened up."""
    columns = []
    for field in table.schema.fields:
        column = F.col(field.name)
        if field.dataType == T.TimestampType():
            columns.append(column.cast("timestamp_ntz").alias(field.name))
        elif isinstance(field.dataType, T.ArrayType):
            columns.append(F.array_join(column, "|").alias(field.name))
        elif field.name == "attributes" and field.dataType == T.VariantType():
            columns.append(F.variant_get(column, "$.brand", "string").alias("brand"))
            columns.append(F.variant_get(column, "$.size", "bigint").alias("size"))
        elif field.name == "properties":
            columns += [column[name].alias(name) for name in field.dataType.fieldNames()]
        else:
            columns.append(column)
    return table.select(*columns)


def _stored(spark: SparkSession, table: DataFrame, label: str) -> DataFrame:
    """The table written to the shared folder and read back, as a model's input is."""
    path = scratch_path(spark, label)
    write_table(table, path)
    return spark.read.parquet(path)


def write_text_table(table: DataFrame, path: str, file_format: str, mode: str = "errorifexists") -> None:
    """Write a bronze table as date-partitioned text files; CSV, which takes eight times the bytes of its tables, as gzip.

    Files are as large as a partition of the shuffle makes them, so that none has to be split.
    """
    writer = (
        table.hint("rebalance", F.col("dt"))
        .write.mode(mode)
        .partitionBy("dt")
        .option("timestampFormat", tables.INSTANT_FORMAT)
    )
    if file_format == "csv":
        writer = (
            writer.option("header", True)
            .option("compression", "gzip")
            .option("zlib.compress.level", "BEST_SPEED")
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .options(**tables.CSV_QUOTING)
        )
    writer.format(file_format).save(path)


# --- sources ---------------------------------------------------------------------------------


def scan_clickstream(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "clickstream")
    write_text_table(bronze.clickstream_events(spark, folder), path, "json")
    return tables.scan_clickstream(spark, path)


def scan_support_tickets(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "tickets")
    write_text_table(bronze.support_tickets(spark, folder), path, "json")
    return tables.scan_support_tickets(spark, path)


def _catalog_files(spark: SparkSession, folder: str) -> str:
    path = scratch_path(spark, "catalog")
    write_text_table(bronze.product_catalog(spark, folder), path, "json")
    return path


def scan_product_catalog(spark: SparkSession, folder: str) -> DataFrame:
    return tables.scan_product_catalog(spark, _catalog_files(spark, folder))


def scan_newest_catalog(spark: SparkSession, folder: str) -> DataFrame:
    newest = tables.scan_newest_catalog(spark, _catalog_files(spark, folder))
    return newest.select("product_id", "name", "price", "attributes", "tags")


def scan_sales_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "sales")
    parts = min(MOST_PARTS, 1 + bronze.bytes_of(bronze.load(spark, folder, "lineitem")) // PART_BYTES)
    # The shuffles of all parts at once would take six times the bytes of the tables.
    with without_shuffle_files(spark):
        for number in range(parts):
            write_text_table(bronze.sales_transactions(spark, folder, (number, parts)), path, "csv", "append")
    return tables.scan_sales(spark, path)


def _ticket_arrays(spark: SparkSession, folder: str) -> str:
    """Tickets as files that hold one JSON array each, of a limited number of records.

    Records are numbered where they are read, so a chunk never exceeds its size.
    """
    path = scratch_path(spark, "ticket-arrays")
    tickets = bronze.support_tickets(spark, folder).drop("dt")
    record = F.to_json(F.struct(*tickets.columns), {"timestampFormat": tables.INSTANT_FORMAT})
    chunk = F.floor(F.monotonically_increasing_id() / RECORDS_PER_MESSAGE)
    (
        tickets.select(chunk.alias("chunk"), record.alias("record"))
        .groupBy("chunk")
        .agg(F.array_join(F.collect_list("record"), ",").alias("records"))
        .select(F.concat(F.lit("["), "records", F.lit("]")).alias("value"))
        .write.option("maxRecordsPerFile", 1)
        .text(path)
    )
    return path


def json_array_to_ndjson(spark: SparkSession, folder: str) -> DataFrame:
    schema = T.StructType([f for f in schemas.CUSTOMER_SUPPORT_TICKETS if f.name != "dt"])
    target = scratch_path(spark, "ticket-lines")
    documents.json_array_to_ndjson(spark, _ticket_arrays(spark, folder), target)
    return tables.scan_ndjson(spark, target, schema)


def whole_file_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Records per topic of files that travel as one message each."""
    path = scratch_path(spark, "source-files")
    (
        bronze.sales_transactions(spark, folder)
        .write.option("header", True)
        .option("maxRecordsPerFile", RECORDS_PER_MESSAGE)
        .options(**tables.CSV_QUOTING)
        .csv(f"{path}/sales-transactions")
    )
    (
        bronze.support_tickets(spark, folder)
        .write.option("maxRecordsPerFile", RECORDS_PER_MESSAGE)
        .json(f"{path}/customer-support-topic")
    )
    slug = F.element_at(F.split("path", "/"), -2)
    topic = F.concat(F.lit(topics.topic_path(bronze.PROJECT, "")), slug)
    messages = documents.whole_file_messages(spark, path, topic, "part-*")
    lines = F.regexp_count(F.col("data").cast("string"), F.lit("\n"))
    headers = F.when(F.col("source_topic").endswith("sales-transactions"), 1).otherwise(0)
    return messages.groupBy("source_topic").agg(F.sum(lines - headers).alias("records"))


def named_sources(spark: SparkSession, folder: str) -> DataFrame:
    """SQL over a bronze table that is known by its name."""
    tables.register_sources(spark, {"product_catalog": _catalog_files(spark, folder)})
    return spark.sql(
        """
        SELECT category, count(*) AS n_products, max(price) AS dearest
        FROM product_catalog
        WHERE dt = (SELECT max(dt) FROM product_catalog)
        GROUP BY category
        """
    )


# --- messages and streams --------------------------------------------------------------------


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    return bronze.messages(bronze.load(spark, folder, "events"))


def _kind_and_content() -> list[Column]:
    """What became of a message: its kind, and the text, base64 or event number inside."""
    payload = F.col("payload")
    raw, b64, event = (
        F.get_json_object(payload, f"$.{name}") for name in ("raw", "raw_b64", "event_id")
    )
    kind = F.when(raw.isNotNull(), "raw").when(b64.isNotNull(), "raw_b64").otherwise("json")
    return [kind.alias("kind"), F.coalesce(raw, b64, event).alias("content")]


def parse_message(spark: SparkSession, folder: str) -> DataFrame:
    parsed = raw_ingest.parse_message(_messages(spark, folder))
    return parsed.select("message_id", *_kind_and_content())


def add_metadata(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_ingest.raw_rows(_messages(spark, folder))
    return raw.select(
        "message_id",
        msg.wire_time(F.col("publish_time")).alias("publish_time"),
        "source_topic",
        "attributes",
    )


def topic_routing(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_ingest.raw_rows(_messages(spark, folder))
    routed = raw_ingest.routed(raw, topics.raw_table_map(bronze.PROJECT))
    return routed.select("message_id", "target_table")


def landing_path(spark: SparkSession, folder: str) -> DataFrame:
    routes = topics.landing_routes(bronze.PROJECT, bronze.OWNER)
    names = landing.landed_names(_messages(spark, folder), topics.route_table(spark, routes))
    return names.select("message_id", "bucket", "object_name")


def stream_raw_ingest(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "raw")
    stream = raw_ingest.start_raw_ingest(
        bronze.message_stream(spark, folder),
        checkpoint=f"{path}/checkpoint",
        tables=topics.raw_table_map(bronze.PROJECT),
        path=f"{path}/tables",
    )
    stream.awaitTermination()
    return spark.read.parquet(f"{path}/tables").select(
        "message_id",
        "publish_time",
        "source_topic",
        *_kind_and_content(),
        "attributes",
        "target_table",
    )


def stream_multi_topic(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "topics")
    streams = {
        topic: of_topic(bronze.message_stream(spark, folder), topic).drop("source_topic")
        for topic in topics.raw_table_map(bronze.PROJECT)
    }
    stream = raw_ingest.start_raw_ingest(
        merge_topics(streams),
        checkpoint=f"{path}/checkpoint",
        tables=topics.raw_table_map(bronze.PROJECT),
        path=f"{path}/tables",
    )
    stream.awaitTermination()
    return spark.read.parquet(f"{path}/tables").select("message_id", "source_topic", "publish_time")


def _landed_lines(spark: SparkSession, root: str, routes: dict[str, topics.LandingRoute]) -> DataFrame:
    """Every landed line with its topic and date; bytes that are no text in base64."""
    line = F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(
        F.concat(F.lit("base64:"), msg.base64_text(F.col("value").cast("binary")))
    )
    landed = [
        spark.read.schema("value string, dt date")
        .text(landing.landing_folder(root, topic, route))
        .select(F.lit(topic.split("/")[-1]).alias("topic_slug"), "dt", line.alias("line"))
        for topic, route in routes.items()
    ]
    return reduce(DataFrame.unionByName, landed)


def stream_landing(spark: SparkSession, folder: str) -> DataFrame:
    """The lines per topic and publish date, read back from the landed files."""
    path = scratch_path(spark, "landing")
    routes = topics.landing_routes(bronze.PROJECT, bronze.OWNER)
    landing.finish(
        landing.start_landing(
            bronze.message_stream(spark, folder), f"{path}/files", f"{path}/checkpoint", routes
        )
    )
    return _landed_lines(spark, f"{path}/files", routes)


def stream_redelivery(spark: SparkSession, folder: str) -> DataFrame:
    """Landing that breaks off after the second batch has its files, and goes on from the checkpoint: every message once."""
    path = scratch_path(spark, "redelivery")
    _messages(spark, folder).repartition(4, "message_id").write.parquet(f"{path}/in")
    routes = topics.landing_routes(bronze.PROJECT, bronze.OWNER)
    place = (f"{path}/files", f"{path}/checkpoint", routes)
    messages = file_messages(spark, f"{path}/in", max_files_per_trigger=1)
    write = landing.batch_writer(spark, *place)

    def breaks_off(batch: DataFrame, number: int) -> None:
        write(batch, number)
        if number == 1:
            raise RuntimeError("broken off")

    stream = (
        messages.writeStream.foreachBatch(breaks_off)
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    try:
        stream.awaitTermination()
    except StreamingQueryException as error:
        if "broken off" not in str(error):
            raise
    landing.finish(landing.start_landing(messages, *place))
    return _landed_lines(spark, f"{path}/files", routes)


def typed(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_ingest.raw_rows(_messages(spark, folder))
    return typed_payload(raw, schemas.CLICKSTREAM_EVENTS).select(
        "message_id",
        F.col("record.event_id").alias("event_id"),
        F.col("record.event_type").alias("event_type"),
        F.col("record.timestamp").alias("event_time"),
        F.col("record.properties.product_id").alias("product_id"),
        F.col("record.properties.price").alias("price"),
        "broken",
    )


def _from_whole_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The typed records of files that travel as one message each, and the text of what is none."""
    messages = documents.whole_file_messages(spark, path, F.lit("files"), "part-*")
    found = typed_payload(raw_ingest.raw_rows(messages), schema)
    return found.select("record.*", "broken")


def _write_lines(table: DataFrame, path: str) -> None:
    writer = table.drop("dt").write.option("maxRecordsPerFile", RECORDS_PER_MESSAGE)
    writer.option("timestampFormat", tables.INSTANT_FORMAT).json(path)


def typed_payload_clickstream(spark: SparkSession, folder: str) -> DataFrame:
    """Events from files of NDJSON."""
    path = scratch_path(spark, "event-files")
    _write_lines(bronze.clickstream_events(spark, folder), path)
    return _from_whole_files(spark, path, schemas.CLICKSTREAM_EVENTS)


def typed_payload_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Products of both dates from files of NDJSON."""
    path = scratch_path(spark, "product-files")
    _write_lines(bronze.product_catalog(spark, folder), path)
    return _from_whole_files(spark, path, schemas.PRODUCT_CATALOG)


def typed_payload_tickets(spark: SparkSession, folder: str) -> DataFrame:
    """Tickets from files of one JSON array each."""
    return _from_whole_files(spark, _ticket_arrays(spark, folder), schemas.CUSTOMER_SUPPORT_TICKETS)


def typed_payload_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions from CSV files, with line breaks and quotes inside their addresses."""
    path = scratch_path(spark, "sales-files")
    address = F.replace(F.replace("shipping_address", F.lit(" Main"), F.lit('\n"Main"')), F.lit("St"), F.lit("St,\n\n"))
    (
        bronze.sales_transactions(spark, folder)
        .drop("dt")
        .withColumn("shipping_address", address)
        .write.option("header", True)
        .option("maxRecordsPerFile", RECORDS_PER_MESSAGE)
        .option("timestampFormat", tables.INSTANT_FORMAT)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .options(**tables.CSV_QUOTING)
        .csv(path)
    )
    return _from_whole_files(spark, path, schemas.SALES_TRANSACTIONS)


# --- silver ----------------------------------------------------------------------------------


def latest_catalog_partition(spark: SparkSession, folder: str) -> DataFrame:
    newest = newest_partition(bronze.product_catalog(spark, folder))
    return newest.select("product_id", "price", "dt")


def d_products(spark: SparkSession, folder: str) -> DataFrame:
    return products.d_products(bronze.product_catalog(spark, folder))


def flatten_items(spark: SparkSession, folder: str) -> DataFrame:
    return sales.flatten_items(bronze.sales_transactions(spark, folder))


def f_sales(spark: SparkSession, folder: str) -> DataFrame:
    return sales.f_sales(bronze.sales_transactions(spark, folder), d_products(spark, folder))


def address_hash(spark: SparkSession, folder: str) -> DataFrame:
    return bronze.sales_transactions(spark, folder).select(
        "transaction_id", text.address_hash(F.col("shipping_address")).alias("address_hash")
    )


def row_hash(spark: SparkSession, folder: str) -> DataFrame:
    return bronze.sales_transactions(spark, folder).select(
        "transaction_id", text.row_hash().alias("row_hash")
    )


def first_transaction_per_user(spark: SparkSession, folder: str) -> DataFrame:
    first = customers.first_transaction_per_user(bronze.sales_transactions(spark, folder))
    return first.select(
        "transaction_id", "user_id", "timestamp", "status", "shipping_address", "billing_country", "dt"
    )


def customer_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return customers.customer_snapshots(bronze.sales_transactions(spark, folder))


def customer_snapshots_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The intended reading, on a history in which every third customer came with the last load."""
    history = bronze.sales_transactions(spark, folder)
    last = history.agg(F.max("dt").alias("day")).scalar()
    loaded = F.when(F.col("user_id").cast("bigint") % 3 == 0, last).otherwise(F.col("dt"))
    return customers.customer_snapshots(history.withColumn("dt", loaded), latest_only=True)


def _snapshot_and_stored(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    snapshot = _stored(spark, customer_snapshots(spark, folder), "snapshot")
    return snapshot, _stored(spark, bronze.stored_customers(snapshot), "customers")


def _customer_query(model: Callable[..., DataFrame], **options) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return model(*_snapshot_and_stored(spark, folder), **options)

    return run


def upsert_delta(spark: SparkSession, folder: str) -> DataFrame:
    snapshot, stored = _snapshot_and_stored(spark, folder)
    changes = customers.delta(snapshot, stored).distinct()
    return keyed_upsert(stored, changes, customers.KEY)


def scd2_partitioned_write(spark: SparkSession, folder: str) -> DataFrame:
    """The merged dimension as a new version of the table that it was read from."""
    snapshot = _stored(spark, customer_snapshots(spark, folder), "snapshot")
    table = VersionedTable(spark, scratch_path(spark, "d_customers"))
    table.replace(bronze.stored_customers(snapshot))
    merged = customers.merge(snapshot, table.read(schemas.CUSTOMERS))
    return table.replace(
        with_date(merged, "valid_from", "valid_from_date"), "valid_from_date", ("billing_country",)
    )


def current_customers(spark: SparkSession, folder: str) -> DataFrame:
    _, stored = _snapshot_and_stored(spark, folder)
    return customers.current_customers(stored)


def open_versions_per_user(spark: SparkSession, folder: str) -> DataFrame:
    snapshot, stored = _snapshot_and_stored(spark, folder)
    return customers.open_versions_per_user(stored.unionByName(snapshot))


# --- gold ------------------------------------------------------------------------------------


def user_purchase_patterns_float(spark: SparkSession, folder: str) -> DataFrame:
    """Sums and means of doubles as they are, to as many digits as do not depend on the order of rows."""
    found = behaviour.user_purchase_patterns(f_sales(spark, folder))
    return found.withColumns(
        {
            "total_lifetime_spend": F.round("total_lifetime_spend", 2),
            "average_order_value": F.col("average_order_value").cast("float").cast("double"),
        }
    )


def user_purchase_patterns(spark: SparkSession, folder: str) -> DataFrame:
    return behaviour.user_purchase_patterns(f_sales(spark, folder), CENTS)


def browsed_categories(spark: SparkSession, folder: str) -> DataFrame:
    return behaviour.browsed_categories(bronze.clickstream_events(spark, folder))


def user_behavior_summary(spark: SparkSession, folder: str) -> DataFrame:
    transactions = bronze.sales_transactions(spark, folder)
    return behaviour.user_behavior_summary(
        sales.f_sales(transactions, d_products(spark, folder)),
        # Stored, as the dimension is: its user column is read on its own to look for heavy users.
        _stored(spark, customers.customer_snapshots(transactions), "snapshot"),
        bronze.clickstream_events(spark, folder),
        CENTS,
    )


def batch_job(spark: SparkSession, folder: str) -> DataFrame:
    """One run of the whole job, from bronze inputs to the stored summary."""
    job = BatchJob(
        spark,
        Bronze(
            bronze.sales_transactions(spark, folder),
            bronze.product_catalog(spark, folder),
            bronze.clickstream_events(spark, folder),
        ),
        scratch_path(spark, "job"),
        CENTS,
    )
    job.run()
    return job.table("user_behavior_summary").read()


def named_models(spark: SparkSession, folder: str) -> DataFrame:
    """SQL over the stored models of a job by their names."""
    job = BatchJob(
        spark,
        Bronze(
            bronze.sales_transactions(spark, folder),
            bronze.product_catalog(spark, folder),
            bronze.clickstream_events(spark, folder),
        ),
        scratch_path(spark, "named-job"),
        CENTS,
    )
    job.run({"silver"})
    job.register_models()
    return spark.sql(
        """
        SELECT category, count(*) AS n_sold, max(transaction_timestamp) AS last_sold
        FROM f_sales JOIN d_products USING (product_id) GROUP BY category
        """
    )


def batch_job_second_run(spark: SparkSession, folder: str) -> DataFrame:
    """The customer history after a run on the even orders and an incremental one on all of them."""
    history, root = bronze.sales_transactions(spark, folder), scratch_path(spark, "job-runs")
    even = F.split_part("transaction_id", F.lit("-"), F.lit(1)).cast("bigint") % 2 == 0
    for transactions in (history.where(even), history):
        job = BatchJob(
            spark,
            Bronze(transactions, bronze.product_catalog(spark, folder), bronze.clickstream_events(spark, folder)),
            root,
            CENTS,
        )
        job.run({"customer"})
    return job.table("d_customers").read()


# --- assertions ------------------------------------------------------------------------------


def assert_unique_customers(spark: SparkSession, folder: str) -> DataFrame:
    """On the change set, which repeats a key per stored version."""
    changes = customers.delta(*_snapshot_and_stored(spark, folder))
    return quality.unique_key(changes, customers.KEY, "customers_unique")


def assert_unique_products(spark: SparkSession, folder: str) -> DataFrame:
    """On the catalog of both dates."""
    return quality.unique_key(
        bronze.product_catalog(spark, folder), ["product_id"], "products_unique"
    )


def _emptied(column: str, condition: Column) -> Column:
    return F.when(~condition, F.col(column))


def assert_nonnull_products(spark: SparkSession, folder: str) -> DataFrame:
    dirty = d_products(spark, folder).withColumn(
        "product_id", _emptied("product_id", F.col("stock_quantity") % 9 == 0)
    )
    return quality.non_null(dirty, ["product_id"], "products_non_null")


def assert_nonnull_sales(spark: SparkSession, folder: str) -> DataFrame:
    dirty = f_sales(spark, folder).withColumns(
        {
            "user_id": _emptied("user_id", F.col("quantity") % 7 == 0),
            "product_id": _emptied("product_id", F.col("quantity") % 5 == 0),
        }
    )
    return quality.non_null(dirty, sales.REQUIRED, "sales_non_null")


def assert_required_raw(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_ingest.raw_rows(_messages(spark, folder))
    number = F.col("message_id").cast("bigint")
    dirty = raw.withColumn("message_id", _emptied("message_id", number % 50 == 0))
    return quality.non_null(dirty, schemas.required_columns(schemas.RAW_ROW), "raw_required")


def assertions_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Violations per assertion on the models themselves."""
    merged = customers.merge(*_snapshot_and_stored(spark, folder))
    catalog, fact = d_products(spark, folder), f_sales(spark, folder)
    checks = {
        "customers_unique": quality.unique_key(merged, customers.KEY, ""),
        "products_unique": quality.unique_key(catalog, ["product_id"], ""),
        "products_non_null": quality.null_rows(catalog, ["product_id"]),
        "sales_non_null": quality.null_rows(fact, sales.REQUIRED),
    }
    counted = [
        rows.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("assertion"), "violations"
        )
        for name, rows in checks.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def stored_violations(spark: SparkSession, folder: str) -> DataFrame:
    """What a refused run left in the table of violations: products that repeat, and products without an id."""
    catalog = bronze.product_catalog(spark, folder)
    part = F.col("product_id").cast("bigint")
    again = catalog.where(part % 10 == 0)
    nameless = catalog.where(part % 25 == 1).withColumn("product_id", F.lit(None).cast("string"))
    job = BatchJob(
        spark,
        Bronze(
            bronze.sales_transactions(spark, folder),
            catalog.unionByName(again).unionByName(nameless),
            bronze.clickstream_events(spark, folder),
        ),
        scratch_path(spark, "refused-job"),
    )
    try:
        job.run({"silver"})
    except quality.AssertionFailed:
        pass
    kept = quality.violations(spark, job.violations_path)
    return kept.select(
        (F.col("run") == job.run_id).alias("this_run"),
        "model",
        "assertion",
        F.get_json_object("violation", "$.product_id").alias("product_id"),
        F.get_json_object("violation", "$.null_columns").alias("null_columns"),
        F.get_json_object("violation", "$.n").cast("bigint").alias("n"),
    )


QUERIES: dict[str, Query] = {
    "scan_clickstream": scan_clickstream,
    "scan_support_tickets": scan_support_tickets,
    "scan_product_catalog": scan_product_catalog,
    "scan_newest_catalog": scan_newest_catalog,
    "scan_sales_csv": scan_sales_csv,
    "named_sources": named_sources,
    "json_array_to_ndjson": json_array_to_ndjson,
    "whole_file_messages": whole_file_messages,
    "parse_message": parse_message,
    "add_metadata": add_metadata,
    "topic_routing": topic_routing,
    "landing_path": landing_path,
    "stream_raw_ingest": stream_raw_ingest,
    "stream_multi_topic": stream_multi_topic,
    "stream_landing": stream_landing,
    "stream_redelivery": stream_redelivery,
    "typed_payload": typed,
    "typed_payload_clickstream": typed_payload_clickstream,
    "typed_payload_tickets": typed_payload_tickets,
    "typed_payload_catalog": typed_payload_catalog,
    "typed_payload_sales": typed_payload_sales,
    "latest_catalog_partition": latest_catalog_partition,
    "d_products": d_products,
    "flatten_items": flatten_items,
    "f_sales": f_sales,
    "address_hash": address_hash,
    "row_hash": row_hash,
    "first_transaction_per_user": first_transaction_per_user,
    "customer_snapshots": customer_snapshots,
    "customer_snapshots_latest": customer_snapshots_latest,
    "scd2_close_out": _customer_query(customers.close_out),
    "scd2_close_out_open": _customer_query(customers.close_out, only_open=True),
    "scd2_new_rows": _customer_query(customers.new_rows),
    "scd2_delta": _customer_query(customers.delta),
    "scd2_merge": _customer_query(customers.merge),
    "scd2_merge_open": _customer_query(customers.merge, only_open=True),
    "keyed_upsert": upsert_delta,
    "scd2_partitioned_write": scd2_partitioned_write,
    "current_customers": current_customers,
    "open_versions_per_user": open_versions_per_user,
    "user_purchase_patterns": user_purchase_patterns,
    "user_purchase_patterns_float": user_purchase_patterns_float,
    "browsed_categories": browsed_categories,
    "user_behavior_summary": user_behavior_summary,
    "batch_job": batch_job,
    "named_models": named_models,
    "batch_job_second_run": batch_job_second_run,
    "assert_unique_customers": assert_unique_customers,
    "assert_unique_products": assert_unique_products,
    "assert_nonnull_products": assert_nonnull_products,
    "assert_nonnull_sales": assert_nonnull_sales,
    "assert_required_raw": assert_required_raw,
    "assertions_clean": assertions_clean,
    "stored_violations": stored_violations,
}


def _registered(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return present(query(configure(spark), folder))

    return run


def queries() -> dict[str, Query]:
    return {name: _registered(query) for name, query in QUERIES.items()}
