"""Topic names and the two routing tables."""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


class LandingRoute(NamedTuple):
    """Where the messages of one topic land."""

    bucket: str
    file_prefix: str
    extension: str


# Topic names, raw tables, bucket endings, file prefixes and extensions.
RAW_TABLES = {
    "clickstream-topic": "clickstream_raw",
    "customer-support-topic": "customer_support_raw",
    "product-catalog": "product_catalog_raw",
    "sales-transactions": "sales_transactions_raw",
}
BUCKET_ENDINGS = {
    "clickstream-topic": ("bronze-events", "clickstream", "json"),
    "customer-support-topic": ("bronze-support", "customer-support", "json"),
    "product-catalog": ("bronze-products", "product-catalog", "json"),
    "sales-transactions": ("bronze-sales", "sales-transactions", "csv"),
}
DEFAULT_RAW_TABLE = "streaming_raw"
DEFAULT_LANDING_PREFIX = "pubsub-data"


def topic_path(project: str, name: str) -> str:
    return f"projects/{project}/topics/{name}"


def raw_table_map(project: str) -> dict[str, str]:
    """Full topic path -> raw table."""
    return {topic_path(project, name): table for name, table in RAW_TABLES.items()}


def landing_routes(project: str, owner: str) -> dict[str, LandingRoute]:
    """Full topic path -> bucket, file prefix, extension; buckets are named after their owner."""
    return {
        topic_path(project, name): LandingRoute(f"{owner}-{ending}", prefix, extension)
        for name, (ending, prefix, extension) in BUCKET_ENDINGS.items()
    }


def load_landing_routes(path: str) -> dict[str, LandingRoute]:
    """Read the routes from a ``{"topic_bucket_map": {topic: [bucket, prefix, extension]}}`` file."""
    with open(path, encoding="utf-8") as config:
        entries = json.load(config)["topic_bucket_map"]
    return {topic: LandingRoute(*entry) for topic, entry in entries.items()}


def route_table(spark: SparkSession, routes: dict[str, LandingRoute]) -> DataFrame:
    """The routes as a DataFrame; one row per configured topic, so it stays a handful of rows."""
    return spark.createDataFrame(
        [(topic, *route) for topic, route in routes.items()],
        "source_topic string, bucket string, file_prefix string, extension string",
    )


def topic_slug(topic: Column) -> Column:
    """The last part of a topic path."""
    return F.element_at(F.split(topic, "/"), -1)


def target_table(topic: Column, tables: dict[str, str], override: str | None = None) -> Column:
    """The raw table of a topic: the override, else the mapped table, else the default table."""
    mapped = F.create_map(*(F.lit(text) for pair in tables.items() for text in pair))
    found = F.element_at(mapped, topic) if tables else F.lit(None)
    return F.coalesce(F.lit(override or None), found, F.lit(DEFAULT_RAW_TABLE))


def landing_object(
    topic: Column,
    publish_time: Column,
    file_prefix: Column,
    extension: Column,
    prefix: str = DEFAULT_LANDING_PREFIX,
) -> Column:
    """Object name of a landed message.  Its time has whole seconds, so names can repeat."""
    return F.concat(
        F.lit(prefix),
        F.lit("/"),
        topic_slug(topic),
        F.date_format(publish_time, "'/dt='yyyy-MM-dd'/'"),
        file_prefix,
        F.date_format(publish_time, "'_'yyyy-MM-dd_HH-mm-ss'.'"),
        extension,
    )
