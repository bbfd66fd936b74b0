"""Unbounded message sources.  Each returns rows in the message envelope."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cairnlake.schemas import MESSAGE_ENVELOPE


def file_messages(
    spark: SparkSession,
    path: str,
    schema: T.StructType = MESSAGE_ENVELOPE,
    file_format: str = "parquet",
    pattern: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A stream over the files of a folder; new files are picked up as they appear."""
    reader = spark.readStream.format(file_format).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def kafka_messages(spark: SparkSession, servers: str, topics: Iterable[str], **options) -> DataFrame:
    """A stream over Kafka topics; needs Spark's Kafka package on the class path."""
    stream = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("includeHeaders", True)
        .options(**options)
        .load()
    )
    return from_kafka(stream)


def from_kafka(records: DataFrame) -> DataFrame:
    """Kafka records in the message envelope; partition and offset identify a record.

    Of a repeated header the last value counts.
    """
    headers = F.coalesce(F.col("headers"), F.array().cast("array<struct<key:string,value:binary>>"))
    names = F.transform(headers, lambda header: header["key"])
    last = F.filter(
        headers,
        lambda header, i: ~F.array_contains(
            F.slice(names, i + 2, F.greatest(F.size(names) - i - 1, F.lit(0))), header["key"]
        ),
    )
    return records.select(
        F.concat_ws("/", "topic", "partition", "offset").alias("message_id"),
        F.col("timestamp").alias("publish_time"),
        F.col("topic").alias("source_topic"),
        F.col("value").alias("data"),
        F.map_from_entries(
            F.transform(
                last, lambda h: F.struct(h["key"], h["value"].cast("string").alias("value"))
            )
        ).alias("attributes"),
    )


def merge_topics(streams: dict[str, DataFrame]) -> DataFrame:
    """One stream out of one stream per topic, each row tagged with its topic."""
    tagged = [stream.withColumn("source_topic", F.lit(topic)) for topic, stream in streams.items()]
    return reduce(lambda left, right: left.unionByName(right), tagged)


def of_topic(messages: DataFrame, topic: str | Column) -> DataFrame:
    """The messages of one topic."""
    return messages.where(F.col("source_topic") == topic)
