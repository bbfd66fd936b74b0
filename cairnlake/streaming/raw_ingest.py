"""Messages -> generic raw rows -> append-only raw tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from cairnlake import schemas
from cairnlake.functions import json_text, messages as msg, topics
from cairnlake.operators.quality import refuse_null


def parse_message(messages: DataFrame) -> DataFrame:
    """Add ``payload``, a JSON text for any message; no message is dropped.

    The text and the parsed JSON are columns of their own in between, so each is computed once.
    """
    kept = [F.col(name) for name in messages.columns]
    return (
        messages.select(*kept, msg.message_text(F.col("data")).alias("_text"))
        .select("*", json_text.sealed_json(F.col("_text")).alias("_sealed"))
        .select(
            *kept,
            msg.message_payload(F.col("data"), F.col("_text"), F.col("_sealed")).alias("payload"),
        )
    )


def add_metadata(source_topic: str | Column) -> Callable[[DataFrame], DataFrame]:
    """A transform from parsed messages to raw rows of the given topic."""
    topic = F.lit(source_topic) if isinstance(source_topic, str) else source_topic

    def attach(parsed: DataFrame) -> DataFrame:
        return parsed.select(
            "message_id",
            F.coalesce(F.col("publish_time"), F.current_timestamp()).alias("publish_time"),
            topic.alias("source_topic"),
            F.current_timestamp().alias("ingestion_time"),
            "payload",
            msg.attributes_json(F.col("attributes")).alias("attributes"),
        )

    return attach


def raw_rows(messages: DataFrame, source_topic: str | Column | None = None) -> DataFrame:
    """Raw rows of a message table or stream; the topic is a name or the messages' own column."""
    topic = F.col("source_topic") if source_topic is None else source_topic
    return messages.transform(parse_message).transform(add_metadata(topic))


def routed(raw: DataFrame, tables: dict[str, str], override: str | None = None) -> DataFrame:
    """Raw rows with the name of the table they belong to."""
    return raw.withColumn("target_table", topics.target_table(F.col("source_topic"), tables, override))


def start_raw_ingest(
    messages: DataFrame,
    checkpoint: str,
    tables: dict[str, str],
    path: str | None = None,
    table: str | None = None,
    override: str | None = None,
    source_topic: str | Column | None = None,
    drain: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Start the stream into ``path/target_table=.../`` or into one catalog table.

    Map-only: rows are written by the tasks that read them.  The checkpoint makes a restart go on
    where the last committed batch ended.  ``drain`` stops after what is there now; otherwise the
    stream runs on with a batch per ``interval``.  A missing required value stops the stream.
    """
    required = schemas.required_columns(schemas.RAW_ROW)
    rows = refuse_null(raw_rows(messages, source_topic), required)
    writer = (
        routed(rows, tables, override)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(**({"availableNow": True} if drain else {"processingTime": interval}))
    )
    if table is not None:
        return writer.toTable(table)
    return writer.partitionBy("target_table").option("path", path).start()
