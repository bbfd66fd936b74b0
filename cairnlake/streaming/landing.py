"""Messages -> date-partitioned text files that the bronze scans read."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from cairnlake.functions import topics
from cairnlake.functions.topics import LandingRoute
from cairnlake.sources.messages import merge_topics
from cairnlake.storage import Storage


def landing_folder(
    root: str, topic: str, route: LandingRoute, prefix: str = topics.DEFAULT_LANDING_PREFIX
) -> str:
    """The folder of one topic; below it come ``dt=YYYY-MM-DD`` folders."""
    return f"{root.rstrip('/')}/{route.bucket}/{prefix}/{topic.split('/')[-1]}"


def landed_names(
    messages: DataFrame, routes: DataFrame, prefix: str = topics.DEFAULT_LANDING_PREFIX
) -> DataFrame:
    """Bucket and object name of every message of a configured topic; other topics are not read.

    The routes are the configuration, a handful of rows, and are broadcast.
    """
    name = topics.landing_object(
        F.col("source_topic"),
        F.col("publish_time"),
        F.col("file_prefix"),
        F.col("extension"),
        prefix,
    )
    return messages.join(F.broadcast(routes), "source_topic").select(
        "message_id", "source_topic", "bucket", name.alias("object_name")
    )


def landed_text(messages: DataFrame, *others: str) -> DataFrame:
    """The message bytes, unchanged, as the value of a text file, the publish date, and other columns as they are."""
    return messages.select(
        *others,
        F.coalesce(F.col("data"), F.lit(b"")).cast("string").alias("value"),
        F.to_date("publish_time").alias("dt"),
    )


def batch_writer(
    spark: SparkSession, root: str, checkpoint: str, routes: dict[str, LandingRoute], prefix: str = topics.DEFAULT_LANDING_PREFIX
) -> Callable[[DataFrame, int], None]:
    """What lands one batch: a function of the batch and its number, for ``foreachBatch``.

    One job writes the messages of all topics to a folder that readers do not see.  Then every topic's and date's folder is given its
    place, ``dt=YYYY-MM-DD/<stream>-<number>`` below the topic's folder, which shows all of its files at once or none.  The
    name says which batch of which stream (the id in its checkpoint) it is: a batch that is delivered again, wherever it broke off,
    finds the folders it has already placed and leaves them, so that every message lands once.
    """
    numbers = F.create_map(*(F.lit(x) for pair in ((topic, i) for i, topic in enumerate(routes)) for x in pair))

    def land(batch: DataFrame, number: int) -> None:
        storage = Storage(spark, root)
        stream = json.loads(storage.text(f"{checkpoint.rstrip('/')}/metadata"))["id"]
        name = f"{stream}-{number:09d}"
        staged = f"{root.rstrip('/')}/_landing/{name}"
        own = batch.where(F.col("source_topic").isin(list(routes))).withColumn("_route", numbers[F.col("source_topic")])
        landed_text(own, "_route").write.mode("overwrite").partitionBy("_route", "dt").text(staged)
        for i, (topic, route) in enumerate(routes.items()):
            place = landing_folder(root, topic, route, prefix)
            for day in storage.names(f"{staged}/_route={i}", folders=True):
                storage.move(f"{staged}/_route={i}/{day}", f"{place}/{day}/{name}")
        storage.delete(staged)

    return land


def start_landing(
    messages: DataFrame | dict[str, DataFrame],
    root: str,
    checkpoint: str,
    routes: dict[str, LandingRoute],
    prefix: str = topics.DEFAULT_LANDING_PREFIX,
    drain: bool = True,
    interval: str = "1 minute",
) -> list[StreamingQuery]:
    """Start the stream that lands the messages of all configured topics.

    ``messages`` is a single stream, or one stream per topic, which are put together.  Every batch reads its source
    once and writes with one job, whatever the number of topics; see :func:`batch_writer` for what a broken-off batch leaves.
    Messages of a batch share files, every message ending in a line break.
    """
    if not routes:
        return []
    stream = merge_topics(messages) if isinstance(messages, dict) else messages
    writer = (
        stream.writeStream.foreachBatch(batch_writer(stream.sparkSession, root, checkpoint, routes, prefix))
        .option("checkpointLocation", checkpoint)
        .trigger(**({"availableNow": True} if drain else {"processingTime": interval}))
    )
    return [writer.start()]


def finish(queries: list[StreamingQuery], timeout: float | None = None) -> bool:
    """Wait until all streams have ended, or stop them after ``timeout`` seconds in all.

    Returns whether they ended by themselves.  Messages left over stay for the next start.
    """
    if timeout is None:
        for query in queries:
            query.awaitTermination()
        return True
    deadline = time.monotonic() + timeout
    ended = True
    try:
        for query in queries:
            ended &= bool(query.awaitTermination(max(0.0, deadline - time.monotonic())))
    finally:
        for query in queries:
            query.stop()
    return ended
