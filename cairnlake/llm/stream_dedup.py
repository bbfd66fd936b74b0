"""Exact deduplication as a stream with keyed state on disk.

Texts are equal when they are identical without spaces and the characters 0x09 to 0x0D.  A stream of digests feeds
an aggregation whose state, one entry for each digest, is kept in RocksDB without a watermark, so nothing ever expires.
An entry holds the digest, how many rows had it, and the stable identifier and the content locator (the file) of the
row that stays.  Digests that occur more than once are hits: the bytes of their texts are read back through the
locator and compared in full with those of the row that stays, and texts that differ in spite of equal digests are
grouped by their bytes.

Many equal texts cost no more than others: their count and best row are combined in each task before the shuffle,
and comparing with the row that stays is an equi-join, whose large partitions adaptive execution splits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cairnlake.llm.scratch import discard, stored
from cairnlake.llm.text_arrays import read_texts
from cairnlake.llm.workers import map_batches
from cairnlake.session import scratch_path

BLANKS = " \t\n\x0b\x0c\r"
#: Hexadecimal digits of SHA-256 that key the state.
DIGEST_DIGITS = 64
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Between batches the state lies in the checkpoint folder alone: an open store takes 4 MB of its executor's disk
    # for each partition, however small, and ties the partition to the executor.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def normalised(text: str | Column) -> Column:
    """The text without blanks; a null text is empty."""
    column = F.col(text) if isinstance(text, str) else text
    return F.translate(F.coalesce(column, F.lit("")), BLANKS, "")


def text_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, locator, n_points, text_sha256`` of every row: one pass, nothing shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blanks = BLANKS.encode()
        for batch in batches:
            digests = []
            for _, texts in read_texts(batch.column("text")):
                digests += [
                    hashlib.sha256(texts.text_bytes(i).tobytes().translate(None, blanks)).hexdigest()
                    for i in range(len(texts))
                ]
            points = pc.fill_null(pc.utf8_length(batch.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("locator"), points, pa.array(digests, pa.string())],
                names=["doc_id", "locator", "n_points", "text_sha256"],
            )

    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.input_file_name().alias("locator"), docs["text"].alias("text")
    )
    return map_batches(rows, run, "doc_id long, locator string, n_points long, text_sha256 string")


def stays(n_points: str = "n_points", doc_id: str = "doc_id") -> Column:
    """What the row that stays has the largest value of: most code points, then the smallest doc_id."""
    return F.struct(F.col(n_points).alias("n_points"), F.bitwise_not(F.col(doc_id)).alias("minus_id"), F.col("locator"))


def keyed_state(digests: DataFrame) -> DataFrame:
    """The stateful part: a stream (or table) of digests to ``digest, n, best``, one row for each digest."""
    return digests.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max(stays()).alias("best"))


def run_stream(digests: DataFrame, checkpoint: str, updates: str) -> None:
    """Drain a stream of digests into the state and write each batch's changed entries to ``updates``.

    A batch that runs again after a failure replaces its own folder.  Started again with the same folders, the
    stream goes on from its state.
    """
    spark = digests.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{updates}/batch={number}")

    before = {name: spark.conf.get(name, None) for name in STATE_SETTINGS}
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        query = (
            keyed_state(digests)
            .writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(write)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def last_entries(spark: SparkSession, updates: str, schema: DataFrame) -> DataFrame:
    """The newest entry of every digest: counts only grow, so it is the one with the largest count."""
    written = spark.read.schema(schema.schema).parquet(f"{updates}/batch=*")
    return written.groupBy("digest").agg(F.max(F.struct("n", "best")).alias("entry")).select(
        "digest", "entry.n", "entry.best"
    )


def deduplicate(docs: DataFrame, digest_digits: int = DIGEST_DIGITS) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row.

    Null texts are empty, and empty texts equal each other and texts of blanks.  Of rows that tie in length and
    doc_id, all are called kept (:func:`drop_copies` leaves one).  A null doc_id stays behind any other.  Extra
    columns are not read.  ``digest_digits`` shortens the state's key; the result does not depend on it.
    """
    spark = docs.sparkSession
    rows = text_digests(docs).withColumn("digest", F.substring("text_sha256", 1, digest_digits))
    digests = stored(rows, "dedup-digests")
    work = scratch_path(spark, "dedup-stream")
    source = digests.inputFiles()[0].rsplit("/", 1)[0]
    run_stream(spark.readStream.schema(digests.schema).parquet(source), f"{work}/checkpoint", f"{work}/updates")
    state = stored(last_entries(spark, f"{work}/updates", keyed_state(digests)), "dedup-state")
    entries = digests.join(state, "digest")
    single = entries.where("n = 1").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    hits = _checked(docs, entries.where("n > 1"), digest_digits)
    groups = stored(
        hits.groupBy("digest", "other").agg(F.count(F.lit(1)).alias("group_size"), F.max(stays()).alias("best")),
        "dedup-groups",
    )
    multiple = hits.join(groups, ["digest", "other"]).select(
        "doc_id",
        F.bitwise_not(F.col("best.minus_id")).alias("keep_id"),
        "group_size",
        F.col("doc_id").eqNullSafe(F.bitwise_not(F.col("best.minus_id"))).alias("kept"),
        "text_sha256",
    )
    return single.unionByName(multiple)


def _checked(docs: DataFrame, members: DataFrame, digest_digits: int) -> DataFrame:
    """The rows of hits, with ``other`` empty when their bytes are those of the row that stays, else their bytes."""
    wanted = members.select(
        "doc_id",
        "locator",
        "digest",
        (F.col("locator").eqNullSafe(F.col("best.locator")) & F.col("doc_id").eqNullSafe(F.bitwise_not(F.col("best.minus_id")))).alias(
            "is_best"
        ),
    ).distinct()
    content = docs.select(
        docs["doc_id"].cast("long").alias("_id"), F.input_file_name().alias("_file"), docs["text"].alias("_text")
    )
    # The small side is built into hash tables, so that texts are not sorted.
    read = (
        content.join(
            wanted.hint("shuffle_hash"),
            F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_file") == F.col("locator")),
        )
        .withColumn("_bytes", normalised("_text"))
        .withColumn("text_sha256", F.sha2("_bytes", 256))
        .where(F.substring("text_sha256", 1, digest_digits) == F.col("digest"))
        .select(
            "doc_id",
            "locator",
            "digest",
            "is_best",
            "text_sha256",
            "_bytes",
            F.char_length(F.coalesce("_text", F.lit(""))).cast("long").alias("n_points"),
        )
    )
    read = stored(read, "dedup-content")
    best = stored(read.where("is_best").groupBy("digest").agg(F.max("_bytes").alias("_best")), "dedup-best")
    hits = stored(
        read.join(best, "digest", "left").select(
            "doc_id",
            "locator",
            "digest",
            "text_sha256",
            "n_points",
            F.when(F.col("_bytes") == F.col("_best"), F.lit("")).otherwise(F.concat(F.lit("="), "_bytes")).alias("other"),
        ),
        "dedup-hits",
    )
    discard(read, best)
    return hits


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows equal in doc_id and text one stays."""
    # Own names by place, as any name can be a column of docs.
    names = [f"_keep{i}" for i in range(len(docs.columns))]
    place = {name: F.col(names[i]) for i, name in enumerate(docs.columns)}
    stay_ = deduplicate(docs).where("kept").select(row_key(F.col("doc_id")).alias("_id"), F.col("text_sha256").alias("_sha"))
    named = docs.toDF(*names)
    named = named.withColumn("_id", row_key(place["doc_id"])).withColumn("_sha", F.sha2(normalised(place["text"]), 256))
    rows = named.join(stay_.distinct().hint("shuffle_hash"), ["_id", "_sha"], "left_semi")
    # The join has brought equal rows together.
    number = F.row_number().over(Window.partitionBy("_id", "_sha").orderBy(F.char_length(place["text"]).desc()))
    return rows.withColumn("_number", number).where("_number = 1").select(*names).toDF(*docs.columns)


def row_key(doc_id: Column) -> Column:
    """The doc_id as a join key; rows without one share a key that no document has."""
    return F.coalesce(doc_id.cast("long"), F.lit(-(1 << 63)))
