"""Readers for whole documents: JSON arrays and files that travel as one message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cairnlake.functions.json_text import STRICT, is_sealed, sealed_json


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """``element``, a variant, for every element of files that hold one JSON array each.

    A JSON array cannot be split, so every file is one task; the files are read side by side.  A file that is anything
    but one JSON array, text after the array included, stops the query.
    """
    files = spark.read.text(path, wholetext=True)
    text = F.col("value")
    sealed = files.withColumn("_sealed", sealed_json(text))
    items = F.when(is_sealed(F.col("_sealed"), text), F.try_variant_get("_sealed", "$[0]", "array<variant>"))
    refused = F.raise_error(F.concat(F.lit("not a JSON array: "), F.substring(text, 1, 80))).cast("array<variant>")
    return sealed.select(F.explode(F.coalesce(items, refused)).alias("element"))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The records of files that hold one JSON array each; a member of another type than its column stops the query."""
    element = F.to_json("element")
    record = F.from_json(element, schema, {**STRICT, "mode": "FAILFAST"})
    return array_elements(spark, path).select(record.alias("record")).select("record.*")


def json_array_to_ndjson(spark: SparkSession, source: str, target: str) -> None:
    """Turn JSON-array files into NDJSON files, one element per line with all its members."""
    array_elements(spark, source).select(F.to_json("element").alias("value")).write.text(target)


def whole_file_messages(
    spark: SparkSession, path: str, topic: Column, pattern: str | None = None
) -> DataFrame:
    """Every file below ``path`` as one message with its bytes unchanged.

    ``topic`` is computed from the ``path`` column.  Files are read in parallel; a single file has
    to fit in memory, as it has to fit in a message.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        F.sha2(F.col("path"), 256).alias("message_id"),
        F.col("modificationTime").alias("publish_time"),
        topic.alias("source_topic"),
        F.col("content").alias("data"),
        F.expr("cast(map() as map<string, string>)").alias("attributes"),
    )
