"""Bronze scans: date-partitioned text files read through a declared schema.

Files are read line by line as text, and every line is judged as a whole before its columns are: the judgement is a filter of the
rows, so it holds whatever columns a query reads, and for a count as well.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from cairnlake import schemas
from cairnlake.functions import csv_text
from cairnlake.functions.json_text import STRICT, is_single_object
from cairnlake.operators.partitions import newest_directories

#: How files spell instants with microseconds (readers accept any ISO form).
INSTANT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

CSV_QUOTING = csv_text.QUOTING
#: What readers do with a line that does not fit: stop, keep it, leave it out.
MODES = ("FAILFAST", "PERMISSIVE", "DROPMALFORMED")
_BROKEN = "_broken_line"
_BLANKS = " \t\r\n"


def _lines(spark: SparkSession, path: str, schema: T.StructType, base: str | None = None) -> DataFrame:
    """``value`` and the partition column ``dt``, if the schema has it, of every line that is not blank."""
    read = T.StructType([T.StructField("value", T.StringType()), *(f for f in schema.fields if f.name == "dt")])
    reader = spark.read.schema(read)
    if base is not None:
        reader = reader.option("basePath", base)
    return reader.text(path).where(F.trim("value", F.lit(_BLANKS)) != "")


def _must_hold(lines: DataFrame, holds: Column, message: str) -> DataFrame:
    """The lines, stopping at the first for which a condition does not hold."""
    told = F.concat(F.lit(f"[MALFORMED_RECORD_IN_PARSING] {message}: "), F.substring("value", 1, 200))
    return lines.where(F.when(F.coalesce(holds, F.lit(False)), True).otherwise(F.raise_error(told).cast("boolean")))


def _objects(lines: DataFrame, schema: T.StructType, mode: str, corrupt: str | None) -> DataFrame:
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")
    fields = [f for f in schema.fields if f.name != "dt"]
    others = [f.name for f in schema.fields if f.name == "dt"]
    if mode == "FAILFAST":
        lines = _must_hold(lines, is_single_object(F.col("value")), "not one JSON object")
        record = F.from_json("value", T.StructType(fields), {**STRICT, "mode": mode})
        return lines.select(record.alias("_record"), *others).select("_record.*", *others)
    kept = T.StructType([*fields, T.StructField(_BROKEN, T.StringType())])
    options = {**STRICT, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    parsed = lines.withColumn("_record", F.when(is_single_object(F.col("value")), F.from_json("value", kept, options)))
    fits = F.col("_record").isNotNull() & F.col(f"_record.{_BROKEN}").isNull()
    if mode == "DROPMALFORMED":
        parsed = parsed.where(fits)
    # What fits of a line with a value of another type stays, as in Spark's own reader.
    columns = [F.col("_record")[f.name].alias(f.name) for f in fields]
    text = [F.when(~fits, F.col("value")).alias(corrupt)] if corrupt else []
    return parsed.select(*columns, *others, *text)


def scan_ndjson(
    spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST", corrupt: str | None = None
) -> DataFrame:
    """One JSON object per line under ``path/dt=YYYY-MM-DD/``; blank lines are skipped.

    A line that is anything but one object (broken, two objects, an object with text after it, an array) stops the
    query, as does a value of another type in a column that is read.  ``PERMISSIVE`` makes such a line a row without values, or with
    those that fit, and puts its text into the column ``corrupt``, if one is named; ``DROPMALFORMED`` leaves it out.
    """
    return _objects(_lines(spark, path, schema), schema, mode, corrupt)


def scan_clickstream(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    return scan_ndjson(spark, path, schemas.CLICKSTREAM_EVENTS, mode)


def scan_support_tickets(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    return scan_ndjson(spark, path, schemas.CUSTOMER_SUPPORT_TICKETS, mode)


def scan_product_catalog(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    return scan_ndjson(spark, path, schemas.PRODUCT_CATALOG, mode)


def scan_newest_catalog(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """The newest catalog date that holds a row, found by listing directories.

    Asking the text files for their largest ``dt`` would read the whole history; this reads one day.
    """
    schema = schemas.PRODUCT_CATALOG
    for folder in newest_directories(spark, path, "dt"):
        lines = _lines(spark, folder, schema, path)
        if not lines.isEmpty():
            return _objects(lines, schema, mode, None)
    return spark.createDataFrame([], schema)


def scan_sales(spark: SparkSession, path: str) -> DataFrame:
    """CSV with one header row per landed message; short rows are filled up with NULL, blank lines are skipped.

    Several messages can share a landed file, so a header can stand anywhere: a line that spells the names of the columns, in
    quotes or not, is dropped.

    A row with more values than there are columns, with quotes that do not enclose whole values, as the two halves of a
    value with a line break have, or with a value of another type than its column's stops the query.
    """
    fields = [f for f in schemas.SALES_TRANSACTIONS if f.name != "dt"]
    lines = _lines(spark, path, schemas.SALES_TRANSACTIONS).where(
        ~csv_text.spells(F.col("value"), [f.name for f in fields])
    )
    counted = _must_hold(lines, csv_text.value_count(F.col("value")) <= len(fields), "not a row of sales")
    text = ", ".join(f"`{f.name}` string" for f in fields)
    # Read as one column: a pruned record would let wrong types in columns that are not read pass.
    parsed = counted.withColumn("_record", F.from_csv("value", text, csv_text.QUOTING))
    typed = [f for f in fields if f.dataType != T.StringType()]
    wrong = reduce(
        lambda a, b: a | b,
        (F.col("_record")[f.name].isNotNull() & F.col("_record")[f.name].try_cast(f.dataType).isNull() for f in typed),
    )
    checked = _must_hold(parsed, ~wrong, "CAST_INVALID_INPUT, not a row of sales")
    return checked.select(*(F.col("_record")[f.name].cast(f.dataType).alias(f.name) for f in fields), "dt")


SCANS = {
    "clickstream_events": scan_clickstream,
    "customer_support_tickets": scan_support_tickets,
    "product_catalog": scan_product_catalog,
    "sales_transactions": scan_sales,
}


def register_sources(spark: SparkSession, locations: dict[str, str]) -> None:
    """Give bronze tables their names, so that SQL can refer to them: ``{table: path}``.

    A name stands for the scan, not for data; partitions present at this time are found by the scan.
    """
    for name, path in locations.items():
        SCANS[name](spark, path).createOrReplaceTempView(name)
