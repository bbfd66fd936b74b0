"""Raw stream rows with their payload parsed into the columns of a bronze table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cairnlake.functions import csv_text
from cairnlake.functions.csv_text import QUOTING as CSV_QUOTING
from cairnlake.functions.json_text import STRICT, is_single_json

_BROKEN = "_broken"
_BLANKS = " \t\r\n"


def is_wrapped(payload: Column) -> Column:
    """True for a payload that only wraps a text or bytes that were not JSON."""
    keys = F.coalesce(F.json_object_keys(payload), F.array().cast("array<string>"))
    return keys.isin(F.array(F.lit("raw")), F.array(F.lit("raw_b64")))


def _is_json_line(line: Column) -> Column:
    return F.trim(line, F.lit(_BLANKS)).startswith("{")


def typed_payload(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per record: ``record``, or the record's text in ``broken`` where it does not fit the schema.

    An array payload gives a row per element, an empty one none.  A wrapped text is what a source sends that publishes whole
    files: NDJSON if it starts with a brace, otherwise CSV, whose records may have line breaks inside quotes and whose header
    lines are dropped.  Every element, line and record that is not blank gives a row; one that is no object, has text after its object, has
    more values than there are columns or a value of another type is broken and takes no other along.  Wrapped
    bytes give one row with neither record nor text.

    The other columns of ``raw`` stay, but not the payload: a whole file would be repeated for each of its records.
    The partition column ``dt`` is not part of a payload.
    """
    fields = [field for field in schema.fields if field.name != "dt"]
    record = T.StructType([*fields, T.StructField(_BROKEN, T.StringType())])
    text, body = F.col("_payload"), F.col("_body")
    lines = F.filter(F.split(body, r"\r?\n"), lambda line: F.trim(line, F.lit(_BLANKS)) != "")
    records = F.when(_is_json_line(body), lines).otherwise(csv_text.split_records(body))
    elements = F.transform(
        F.try_variant_get(F.try_parse_json(text), "$", "array<variant>"), lambda element: F.to_json(element)
    )
    nothing = F.array(F.lit(None).cast("string"))
    found = (
        F.when(is_wrapped(text), F.coalesce(records, nothing))
        .when(text.startswith("["), F.coalesce(elements, F.array(text)))
        .otherwise(F.array(text))
    )
    # Only CSV knows header lines; a JSON line cannot spell one.
    kept = [name for name in raw.columns if name != "payload"]
    # Whatever is taken from the whole payload is taken once, before there is a row for each record.
    whole_text = raw.select(*kept, F.trim(F.col("payload"), F.lit(_BLANKS)).alias("_payload"))
    bodies = whole_text.select(*kept, "_payload", F.get_json_object(text, "$.raw").alias("_body"))
    split = bodies.select(*kept, body.isNotNull().alias("_wrapped"), found.alias("_found"))
    # Of an inner explode Spark infers filters on the array and computes it for them, too; a payload without records has no place.
    each = split.select(*kept, "_wrapped", F.posexplode_outer("_found").alias("_place", "_text"))
    one = each.where(F.col("_place").isNotNull()).drop("_place").where(
        F.col("_text").isNull() | ~csv_text.spells(F.col("_text"), [field.name for field in fields])
    )
    options = {"columnNameOfCorruptRecord": _BROKEN}
    from_json = F.from_json("_text", record, {**STRICT, **options})
    csv_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in record.fields)
    from_csv = F.from_csv("_text", csv_schema, {**CSV_QUOTING, **options}) if _is_flat(fields) else F.lit(None).cast(record)
    whole = _is_json_line(F.col("_text")) & is_single_json(F.col("_text"))
    csv = F.col("_wrapped") & ~_is_json_line(F.col("_text")) & (csv_text.value_count(F.col("_text")) <= len(fields))
    parsed = one.withColumn("_record", F.when(whole, from_json).when(csv, from_csv))
    fits = F.col("_record").isNotNull() & F.col(f"_record.{_BROKEN}").isNull()
    plain = F.struct(*(F.col("_record")[field.name].alias(field.name) for field in fields))
    return parsed.select(
        *kept,
        F.when(fits, plain).alias("record"),
        F.when(~fits, F.col("_text")).alias("broken"),
    )


def _is_flat(fields: list[T.StructField]) -> bool:
    """Whether CSV can hold the columns."""
    return not any(isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)) for f in fields)
