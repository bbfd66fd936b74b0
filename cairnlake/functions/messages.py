"""Message payloads and envelope fields, all in built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cairnlake.functions import json_text


def message_text(data: Column) -> Column:
    """The message bytes as text; NULL unless they are valid UTF-8.  Missing bytes count as empty."""
    text = F.coalesce(data, F.lit(b"")).cast("string")
    return F.when(F.is_valid_utf8(text), text)


def base64_text(data: Column) -> Column:
    """Base64 on one line, whatever line length the session asks for."""
    return F.regexp_replace(F.base64(data), r"\s", "")


def message_payload(data: Column, text: Column, sealed: Column) -> Column:
    """A JSON text for any message: the JSON itself, ``{"raw": text}`` or ``{"raw_b64": base64}``."""
    return (
        F.when(text.isNull(), F.to_json(F.struct(base64_text(data).alias("raw_b64"))))
        .when(json_text.is_sealed(sealed, text), json_text.normal_json(sealed, text))
        .otherwise(F.to_json(F.struct(text.alias("raw"))))
    )


def attributes_json(attributes: Column) -> Column:
    """The attribute map as JSON text; NULL when it is empty or missing."""
    return F.when(F.cardinality(attributes) > 0, F.to_json(attributes))


def wire_time(timestamp: Column) -> Column:
    """An instant as text with microseconds and the zone name UTC."""
    return F.date_format(timestamp, "yyyy-MM-dd HH:mm:ss.SSSSSS 'UTC'")
