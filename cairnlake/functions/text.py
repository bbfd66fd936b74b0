"""Text clean-up and the two customer hashes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ADDRESS_COLUMNS = ("user_id", "billing_country", "shipping_address")


def trim_whitespace(text: Column) -> Column:
    """Strip every Unicode white space at both ends; Spark's ``trim`` strips blanks only."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def address_hash(address: Column) -> Column:
    """MD5 of the trimmed address, as lower-case hex."""
    return F.md5(trim_whitespace(address))


def row_hash(*columns: Column | str) -> Column:
    """SHA-256 over the columns joined by ``|``; NULL columns are left out of the joined text."""
    return F.sha2(F.concat_ws("|", *(columns or ADDRESS_COLUMNS)), 256)
