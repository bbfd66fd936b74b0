import hashlib

from pyspark.sql import functions as F

from cairnlake.functions import text


def test_trim_strips_every_unicode_space(spark):
    table = spark.createDataFrame([(" \t 1 Main St \n",), ("",), (None,)], "a string")
    trimmed = [row.t for row in table.select(text.trim_whitespace(F.col("a")).alias("t")).collect()]
    assert trimmed == ["1 Main St", "", None]


def test_hashes(spark):
    table = spark.createDataFrame(
        [("u1", None, " 1 Main St ")], "user_id string, billing_country string, shipping_address string"
    )
    row = table.select(
        text.address_hash(F.col("shipping_address")).alias("a"), text.row_hash().alias("r")
    ).first()
    assert row.a == hashlib.md5(b"1 Main St").hexdigest()
    assert row.r == hashlib.sha256(b"u1| 1 Main St ").hexdigest()
