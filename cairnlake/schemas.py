"""Declared table schemas.  Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

CLICKSTREAM_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("page_url", T.StringType()),
        T.StructField("user_agent", T.StringType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("referrer", T.StringType()),
        T.StructField("device_type", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField(
            "properties",
            T.StructType(
                [
                    T.StructField("product_id", T.StringType()),
                    T.StructField("category", T.StringType()),
                    T.StructField("price", T.DoubleType()),
                    T.StructField("quantity", T.LongType()),
                    T.StructField("cart_value", T.DoubleType()),
                    T.StructField("items_count", T.LongType()),
                    T.StructField("search_query", T.StringType()),
                    T.StructField("results_count", T.LongType()),
                ]
            ),
        ),
        T.StructField("dt", T.DateType()),
    ]
)

CUSTOMER_SUPPORT_TICKETS = T.StructType(
    [
        T.StructField("ticket_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("category", T.StringType()),
        T.StructField("priority", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("subject", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("sentiment_score", T.DoubleType()),
        T.StructField("agent_id", T.StringType()),
        T.StructField("resolution_time_hours", T.DoubleType()),
        T.StructField("satisfaction_score", T.LongType()),
        T.StructField("dt", T.DateType()),
    ]
)

PRODUCT_CATALOG = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("cost", T.DoubleType()),
        T.StructField("stock_quantity", T.LongType()),
        T.StructField("supplier_id", T.StringType()),
        T.StructField("last_updated", T.TimestampType()),
        T.StructField("attributes", T.VariantType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("dt", T.DateType()),
    ]
)

SALES_TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("items", T.StringType()),
        T.StructField("shipping_address", T.StringType()),
        T.StructField("billing_country", T.StringType()),
        T.StructField("dt", T.DateType()),
    ]
)

#: A message as it arrives.  ``source_topic`` is present when one stream carries several topics.
MESSAGE_ENVELOPE = T.StructType(
    [
        T.StructField("message_id", T.StringType()),
        T.StructField("publish_time", T.TimestampType()),
        T.StructField("source_topic", T.StringType()),
        T.StructField("data", T.BinaryType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    ]
)

#: The generic row every message becomes.
RAW_ROW = T.StructType(
    [
        T.StructField("message_id", T.StringType(), False),
        T.StructField("publish_time", T.TimestampType(), False),
        T.StructField("source_topic", T.StringType(), False),
        T.StructField("ingestion_time", T.TimestampType(), False),
        T.StructField("payload", T.StringType(), False),
        T.StructField("attributes", T.StringType()),
    ]
)

CUSTOMERS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("billing_country", T.StringType()),
        T.StructField("address_hash", T.StringType()),
        T.StructField("row_hash", T.StringType()),
        T.StructField("valid_from", T.TimestampType()),
        T.StructField("valid_to", T.TimestampType()),
    ]
)


def required_columns(schema: T.StructType) -> list[str]:
    """Names of the columns a schema declares as not nullable."""
    return [field.name for field in schema.fields if not field.nullable]
