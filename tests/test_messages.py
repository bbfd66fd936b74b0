import json
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cairnlake import schemas
from cairnlake.functions import messages as msg, topics
from cairnlake.operators.quality import refuse_null
from cairnlake.plans.typed_payload import typed_payload
from cairnlake.sources.messages import from_kafka, merge_topics, of_topic
from cairnlake.streaming import raw_ingest

TOPIC = "projects/lab/topics/clickstream-topic"
PUBLISHED = datetime(2023, 2, 28, 23, 59, 58, 7)


def envelope(spark, *data, attributes=None, published=PUBLISHED):
    return spark.createDataFrame(
        [(f"m{i}", published, TOPIC, d, attributes) for i, d in enumerate(data)],
        schemas.MESSAGE_ENVELOPE,
    )


def payload(spark, data):
    (row,) = raw_ingest.parse_message(envelope(spark, data)).collect()
    return json.loads(row.payload)


@pytest.mark.parametrize(
    "data,expected",
    [
        (b'{"kind":"tap","by":{"id":"k7"}}', {"kind": "tap", "by": {"id": "k7"}}),
        (b' [ {"z": 0.5}, 7, null ]\n', [{"z": 0.5}, 7, None]),
        (b" { } ", {}),
        (b"-4.25e1", -42.5),
        (b'"e100"', "e100"),
        (b"false", False),
        (b"", {"raw": ""}),
        (None, {"raw": ""}),
        (b"7;eight;9.0", {"raw": "7;eight;9.0"}),
        (b"h1,h2\r\nx,y\r\n", {"raw": "h1,h2\r\nx,y\r\n"}),
        (b'{"q":7}\n{"q":8}\n', {"raw": '{"q":7}\n{"q":8}\n'}),
        (b"{'q':7}", {"raw": "{'q':7}"}),
        (b"NaN", {"raw": "NaN"}),
        (b"\xc3\x28 broken pair", {"raw_b64": "wyggYnJva2VuIHBhaXI="}),
        (b"\xed\xa0\x80", {"raw_b64": "7aCA"}),
        (b"cut \xe2\x82", {"raw_b64": "Y3V0IOKC"}),
        ("naïve, ₤9".encode(), {"raw": "naïve, ₤9"}),
    ],
)
def test_payload(spark, data, expected):
    assert payload(spark, data) == expected


@pytest.mark.parametrize("more", ["", ',"u":"/e100"', ',"u":"page123 \\" 1e999"', ',"id":"' + "7" * 50 + '"'])
def test_strings_do_not_keep_a_payload_from_its_normal_form(spark, more):
    text = '{"b": 1, "a": 1, "a": 2' + more + "}"
    (row,) = raw_ingest.parse_message(envelope(spark, text.encode())).collect()
    assert row.payload == json.dumps(json.loads(text), separators=(",", ":"), sort_keys=True)


@pytest.mark.parametrize("number", ["123456789012345678901234567890.12345678901", "1e400", "12345678901234567e3"])
def test_numbers_that_would_lose_digits_stay(spark, number):
    (row,) = raw_ingest.parse_message(envelope(spark, f'{{"n": {number}}}'.encode())).collect()
    assert number in row.payload


def test_long_base64_stays_on_one_line(spark):
    assert "\n" not in payload(spark, b"\xff" * 500)["raw_b64"]


def test_raw_row_fields(spark):
    (row,) = raw_ingest.raw_rows(envelope(spark, b"{}", attributes={"site": "north", "try": "2"})).collect()
    assert list(row.asDict()) == schemas.RAW_ROW.fieldNames()
    assert (row.message_id, row.source_topic, row.publish_time) == ("m0", TOPIC, PUBLISHED)
    assert json.loads(row.attributes) == {"site": "north", "try": "2"}
    assert row.ingestion_time is not None


@pytest.mark.parametrize("attributes", [None, {}])
def test_no_attributes_give_null(spark, attributes):
    assert raw_ingest.raw_rows(envelope(spark, b"{}", attributes=attributes)).first().attributes is None


def test_topic_name_and_default_publish_time(spark):
    raw = raw_ingest.raw_rows(envelope(spark, b"{}", published=None), "other").first()
    assert raw.source_topic == "other" and raw.publish_time == raw.ingestion_time


def test_wire_time(spark):
    row = envelope(spark, b"").select(msg.wire_time(F.col("publish_time")).alias("t")).first()
    assert row.t == "2023-02-28 23:59:58.000007 UTC"


def test_equal_messages_each_stay(spark):
    raw = raw_ingest.raw_rows(envelope(spark, b"[]", b"[]", b"", b""))
    assert sorted(r.message_id for r in raw.collect()) == ["m0", "m1", "m2", "m3"]


def test_routing(spark):
    tables = topics.raw_table_map("lab")
    raw = raw_ingest.raw_rows(envelope(spark, b"{}"))
    assert raw_ingest.routed(raw, tables).first().target_table == "clickstream_raw"
    assert raw_ingest.routed(raw, tables, "mine").first().target_table == "mine"
    assert raw_ingest.routed(raw, topics.raw_table_map("x")).first().target_table == "streaming_raw"
    assert raw_ingest.routed(raw, {}).first().target_table == "streaming_raw"


def test_required_values_are_enforced(spark):
    raw = raw_ingest.raw_rows(envelope(spark, b"{}")).withColumn("message_id", F.lit(None).cast("string"))
    with pytest.raises(PySparkException, match="message_id is NULL"):
        refuse_null(raw, schemas.required_columns(schemas.RAW_ROW)).collect()


def test_kafka_records_as_messages(spark):
    records = spark.createDataFrame(
        [
            (b"v", TOPIC, 1, 7, PUBLISHED, [("a", b"1"), ("b", b"2"), ("a", b"3")]),
            (b"w", TOPIC, 1, 8, PUBLISHED, None),
        ],
        "value binary, topic string, partition int, offset long, timestamp timestamp, "
        "headers array<struct<key:string,value:binary>>",
    )
    first, second = sorted(from_kafka(records).collect())
    assert first.message_id == f"{TOPIC}/1/7" and bytes(first.data) == b"v"
    assert first.attributes == {"a": "3", "b": "2"} and second.attributes == {}


def test_topics_come_together(spark):
    one = envelope(spark, b"1").drop("source_topic")
    merged = merge_topics({"x": one, "y": one})
    assert sorted(r.source_topic for r in merged.collect()) == ["x", "y"]
    assert of_topic(merged, "y").count() == 1


def typed(spark, schema, *data):
    table = typed_payload(raw_ingest.raw_rows(envelope(spark, *data)), schema)
    return in_order((r.message_id, r.record and r.record[0], r.broken) for r in table.collect())


def in_order(found):
    return sorted(found, key=lambda r: tuple(map(str, r)))


def test_typed_payload_of_objects_and_arrays(spark):
    assert typed(
        spark,
        schemas.CLICKSTREAM_EVENTS,
        b'{"event_id":"e1","properties":{"price":1.5}}',
        b' [{"event_id":"e100"},{"event_id":"e2"}]',
        b'[{"event_id":"a"},5,{"event_id":"b","properties":{"quantity":"many"}}]',
        b"\xff",
        b"[]",
    ) == in_order([
        ("m0", "e1", None),
        ("m1", "e100", None),
        ("m1", "e2", None),
        ("m2", "a", None),
        ("m2", None, "5"),
        ("m2", None, '{"event_id":"b","properties":{"quantity":"many"}}'),
        ("m3", None, None),
    ])


@pytest.mark.parametrize(
    "schema, key",
    [
        (schemas.CLICKSTREAM_EVENTS, "event_id"),
        (schemas.CUSTOMER_SUPPORT_TICKETS, "ticket_id"),
        (schemas.PRODUCT_CATALOG, "product_id"),
        (schemas.SALES_TRANSACTIONS, "transaction_id"),
    ],
)
def test_typed_payload_of_a_file_of_lines(spark, schema, key):
    data = f'{{"{key}":"1"}}\r\n\n{{"{key}":"2"}} {{"{key}":"lost?"}}\n{{"{key}":"3"}}\n'
    assert typed(spark, schema, data.encode()) == in_order(
        [("m0", "1", None), ("m0", "3", None), ("m0", None, f'{{"{key}":"2"}} {{"{key}":"lost?"}}')])


def test_typed_payload_of_a_csv_file(spark):
    header = ",".join(f.name for f in schemas.SALES_TRANSACTIONS if f.name != "dt")
    good = 's1,u,2024-06-15T10:00:00Z,9.5,USD,card,completed,"[{""product_id"":""p""}]",a,US'
    bad = "s2,u,2024-06-15T10:00:00Z,nine,USD,card,completed,[],a,US"
    assert typed(spark, schemas.SALES_TRANSACTIONS, f"{header}\n{good}\n{bad}\n{header}\n".encode()) == in_order(
        [("m0", "s1", None), ("m0", None, bad)])


def test_typed_payload_of_a_csv_file_with_line_breaks_in_values(spark):
    names = [f.name for f in schemas.SALES_TRANSACTIONS if f.name != "dt"]
    header = ",".join(f'"{name}"' for name in names)
    address = '1 Main St\r\n\n"Up"stairs, \x01n left'
    quoted = address.replace('"', '""')
    good = f's1,u,2024-06-15T10:00:00Z,9.5,USD,card,completed,"[]","{quoted}",US'
    more = "s2,u,2024-06-15T10:00:00Z,9.5,USD,card,completed,[],a,US,surplus"
    more_after_empty = "s3,u,2024-06-15T10:00:00Z,9.5,USD,card,completed,[],a,,surplus"
    data = "\r\n".join([header, good, "  ", more, more_after_empty, header]) + "\n"
    table = typed_payload(raw_ingest.raw_rows(envelope(spark, data.encode())), schemas.SALES_TRANSACTIONS)
    found = {(r.record and r.record.transaction_id, r.record and r.record.shipping_address, r.broken) for r in table.collect()}
    assert {f for f in found if f[0]} <= {("s1", address, None), ("s1", address.replace("\r\n", "\n"), None)}
    assert {f[2] for f in found} == {None, more, more_after_empty} and len(found) == 3


def test_typed_payload_keeps_no_payload(spark):
    table = typed_payload(raw_ingest.raw_rows(envelope(spark, b"[{},{}]")), schemas.CLICKSTREAM_EVENTS)
    assert "payload" not in table.columns and table.count() == 2


def test_typed_payload_splits_a_payload_once(spark):
    """No filter on the records of a payload that would split it once more; a payload without records still gives none."""
    table = typed_payload(raw_ingest.raw_rows(envelope(spark, b"a,b\nc\n", b"[]", b"", b'{"raw":"\\n \\n"}')), schemas.SALES_TRANSACTIONS)
    optimized = table._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("json_object_keys(") + optimized.count("jsonObjectKeys(") == 1
    assert sorted((r.message_id, r.broken) for r in table.collect()) == [("m0", "a,b"), ("m0", "c")]
