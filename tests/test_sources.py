import json
import os
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from cairnlake import schemas
from cairnlake.sources import documents, tables
from cairnlake.testbed import bronze, queries

SCHEMA = T.StructType().add("a", T.IntegerType()).add("b", T.IntegerType())
HEADER = (
    "transaction_id,user_id,timestamp,amount,currency,payment_method,status,items,"
    "shipping_address,billing_country\n"
)


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())


def test_json_array_becomes_lines_with_all_members(spark, tmp_path):
    put(tmp_path / "in" / "x.json", ' [{"a": 1, "undeclared": {"k": [1]}},\n {"b": 2}] ')
    put(tmp_path / "in" / "y.json", "[]")
    documents.json_array_to_ndjson(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(lines, key=str) == [{"a": 1, "undeclared": {"k": [1]}}, {"b": 2}]
    records = documents.read_json_array(spark, str(tmp_path / "in"), SCHEMA).collect()
    assert sorted(map(tuple, records), key=str) == [(1, None), (None, 2)]


@pytest.mark.parametrize(
    "text", ["plain words", '[{"a": 1}', '[{"a":1}]\n[{"a":2}]', '[{"a":1}] and more', '{"a":1}', "['a']", ""]
)
def test_anything_but_one_array_stops_the_query(spark, tmp_path, text):
    put(tmp_path / "x.json", text or "\n")
    with pytest.raises(Exception, match="not a JSON array"):
        documents.read_json_array(spark, str(tmp_path), SCHEMA).collect()


def test_member_of_another_type_stops_the_query(spark, tmp_path):
    put(tmp_path / "x.json", '[{"a": "x"}]')
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        documents.read_json_array(spark, str(tmp_path), SCHEMA).collect()


def test_missing_file_stops_the_query(spark, tmp_path):
    with pytest.raises(PySparkException):
        documents.read_json_array(spark, str(tmp_path / "none"), SCHEMA)


def test_file_is_one_unchanged_message(spark, tmp_path):
    put(tmp_path / "sales" / "x.csv", b"a,b\n1,\xff\n")
    topic = F.element_at(F.split("path", "/"), -2)
    (row,) = documents.whole_file_messages(spark, str(tmp_path), topic, "*.csv").collect()
    assert bytes(row.data) == b"a,b\n1,\xff\n" and row.source_topic == "sales"
    assert row.attributes == {} and row.message_id and row.publish_time


def test_clickstream_scan(spark, tmp_path):
    event = {"event_id": "e", "timestamp": "2024-06-15T10:30:00.123456Z", "new_field": 1,
             "properties": {"product_id": "p", "price": 1.5, "quantity": 2}}
    put(tmp_path / "dt=2024-06-15" / "a.json", json.dumps(event) + "\n")
    put(tmp_path / "dt=2024-06-16" / "b.json", json.dumps(event) + "\n" + json.dumps(event))
    table = tables.scan_clickstream(spark, str(tmp_path))
    assert table.schema == schemas.CLICKSTREAM_EVENTS and table.count() == 3
    row = table.where(F.col("dt") == date(2024, 6, 15)).first()
    assert row.timestamp == datetime(2024, 6, 15, 10, 30, 0, 123456)
    assert (row.properties.price, row.properties.quantity, row.properties.category) == (1.5, 2, None)


def test_broken_line_stops_the_scan_unless_allowed(spark, tmp_path):
    put(tmp_path / "dt=2024-06-15" / "a.json", '{"ticket_id": "t"}\n{broken\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        tables.scan_support_tickets(spark, str(tmp_path)).collect()
    assert tables.scan_support_tickets(spark, str(tmp_path), "PERMISSIVE").count() == 2


def test_catalog_scan_keeps_json_and_finds_the_newest_day_with_rows(spark, tmp_path):
    product = {"product_id": "p", "attributes": {"k": [1, {"x": "y"}]}, "tags": ["a", "b"]}
    put(tmp_path / "dt=2024-01-01" / "a.json", json.dumps({"product_id": "old"}))
    put(tmp_path / "dt=2024-01-02" / "a.json", json.dumps(product))
    put(tmp_path / "dt=2024-01-03" / "a.json", "")
    row = tables.scan_newest_catalog(spark, str(tmp_path)).select(
        "product_id", "dt", "tags", F.variant_get("attributes", "$.k[1].x", "string").alias("x")
    ).collect()
    assert row == [("p", date(2024, 1, 2), ["a", "b"], "y")]
    assert tables.scan_product_catalog(spark, str(tmp_path)).count() == 2


def test_sales_scan(spark, tmp_path):
    full = 't1,u1,2024-06-15T10:00:00Z,9.5,USD,card,completed,"[{""product_id"":""p"",""n"":1}]", 1 Main St ,US\n'
    put(tmp_path / "dt=2024-06-15" / "a.csv", HEADER + full + "t2,u2\n" + HEADER + "t3,,,,,,,,,\n")
    found = {r.transaction_id: r for r in tables.scan_sales(spark, str(tmp_path)).collect()}
    assert set(found) == {"t1", "t2", "t3"}
    assert found["t1"]["items"] == '[{"product_id":"p","n":1}]'
    assert found["t1"].shipping_address == " 1 Main St " and found["t1"].amount == 9.5
    assert found["t2"].user_id == "u2" and found["t2"].billing_country is None
    assert found["t3"].user_id is None and found["t3"].dt == date(2024, 6, 15)


@pytest.mark.parametrize(
    "line",
    ['{"ticket_id":"a"} {"ticket_id":"b"}', '{"ticket_id":"c"}garbage', '{"ticket_id":"c"}}', '[{"ticket_id":"d"}]', '{"ticket_id":"e"},',
     '{"ticket_id":"{"}}', '{"ticket_id":"\\\\"} "x"', '{"ticket_id":{"a":{"b":{"c":{"d":{}}}}}} 1', "5"],
)
def test_line_that_is_not_one_object(spark, tmp_path, line):
    put(tmp_path / "dt=2024-06-15" / "a.json", '{"ticket_id":"t"}\n\n  \t\n' + line + "\n")
    scan = tables.scan_support_tickets(spark, str(tmp_path))
    for query in (scan, scan.select("ticket_id"), scan.select("dt"), scan.where(F.col("status") == "x"), scan.groupBy().count()):
        with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
            query.collect()
    kept = tables.scan_ndjson(spark, str(tmp_path), schemas.CUSTOMER_SUPPORT_TICKETS, "PERMISSIVE", "broken")
    assert {(r.ticket_id, r.broken) for r in kept.collect()} == {("t", None), (None, line)}
    dropped = tables.scan_ndjson(spark, str(tmp_path), schemas.CUSTOMER_SUPPORT_TICKETS, "DROPMALFORMED")
    assert [r.ticket_id for r in dropped.collect()] == ["t"]


def test_lines_that_are_one_object(spark, tmp_path):
    odd = ['} {', '\\', '"', '\\"}', "[", "a" * 100_000, '\\"' * 50_000, '"}{"' * 20_000]
    lines = [json.dumps({"ticket_id": str(i), "description": text}) for i, text in enumerate(odd)]
    deep = '{"ticket_id":"deep","other":' + "[" * 30 + '"]"' + "]" * 30 + "}"
    put(tmp_path / "dt=2024-06-15" / "a.json", "\r\n".join([*lines, deep, " {} "]) + "\n")
    found = {r.ticket_id: r.description for r in tables.scan_support_tickets(spark, str(tmp_path)).collect()}
    assert found == {str(i): text for i, text in enumerate(odd)} | {"deep": None, None: None}


def test_value_of_another_type_goes_to_the_broken_column(spark, tmp_path):
    line = '{"ticket_id":"t","satisfaction_score":"many"}'
    put(tmp_path / "dt=2024-06-15" / "a.json", line + "\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        tables.scan_support_tickets(spark, str(tmp_path)).collect()
    (row,) = tables.scan_ndjson(spark, str(tmp_path), schemas.CUSTOMER_SUPPORT_TICKETS, "PERMISSIVE", "broken").collect()
    assert row.broken == line and row.satisfaction_score is None
    with pytest.raises(ValueError, match="mode is one of"):
        tables.scan_support_tickets(spark, str(tmp_path), "LENIENT")


@pytest.mark.parametrize(
    "row",
    [
        "t1,u1,2024-06-15T10:00:00Z,1,USD,card,completed,[],a,US,more",
        "t1,u1,2024-06-15T10:00:00Z,1,USD,card,completed,[],a,,more",
        "t1,u1,2024-06-15T10:00:00Z,1,USD,card,completed,[],a,,",
        't1,u1,2024-06-15T10:00:00Z,1,USD,card,completed,"[]"x,a,US',
        't1,u1,2024-06-15T10:00:00Z,1,USD,card,completed,[],"1 Main St',
        't1,u1,2024-06-15T10:00:00Z,1,USD,card,completed,"a,b",c,d,e',
        "t1,u1,01/02/2024 10:00,1,USD,card,completed,[],a,US",
        "t1,u1,2024-06-15T10:00:00Z,dear,USD,card,completed,[],a,US",
    ],
)
def test_rows_that_do_not_fit_stop_any_query(spark, tmp_path, row):
    put(tmp_path / "dt=2024-06-15" / "a.csv", HEADER + "t0,u0\n" + row + "\n")
    scan = tables.scan_sales(spark, str(tmp_path))
    for query in (scan, scan.select("user_id"), scan.select("dt"), scan.where(F.col("user_id") == "u0"), scan.groupBy().count()):
        with pytest.raises(Exception, match="not a row of sales"):
            query.collect()


def test_sales_with_odd_but_whole_values(spark, tmp_path):
    long = "[" + ",".join(f'{{""n"":""{i}, \'""\'""}}' for i in range(20_000)) + "]"
    quoted = ",".join(f'"{name}"' for name in HEADER.strip().split(","))
    put(
        tmp_path / "dt=2024-06-15" / "a.csv",
        quoted + "\r\n" + f'"t1","u,1",2024-06-15T10:00:00Z,"1",,"","""",\"{long}\","a ""b"", c",US\r\n\r\n   \r\n' + HEADER + "t2\r\n",
    )
    found = {r.transaction_id: r for r in tables.scan_sales(spark, str(tmp_path)).collect()}
    assert set(found) == {"t1", "t2"} and found["t1"].user_id == "u,1" and found["t1"].shipping_address == 'a "b", c'
    assert found["t1"]["items"] == long.replace('""', '"') and found["t1"].status == '"' and found["t1"].amount == 1.0
    assert found["t1"].currency is None and found["t2"].user_id is None
    assert tables.scan_sales(spark, str(tmp_path)).count() == 2


@pytest.mark.parametrize(
    "row, message",
    [
        ('t1,u1,2024-06-15T10:00:00Z,"1,234.50",USD,card,completed,[],a,US\n', "CAST_INVALID_INPUT"),
        ("t1,u1,01/02/2024 10:00,1,USD,card,completed,[],a,US\n", "CAST_INVALID_INPUT"),
        ("t1,u1,2024-06-15T10:00:00Z,1,USD,card,completed,[],a,US,more,values\n", "not a row of sales"),
        ('t1,u1,2024-06-15T10:00:00Z,1,USD,card,completed,[],"1 Main St\nUpstairs",US\n', "not a row of sales"),
    ],
)
def test_sales_that_do_not_fit_stop_the_scan(spark, tmp_path, row, message):
    put(tmp_path / "dt=2024-06-15" / "a.csv", HEADER + row)
    with pytest.raises(Exception, match=message):
        tables.scan_sales(spark, str(tmp_path)).collect()


def sales_tables(spark, folder):
    """Orders and lines that repeat, that have no partner and no key."""
    day = datetime(1995, 1, 1)
    orders = [(k, k % 7 if k else 1, "FOP"[(k or 0) % 3], 10.5 + (k or 0), day.replace(month=1 + (k or 0) % 12), "1-URGENT") for k in [None, None, 5, 5, *range(60)]]
    lines = [(k, n, n, n, 2.0, 3.25 + n) for k in [None, 5, 77, *range(0, 60, 2)] for n in range(1, 5)]
    tables = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double"),
        "customer": ([(c, (c or 0) % 2) for c in [None, 3, *range(6)]], "c_custkey long, c_nationkey int"),
        "nation": ([(0, "PERU"), (1, "VIETNAM, NORTH")], "n_nationkey int, n_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_parts_of_sales_are_all_sales(spark, tmp_path):
    """Every order is in one part with its lines, repeated orders and orders and lines without a key too."""
    folder = sales_tables(spark, tmp_path)
    whole = bronze.sales_transactions(spark, folder).collect()
    parts = [bronze.sales_transactions(spark, folder, (number, 3)).collect() for number in range(3)]
    assert all(parts) and len(whole) > 150
    assert sorted(map(str, sum(parts, []))) == sorted(map(str, whole))


def test_sales_text_takes_little_disk(spark, tmp_path, monkeypatch):
    """Sales are written in parts, as compressed text; the shuffles of a part go with it."""
    folder, paths, left = sales_tables(spark, tmp_path), [], []
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = manager.getAllFiles()
        return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}

    write, before = queries.write_text_table, shuffled()

    def watched(table, path, *others):
        write(table, path, *others)
        paths.append(path)
        left.append(shuffled() - before)

    monkeypatch.setattr(queries, "write_text_table", watched)
    monkeypatch.setattr(queries, "PART_BYTES", 500)
    found = queries.scan_sales_csv(spark, folder)
    assert len(paths) > 2 and len(set(paths)) == 1 and not any(left)
    whole = bronze.sales_transactions(spark, folder)
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.select(*found.columns).collect()))
    files = [name for _, _, names in os.walk(paths[0].removeprefix("file://")) for name in names if name.startswith("part-")]
    assert files and all(name.endswith(".csv.gz") for name in files)
