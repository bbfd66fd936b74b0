import glob
from datetime import date, datetime

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from cairnlake import schemas
from cairnlake.functions import topics
from cairnlake.sources import tables
from cairnlake.sources.messages import file_messages
from cairnlake.storage import Storage
from cairnlake.streaming import landing, raw_ingest
from helpers import rows

TABLES = topics.raw_table_map("demo")
ROUTES = topics.landing_routes("demo", "acme")
CLICKS, TICKETS, CATALOG, SALES = ROUTES
DAY = datetime(2024, 6, 15, 10, 30)


def publish(spark, folder, *messages):
    """Append (id, topic, data) messages to the source folder."""
    spark.createDataFrame(
        [(i, DAY, topic, data, {}) for i, topic, data in messages], schemas.MESSAGE_ENVELOPE
    ).coalesce(1).write.mode("append").parquet(str(folder))


def ingest(spark, tmp_path, **options):
    stream = raw_ingest.start_raw_ingest(
        file_messages(spark, str(tmp_path / "in")), str(tmp_path / "cp"), TABLES, **options
    )
    assert stream.awaitTermination(120)


def test_raw_ingest_appends_and_restarts_where_it_stopped(spark, tmp_path):
    out = str(tmp_path / "out")
    publish(spark, tmp_path / "in", ("1", CLICKS, b"{}"), ("2", "x/unknown", b"a,b"))
    ingest(spark, tmp_path, path=out)
    ingest(spark, tmp_path, path=out)
    assert rows(spark.read.parquet(out), "message_id", "target_table") == {
        ("1", "clickstream_raw"): 1, ("2", "streaming_raw"): 1
    }
    publish(spark, tmp_path / "in", ("3", SALES, b"\xff"))
    ingest(spark, tmp_path, path=out)
    assert rows(spark.read.parquet(out), "message_id", "payload") == {
        ("1", "{}"): 1, ("2", '{"raw":"a,b"}'): 1, ("3", '{"raw_b64":"/w=="}'): 1
    }


def test_a_batch_that_is_delivered_again_is_not_written_twice(spark, tmp_path):
    """The source batch was written but its commit got lost, as when the driver dies in between."""
    out = str(tmp_path / "out")
    publish(spark, tmp_path / "in", ("1", CLICKS, b"{}"))
    ingest(spark, tmp_path, path=out)
    (tmp_path / "cp" / "commits" / "0").unlink()
    (tmp_path / "cp" / "commits" / ".0.crc").unlink()
    ingest(spark, tmp_path, path=out)
    assert rows(spark.read.parquet(out), "message_id") == {("1",): 1}


def test_a_failed_batch_is_delivered_again(spark, tmp_path):
    """Nothing of a batch is kept if one of its messages cannot be written; a later start has all of it."""
    publish(spark, tmp_path / "in", ("1", CLICKS, b"{}"), ("2", CLICKS, b"[]"))
    messages = file_messages(spark, str(tmp_path / "in"))
    failing = messages.withColumn(
        "message_id", F.when(F.col("message_id") == "1", "1").otherwise(F.raise_error(F.lit("down")))
    )
    place = {"checkpoint": str(tmp_path / "cp"), "tables": TABLES, "path": str(tmp_path / "out")}
    with pytest.raises(StreamingQueryException):
        raw_ingest.start_raw_ingest(failing, **place).awaitTermination(120)
    raw_ingest.start_raw_ingest(messages, **place).awaitTermination(120)
    assert rows(spark.read.parquet(place["path"]), "message_id") == {("1",): 1, ("2",): 1}


def test_stream_equals_batch(spark, tmp_path):
    messages = [(str(i), CLICKS, d) for i, d in enumerate([b"{}", b"1", b"x", b"", b"\xff", b'["a"]'])]
    publish(spark, tmp_path / "in", *messages)
    ingest(spark, tmp_path, path=str(tmp_path / "out"))
    batch = raw_ingest.raw_rows(spark.read.schema(schemas.MESSAGE_ENVELOPE).parquet(str(tmp_path / "in")))
    compared = ("message_id", "publish_time", "source_topic", "payload", "attributes")
    assert rows(spark.read.parquet(str(tmp_path / "out")), *compared) == rows(batch, *compared)


def test_raw_ingest_into_a_catalog_table(spark, tmp_path):
    publish(spark, tmp_path / "in", ("1", CLICKS, b"{}"))
    spark.sql("DROP TABLE IF EXISTS clicks_in_test")
    ingest(spark, tmp_path, table="clicks_in_test", override="clicks_in_test", source_topic="t")
    assert rows(spark.table("clicks_in_test"), "source_topic", "target_table") == {("t", "clicks_in_test"): 1}
    spark.sql("DROP TABLE clicks_in_test")


def test_missing_required_value_stops_the_stream(spark, tmp_path):
    publish(spark, tmp_path / "in", (None, CLICKS, b"{}"))
    with pytest.raises(StreamingQueryException):
        ingest(spark, tmp_path, path=str(tmp_path / "out"))


def land(spark, tmp_path, timeout=None):
    streams = landing.start_landing(
        file_messages(spark, str(tmp_path / "in")), str(tmp_path / "land"), str(tmp_path / "cp"), ROUTES
    )
    return landing.finish(streams, timeout)


def test_landed_files_feed_the_bronze_scans(spark, tmp_path):
    header = ",".join(f.name for f in schemas.SALES_TRANSACTIONS if f.name != "dt")
    csv = (header + "\nt{},u,2024-06-15T00:00:00Z,1.5,USD,card,completed,[],a,US").format
    publish(
        spark,
        tmp_path / "in",
        ("1", CLICKS, b'{"event_id":"e1"}\n{"event_id":"e2"}'),
        ("2", SALES, csv(1).encode()),
        ("3", SALES, csv(2).encode()),
        ("4", "x/unknown", b"never read"),
    )
    assert land(spark, tmp_path)
    assert land(spark, tmp_path)
    clicks = tables.scan_clickstream(spark, landing.landing_folder(str(tmp_path / "land"), CLICKS, ROUTES[CLICKS]))
    assert rows(clicks, "event_id", "dt") == {("e1", date(2024, 6, 15)): 1, ("e2", date(2024, 6, 15)): 1}
    sold = tables.scan_sales(spark, landing.landing_folder(str(tmp_path / "land"), SALES, ROUTES[SALES]))
    assert rows(sold, "transaction_id", "amount") == {("t1", 1.5): 1, ("t2", 1.5): 1}


def test_landed_bytes_are_unchanged(spark, tmp_path):
    publish(spark, tmp_path / "in", ("1", CATALOG, b"\xff\xfe\x00\x01"))
    assert land(spark, tmp_path, timeout=120)
    pattern = landing.landing_folder(str(tmp_path / "land"), CATALOG, ROUTES[CATALOG])
    (path,) = glob.glob(f"{pattern}/dt=2024-06-15/*/part-*")
    with open(path, "rb") as landed:
        assert landed.read() == b"\xff\xfe\x00\x01\n"


def test_a_broken_off_batch_lands_once(spark, tmp_path, monkeypatch):
    """The driver dies after it has placed some folders of a batch, and again after all; files of no batch are lost or twice."""
    publish(spark, tmp_path / "in", ("1", CLICKS, b"{}"), ("2", SALES, b"a"), ("3", TICKETS, b"{}"), ("4", CLICKS, b"[]"))
    move, moved = Storage.move, []

    def dies(self, source, target):
        if len(moved) == 2:
            raise RuntimeError("died")
        moved.append(target)
        return move(self, source, target)

    monkeypatch.setattr(Storage, "move", dies)
    with pytest.raises(StreamingQueryException):
        land(spark, tmp_path)
    monkeypatch.setattr(Storage, "move", move)
    writer = landing.batch_writer(spark, str(tmp_path / "land"), str(tmp_path / "cp"), ROUTES)

    def breaks_off(batch, number):
        writer(batch, number)
        raise RuntimeError("died")

    stream = file_messages(spark, str(tmp_path / "in")).writeStream.foreachBatch(breaks_off)
    with pytest.raises(StreamingQueryException):
        stream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination(120)
    assert land(spark, tmp_path)
    publish(spark, tmp_path / "in", ("5", CLICKS, b"5"))
    assert land(spark, tmp_path)
    found = {
        topic: sorted(r.value for r in spark.read.text(landing.landing_folder(str(tmp_path / "land"), topic, ROUTES[topic])).collect())
        for topic in (CLICKS, SALES, TICKETS)
    }
    assert found == {CLICKS: ["5", "[]", "{}"], SALES: ["a"], TICKETS: ["{}"]}
    assert not glob.glob(str(tmp_path / "land" / "_landing" / "*"))


def test_a_batch_reads_its_source_once(spark, tmp_path):
    """Whatever the number of topics, one job of one scan writes a batch."""
    publish(spark, tmp_path / "in", *((str(i), topic, b"x") for i, topic in enumerate(ROUTES)))
    read = spark.sparkContext.accumulator(0)
    seen = file_messages(spark, str(tmp_path / "in")).mapInArrow(
        lambda batches: (read.add(batch.num_rows) or batch for batch in batches), schemas.MESSAGE_ENVELOPE
    )
    assert landing.finish(landing.start_landing(seen, str(tmp_path / "land"), str(tmp_path / "cp"), ROUTES), 120)
    assert read.value == len(ROUTES)


def test_drain_stops_after_its_time(spark, tmp_path):
    publish(spark, tmp_path / "in", ("1", CLICKS, b"{}"))
    streams = landing.start_landing(
        {CLICKS: file_messages(spark, str(tmp_path / "in"))},
        str(tmp_path / "land"),
        str(tmp_path / "cp"),
        {CLICKS: ROUTES[CLICKS]},
        drain=False,
        interval="1 second",
    )
    assert landing.finish(streams, timeout=3) is False
    assert not streams[0].isActive
