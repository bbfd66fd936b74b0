import json
from datetime import datetime

import pytest

from cairnlake import schemas
from cairnlake.functions import topics
from cairnlake.streaming.landing import landed_names, landing_folder


def test_routes_name_bucket_prefix_and_extension():
    routes = topics.landing_routes("demo", "acme")
    assert set(routes) == set(topics.raw_table_map("demo")) and len(routes) == 4
    assert routes["projects/demo/topics/clickstream-topic"] == ("acme-bronze-events", "clickstream", "json")
    assert {route.extension for route in routes.values()} == {"json", "csv"}


def test_routes_from_a_file(tmp_path):
    config = tmp_path / "config.json"
    config.write_text(json.dumps({"topic_bucket_map": {"a/t": ["b", "p", "csv"]}}))
    assert topics.load_landing_routes(str(config)) == {"a/t": topics.LandingRoute("b", "p", "csv")}
    config.write_text("{topic: a/t}")
    with pytest.raises(json.JSONDecodeError):
        topics.load_landing_routes(str(config))
    with pytest.raises(FileNotFoundError):
        topics.load_landing_routes(str(tmp_path / "none.json"))


def test_landed_name(spark):
    routes = topics.landing_routes("demo", "acme")
    message = ("m", datetime(2021, 11, 9, 8, 7, 6), "projects/demo/topics/clickstream-topic", b"x", {})
    other = ("n", datetime(2021, 11, 9, 8, 7, 6), "projects/demo/topics/unknown", b"x", {})
    messages = spark.createDataFrame([message, other], schemas.MESSAGE_ENVELOPE)
    (row,) = landed_names(messages, topics.route_table(spark, routes)).collect()
    assert row.bucket == "acme-bronze-events"
    assert row.object_name == (
        "pubsub-data/clickstream-topic/dt=2021-11-09/clickstream_2021-11-09_08-07-06.json"
    )
    assert landing_folder("/r/", message[2], routes[message[2]]) == (
        "/r/acme-bronze-events/pubsub-data/clickstream-topic"
    )
