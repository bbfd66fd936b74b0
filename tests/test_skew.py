import random

import pytest
from pyspark.sql import functions as F

from cairnlake.operators import skew
from helpers import plan, rows


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the probe rows share one key, some keys are NULL or unknown to the build side."""
    draw = random.Random(7)
    keys = ["hot"] * 1000 + [None] * 100 + [f"k{draw.randrange(700)}" for _ in range(1900)]
    probe = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, row int")
    build = spark.createDataFrame(
        [("hot", 1), (None, 2)] + [(f"k{i}", i) for i in range(0, 700, 2)] + [("k4", -4), ("gone", 0)],
        "key string, val int",
    )
    return probe, build


def test_heavy_keys_are_found_with_their_share(sides):
    (heavy,) = skew.heavy_keys(sides[0], "key", 0.01).collect()
    assert heavy.key == "hot" and heavy._share == pytest.approx(1000 / 2900)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_split_join_equals_a_plain_join(sides, how):
    probe, build = sides
    assert rows(skew.split_join(probe, build, "key", how), "key", "row", "val") == rows(
        probe.join(build, "key", how), "key", "row", "val"
    )


def test_a_hot_key_is_spread(sides, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    joined = skew.split_join(*sides, "key").where(F.col("key") == "hot")
    tasks = joined.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) > 1 and max(t["count"] for t in tasks) < 1000


def test_other_join_types_are_refused(sides):
    with pytest.raises(ValueError):
        skew.split_join(*sides, "key", "full")


def test_empty_probe(sides):
    probe, build = sides
    assert skew.split_join(probe.limit(0), build, "key").count() == 0
    assert skew.split_join(probe, build.limit(0), "key", "left").count() == probe.count()


@pytest.mark.parametrize("chunk", [1, 3, 65_536])
def test_repeat_rows(spark, monkeypatch, chunk):
    monkeypatch.setattr(skew, "REPEAT_CHUNK", chunk)
    table = spark.createDataFrame([("a", 1), ("b", 3), ("c", 7), ("d", 0)], "key string, n long")
    assert rows(skew.repeat_rows(table, "n", ("key",))) == {("a",): 1, ("b",): 3, ("c",): 7}


def test_one_hot_row_is_repeated_by_many_tasks(spark, monkeypatch, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    monkeypatch.setattr(skew, "REPEAT_CHUNK", 100)
    table = spark.createDataFrame([("a", 5000)], "key string, n long")
    repeated = skew.repeat_rows(table, "n", ("key",))
    tasks = repeated.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(t["count"] for t in tasks) == 5000 and len(tasks) > 4


def test_only_the_heavy_keys_are_broadcast(sides, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(skew.split_join(*sides, "key"), execute=False)
    assert "SortMergeJoin" in text and "approx_top_k" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_more_partitions_make_smaller_keys_heavy(spark):
    """A key of 0.3 % is a few mean partitions of 2,000, though not of 200."""
    rows_ = spark.range(100_000).select(F.when(F.col("id") % 1000 < 3, -1).otherwise(F.col("id")).alias("key"))
    for partitions, found in ((200, 0), (2000, 1)):
        assert skew.heavy_keys(rows_, "key", skew.heavy_share(partitions)).count() == found


def test_an_aggregate_is_not_shuffled_again(sides, conf):
    """The aggregate's one shuffle, by its key, serves the normal keys and the heavy ones."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    probe, build = sides
    totals = build.groupBy("key").agg(F.sum("val").alias("val"))
    text = plan(skew.split_join(probe, totals, "key")).split("Initial Plan")[0]
    by_key = [line for line in text.splitlines() if " Exchange hashpartitioning(key" in line and "ReusedExchange" not in line]
    # One for the aggregate and one for the probe rows of normal keys; the heavy branch uses the first again.
    assert len(by_key) == 2 and "ReusedExchange" in text and "_salt" not in text
