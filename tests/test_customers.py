import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cairnlake import schemas
from cairnlake.operators.upsert import keyed_upsert
from cairnlake.plans import customers
from cairnlake.session import configure
from helpers import plan, rows

TWO = [
    ("p-31", "ana", datetime(2022, 3, 4, 5, 6), "Low Row 3", "NL"),
    ("p-32", "bo", datetime(2022, 3, 4, 7, 8), "High Row 8", "SE"),
]


def sales(spark, entries, dt=date(2022, 3, 4)):
    return spark.createDataFrame(
        [
            (t, u, when, 1.0, "USD", "card", "completed", "[]", address, country, dt)
            for t, u, when, address, country in entries
        ],
        schemas.SALES_TRANSACTIONS,
    )


def empty(spark):
    return spark.createDataFrame([], schemas.CUSTOMERS)


def test_first_run_stores_both_customers_and_a_rerun_changes_nothing(spark):
    snapshot = customers.customer_snapshots(sales(spark, TWO))
    first = customers.merge(snapshot, empty(spark))
    assert rows(first) == rows(snapshot) and first.count() == 2
    again = customers.merge(snapshot, spark.createDataFrame(first.collect(), schemas.CUSTOMERS))
    assert rows(again) == rows(first)


def test_moved_customer_gets_a_closed_and_an_open_version(spark):
    before = customers.customer_snapshots(sales(spark, TWO))
    stored = spark.createDataFrame(before.collect(), schemas.CUSTOMERS)
    moved = [("p-39", "ana", datetime(2022, 9, 1), "Mid Row 5", "NL"), TWO[1]]
    after = customers.merge(customers.customer_snapshots(sales(spark, moved)), stored)
    ends = sorted((r.user_id, r.valid_from.month, r.valid_to) for r in after.collect() if r.valid_to)
    assert ends == [("ana", 3, datetime(2022, 9, 1))]
    assert after.count() == 3 and customers.open_versions_per_user(after).isEmpty()


def test_rank_comes_before_the_address_filter(spark):
    entries = [
        ("t1", "u", datetime(2025, 1, 1), None, "US"),
        ("t2", "u", datetime(2025, 1, 2), "later address", "US"),
        ("t3", None, datetime(2025, 1, 1), "a", "US"),
        ("t5", "v", datetime(2025, 1, 1), "tie b", "US"),
        ("t4", "v", datetime(2025, 1, 1), "tie a", "US"),
    ]
    (row,) = customers.customer_snapshots(sales(spark, entries)).collect()
    assert row.user_id == "v"
    first = customers.first_transaction_per_user(sales(spark, entries))
    assert sorted(r.transaction_id for r in first.collect()) == ["t1", "t4"]


def test_literal_and_intended_partition_filter(spark):
    history = sales(spark, [TWO[0]], date(2025, 7, 1)).union(sales(spark, [TWO[1]], date(2025, 7, 2)))
    literal = customers.customer_snapshots(history)
    newest = customers.customer_snapshots(history, latest_only=True)
    older = customers.customer_snapshots(history, latest_only=True, until=F.lit(date(2025, 7, 1)))
    assert literal.count() == 2
    assert [r.user_id for r in newest.collect()] == ["bo"]
    assert [r.user_id for r in older.collect()] == ["ana"]


@pytest.fixture(scope="module")
def random_state(spark):
    """Random versions, one user holding a third of them, against one snapshot row per user."""
    draw = random.Random(3)
    day = datetime(2025, 1, 1)
    users = [f"u{i}" for i in range(60)] + ["hot"]
    snapshot = [(u, "US", "a", f"h{draw.randrange(4)}-{u}", day.replace(month=6), None) for u in users[5:]]
    stored = {("hot", f"h{i}-hot") for i in range(150)}
    stored |= {(f"u{draw.randrange(60)}", None) for _ in range(300)}
    versions, seen = [], set()
    for user, row_hash in sorted(stored, key=str):
        for number in range(1 if row_hash else draw.randrange(1, 5)):
            key = (user, row_hash or f"h{number}-{user}")
            if key not in seen:
                seen.add(key)
                closed = day.replace(month=2) if draw.random() < 0.4 else None
                versions.append((*key[:1], "BR", "b", key[1], day, closed))
    as_table = lambda data: spark.createDataFrame(data, schemas.CUSTOMERS).persist()
    return as_table(snapshot), as_table(versions), snapshot, versions


@pytest.mark.parametrize("only_open", [False, True])
def test_change_set_and_merge_against_brute_force(random_state, only_open):
    snapshot, stored, snapshot_rows, versions = random_state
    closed = [
        (*t[:5], s[4])
        for s in snapshot_rows
        for t in versions
        if s[0] == t[0] and s[3] != t[3] and not (only_open and t[5])
    ]
    added = [s for s in snapshot_rows for _ in range(max(1, sum(t[0] == s[0] for t in versions)))]
    changes = sorted(closed + added, key=str)
    found = customers.delta(snapshot, stored, only_open)
    assert sorted((tuple(r) for r in found.collect()), key=str) == changes

    merged = {(t[0], t[3]): t for t in versions} | {(c[0], c[3]): c for c in changes}
    expected = sorted(merged.values(), key=str)
    result = customers.merge(snapshot, stored, only_open)
    assert sorted((tuple(r) for r in result.collect()), key=str) == expected
    upserted = keyed_upsert(stored, found.distinct(), customers.KEY)
    assert sorted((tuple(r) for r in upserted.collect()), key=str) == expected


@pytest.mark.parametrize("only_open", [False, True])
def test_touched_dates_are_those_on_which_the_merge_changes_a_row(spark, random_state, only_open):
    snapshot, stored, _, _ = random_state
    # Dates that differ, so that some stay as they are.
    moved = stored.withColumn("valid_from", F.expr("valid_from - make_dt_interval(pmod(hash(row_hash), 400))"))
    same = snapshot.limit(20).unionByName(moved)
    current = spark.createDataFrame(
        {(r.user_id, r.row_hash): r for r in same.collect()}.values(), schemas.CUSTOMERS
    )
    before = rows(current.withColumn("date", F.to_date("valid_from")))
    after = rows(customers.merge(snapshot, current, only_open).withColumn("date", F.to_date("valid_from")))
    changed = {row[-1] for row in (before - after) + (after - before)}
    found = {row["date"] for row in customers.touched_dates(snapshot, current, only_open).collect()}
    assert found == changed and 20 < len(changed) < len({row[-1] for row in before | after})


def test_upsert_never_matches_null_keys(spark):
    table = spark.createDataFrame([("a", None, 1), ("b", "x", 1)], "k string, l string, v int")
    source = spark.createDataFrame([("a", None, 2), ("b", "x", 2)], "k string, l string, v int")
    assert rows(keyed_upsert(table, source, ["k", "l"])) == {
        ("a", None, 1): 1, ("a", None, 2): 1, ("b", "x", 2): 1
    }


def many_sales(spark, path):
    """Sales of 300 users, and stored versions of which one user has two fifths."""
    many = [(f"p-{i}", f"u{i % 300}", datetime(2022, 3, 4), f"Row {i}", "NL") for i in range(600)]
    sales(spark, many).write.parquet(path)
    snapshot = customers.customer_snapshots(spark.read.parquet(path))
    versions = [tuple(r) for r in snapshot.collect()]
    versions += [("u7", "NL", "a", f"h{i}", datetime(2021, 1, 1), None) for i in range(200)]
    return snapshot, spark.createDataFrame(versions, schemas.CUSTOMERS)


def test_change_set_and_merge_do_not_shuffle_the_snapshot_again(spark, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    snapshot, current = many_sales(spark, str(tmp_path / "s"))
    for found in (customers.merge(snapshot, current), customers.close_out(snapshot, current)):
        text = plan(found).split("Initial Plan")[0]
        shuffles = [li for li in text.splitlines() if "Exchange hashpartitioning(user_id" in li and "Reused" not in li]
        # The ranked sales and the stored versions, once each.
        assert len(shuffles) == 2 and "_salt" not in text


def test_merge_ranks_the_sales_once(spark, tmp_path, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    snapshot, current = many_sales(spark, str(tmp_path / "s"))
    merged = customers.merge(snapshot, current)
    text = plan(merged).split("Initial Plan")[0]
    assert "ReusedExchange" in text
    assert text.index("WindowGroupLimit") < text.index("FileScan")


def test_rows_are_dealt_out_before_they_are_ranked(spark, tmp_path, conf):
    """A single wide partition is not sorted by a single task, not even if one user has most of it."""
    many = spark.range(60_000, numPartitions=1).select(
        F.concat(F.lit("t"), F.sha2(F.col("id").cast("string"), 256)).alias("transaction_id"),
        F.when(F.col("id") % 3 > 0, F.lit("heavy")).otherwise(F.concat(F.lit("u"), F.col("id") % 100)).alias("user_id"),
        F.timestamp_seconds(1_600_000_000 - F.col("id") % 5_000).alias("timestamp"),
    )
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    first = customers.first_transaction_per_user(many)
    found = {r.user_id: (r.timestamp, r.transaction_id) for r in first.collect()}
    want = {}
    for r in many.collect():
        want[r.user_id] = min(want.get(r.user_id, (r.timestamp, r.transaction_id)), (r.timestamp, r.transaction_id))
    assert found == want and len(want) == 101
    text = plan(first).split("Initial Plan")[0]
    dealt = text.index("REBALANCE_PARTITIONS_BY_COL")
    assert text.rindex("WindowGroupLimit") < dealt and text.rindex("Sort ") < dealt


def test_a_task_ranks_a_bounded_share_of_the_rows(spark):
    """Rows of less than Spark's 64 MB are ranked by several tasks; a session's own size of partitions is kept."""
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "63MB")
    assert configure(own).conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "63MB"
    session = configure(spark.newSession())
    session.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    session.conf.set("spark.sql.shuffle.partitions", "64")
    many = session.range(500_000, numPartitions=4).select(
        F.sha2(F.col("id").cast("string"), 256).alias("transaction_id"),
        F.concat(F.lit("u"), F.floor(F.col("id") / 2)).alias("user_id"),
        F.timestamp_seconds(1_600_000_000 - F.col("id")).alias("timestamp"),
    )
    first = customers.first_transaction_per_user(many)
    tasks = first.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) > 1 and sum(r["count"] for r in tasks) == 250_000
    assert first.where(F.unix_timestamp("timestamp") % 2 == 0).isEmpty()


def test_a_task_combines_a_bounded_share_of_a_file(spark, tmp_path):
    """A file of less than Spark's 128 MB is read by several tasks; a session's own size of splits is kept."""
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", "127MB")
    assert configure(own).conf.get("spark.sql.files.maxPartitionBytes") == "127MB"
    session = configure(spark.newSession())
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    path = str(tmp_path / "lines")
    keys = session.range(6_000_000, numPartitions=1).select(F.xxhash64("id").alias("key"))
    keys.write.option("parquet.block.size", 4 << 20).parquet(path)
    tasks = session.read.parquet(path).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in tasks) == 6_000_000
    assert len(tasks) > 1 and max(r["count"] for r in tasks) * 8 < 36 << 20


def test_a_task_holds_one_join_of_a_union(spark):
    """Two joins by one key stay apart when their rows are put together; a session's own choice is kept."""
    own = spark.newSession()
    own.conf.set("spark.sql.unionOutputPartitioning", "true")
    assert configure(own).conf.get("spark.sql.unionOutputPartitioning") == "true"
    session = configure(spark.newSession())
    # As partitions are that have reached the advisory size.
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    orders = session.range(2_000).select(F.col("id").alias("order"))
    lines = session.range(8_000).select((F.col("id") % 1_500).alias("line_order"))
    same = F.col("order") == F.col("line_order")
    inside = lines.join(orders.hint("merge"), same).select("order", F.lit("with").alias("case"))
    without = orders.join(lines.distinct().hint("merge"), same, "left_anti").select("order", F.lit("without").alias("case"))
    tasks = {}
    for row in inside.unionByName(without).withColumn("task", F.spark_partition_id()).collect():
        tasks.setdefault(row["task"], []).append(row["case"])
    assert sum(map(len, tasks.values())) == 8_500
    assert {len(set(cases)) for cases in tasks.values()} == {1}
