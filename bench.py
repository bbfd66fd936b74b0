"""Time the headline queries and print one JSON line.

Reads ``$BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) on ``local[$BENCH_CPUS]``.  Every query
runs to its last row into Spark's no-op sink: once cold, then ``$BENCH_RUNS`` times (default 3); the
reported time is the median of the warm runs.  Bronze inputs that the models read are derived and
stored beforehand; the entries named ``bronze_*`` time that step.  Scans, sinks and the job are timed once and left out of the sum.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cairnlake.functions import topics  # noqa: E402
from cairnlake.operators import quality  # noqa: E402
from cairnlake.operators.upsert import keyed_upsert  # noqa: E402
from cairnlake.plans import behaviour, customers, products, sales  # noqa: E402
from cairnlake.plans.batch import BatchJob, Bronze  # noqa: E402
from cairnlake.session import configure, scratch_path  # noqa: E402
from cairnlake.sinks.versioned import VersionedTable, with_date  # noqa: E402
from cairnlake.sources import tables  # noqa: E402
from cairnlake.streaming import landing, raw_ingest  # noqa: E402
from cairnlake.testbed import bronze  # noqa: E402
from cairnlake.testbed.queries import write_text_table  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("cairnlake-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def drain(table: DataFrame) -> None:
    table.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    timings: dict[str, float] = {}
    cold: dict[str, float] = {}

    def timed(step) -> float:
        start = time.perf_counter()
        step()
        return time.perf_counter() - start

    def store(name: str, table: DataFrame) -> DataFrame:
        path = scratch_path(spark, f"bench-{name}")
        # One file per core, as a stored table of any size has several.
        cold[f"bronze_{name}"] = timed(lambda: table.repartition(int(CPUS)).write.parquet(path))
        timings[f"bronze_{name}"] = cold[f"bronze_{name}"]
        return spark.read.parquet(path)

    transactions = store("sales_transactions", bronze.sales_transactions(spark, FOLDER))
    catalog = store("product_catalog", bronze.product_catalog(spark, FOLDER))
    clicks = store("clickstream_events", bronze.clickstream_events(spark, FOLDER))
    messages = store("messages", bronze.messages(bronze.load(spark, FOLDER, "events")))
    fact = store("f_sales", sales.f_sales(transactions, products.d_products(catalog)))
    snapshot = store("snapshot", customers.customer_snapshots(transactions))
    stored = store("stored_customers", bronze.stored_customers(snapshot))

    def stream() -> None:
        path = scratch_path(spark, "bench-raw")
        raw_ingest.start_raw_ingest(
            bronze.message_stream(spark, FOLDER),
            checkpoint=f"{path}/checkpoint",
            tables=topics.raw_table_map(bronze.PROJECT),
            path=f"{path}/tables",
        ).awaitTermination()

    def from_bronze() -> DataFrame:
        path = scratch_path(spark, "bench-dimension")
        customers.customer_snapshots(transactions).write.parquet(path)
        return behaviour.user_behavior_summary(
            sales.f_sales(transactions, products.d_products(catalog)),
            spark.read.parquet(path),
            clicks,
            money_scale=2,
        )

    steps = {
        "d_products": lambda: drain(products.d_products(catalog)),
        "flatten_items": lambda: drain(sales.flatten_items(transactions)),
        "f_sales": lambda: drain(sales.f_sales(transactions, products.d_products(catalog))),
        "customer_snapshots": lambda: drain(customers.customer_snapshots(transactions)),
        "scd2_delta": lambda: drain(customers.delta(snapshot, stored)),
        "scd2_merge": lambda: drain(customers.merge(snapshot, stored)),
        "user_purchase_patterns": lambda: drain(behaviour.user_purchase_patterns(fact, 2)),
        "browsed_categories": lambda: drain(behaviour.browsed_categories(clicks)),
        "user_behavior_summary": lambda: drain(
            behaviour.user_behavior_summary(fact, snapshot, clicks, money_scale=2)
        ),
        "summary_from_bronze": lambda: drain(from_bronze()),
        "parse_message": lambda: drain(raw_ingest.raw_rows(messages)),
        "assert_unique_customers": lambda: drain(
            quality.unique_key(customers.delta(snapshot, stored), customers.KEY, "unique")
        ),
        "stream_raw_ingest": stream,
    }
    # Sources and sinks: timed once warm, and not part of the sum.
    event_files, sales_files = scratch_path(spark, "bench-events"), scratch_path(spark, "bench-csv")
    write_text_table(bronze.clickstream_events(spark, FOLDER), event_files, "json")
    write_text_table(transactions, sales_files, "csv")
    routes = topics.landing_routes(bronze.PROJECT, bronze.OWNER)

    def land() -> None:
        path = scratch_path(spark, "bench-landing")
        landing.finish(landing.start_landing(bronze.message_stream(spark, FOLDER), f"{path}/f", f"{path}/c", routes))

    def partitioned() -> None:
        table = VersionedTable(spark, scratch_path(spark, "bench-table"))
        table.replace(with_date(customers.merge(snapshot, stored), "valid_from", "day"), "day", ("billing_country",))

    def job() -> None:
        BatchJob(spark, Bronze(transactions, catalog, clicks), scratch_path(spark, "bench-job"), 2).run({"silver", "gold"})

    others = {
        "scan_clickstream": lambda: drain(tables.scan_clickstream(spark, event_files)),
        "scan_sales_csv": lambda: drain(tables.scan_sales(spark, sales_files)),
        "keyed_upsert": lambda: drain(
            keyed_upsert(stored, customers.delta(snapshot, stored).distinct(), customers.KEY)
        ),
        "stream_landing": land,
        "scd2_partitioned_write": partitioned,
        "batch_job": job,
    }
    for name, step in {**steps, **others}.items():
        cold[name] = timed(step)
        timings[name] = statistics.median(timed(step) for _ in range(RUNS if name in steps else 1))

    print(
        json.dumps(
            {
                "metric": "headline queries, sum of warm medians",
                "value": round(sum(timings[name] for name in steps), 3),
                "unit": "sec",
                "queries": {name: round(seconds, 3) for name, seconds in timings.items()},
                "cold": {name: round(seconds, 3) for name, seconds in cold.items()},
                "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
