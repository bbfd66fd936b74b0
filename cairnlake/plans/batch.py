"""The batch job: bronze -> silver -> gold, every model once and in dependency order."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession, functions as F

from cairnlake import schemas
from cairnlake.operators import quality
from cairnlake.plans import behaviour, customers, products, sales
from cairnlake.session import scratch_path
from cairnlake.sinks.versioned import VersionedTable, with_date
from cairnlake.sources import tables
from cairnlake.storage import Storage

#: The models in the order they are built.
MODELS = ("d_products", "f_sales", "d_customers", "user_behavior_summary")
#: The assertions on a model, given its staged version.
Assertions = Callable[[DataFrame], list[DataFrame]]


@dataclass(frozen=True)
class Bronze:
    """The bronze inputs of the job."""

    sales_transactions: DataFrame
    product_catalog: DataFrame
    clickstream_events: DataFrame

    @classmethod
    def named(cls, spark: SparkSession) -> Bronze:
        """The inputs by their table or view names."""
        return cls(*(spark.table(field.name) for field in fields(cls)))

    @classmethod
    def files(cls, spark: SparkSession, sales: str, catalog: str, clickstream: str) -> Bronze:
        """The inputs as text files; of the catalog only its newest day is listed and read."""
        return cls(
            tables.scan_sales(spark, sales),
            tables.scan_newest_catalog(spark, catalog),
            tables.scan_clickstream(spark, clickstream),
        )


class BatchJob:
    """Materialises the models as versioned tables below ``root``.

    A model reads the stored result of the models before it, so nothing is computed twice.  Its result is checked
    before it is published: a violated assertion leaves the version before it in place and stops the job, and its
    violations are appended to ``root/violations`` under the id of the run.  ``keep`` versions of each table stay.

    The customer history grows by what changed: a run rewrites the dates on which it adds, drops or ends a version and takes
    the folders of all others over, until there are so many that it is written as one again.
    """

    def __init__(
        self,
        spark: SparkSession,
        bronze: Bronze,
        root: str,
        money_scale: int | None = None,
        keep: int = 2,
    ):
        self.keep = keep
        self.spark = spark
        self.bronze = bronze
        self.root = root.rstrip("/")
        self.money_scale = money_scale
        self.run_id = uuid.uuid4().hex

    @property
    def violations_path(self) -> str:
        return f"{self.root}/violations"

    def table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/{name}")

    def _check(self, name: str, assertions: Assertions) -> Callable[[DataFrame], None]:
        def check(staged: DataFrame) -> None:
            kept = quality.keep_violations(assertions(staged), self.violations_path, self.run_id, name)
            if kept is not None:
                quality.enforce(kept)

        return check

    def _publish(self, name: str, table: DataFrame, assertions: Assertions = lambda staged: []) -> None:
        target = self.table(name)
        target.replace(table, check=self._check(name, assertions))
        target.drop_older(self.keep)

    def build_products(self) -> None:
        self._publish(
            "d_products",
            products.d_products(self.bronze.product_catalog),
            lambda staged: [
                quality.unique_key(staged, ["product_id"], "d_products_unique"),
                quality.non_null(staged, ["product_id"], "d_products_non_null"),
            ],
        )

    def build_sales(self) -> None:
        fact = sales.f_sales(self.bronze.sales_transactions, self.table("d_products").read())
        self._publish(
            "f_sales", fact, lambda staged: [quality.non_null(staged, sales.REQUIRED, "f_sales_non_null")]
        )

    def build_customers(self) -> None:
        target, date = self.table("d_customers"), "valid_from_date"
        path = scratch_path(self.spark, "customer-snapshot")
        customers.customer_snapshots(self.bronze.sales_transactions).write.parquet(path)
        snapshot = self.spark.read.schema(schemas.CUSTOMERS).parquet(path)
        layout = {"sort_by": ("billing_country",)}
        check = self._check(
            "d_customers", lambda staged: [quality.unique_key(staged, customers.KEY, "d_customers_unique")]
        )
        number = max(target.versions(), default=0)
        if target.can_take_over(date, number or None):
            current = target.read(version=number)
            touched = [row["date"] for row in customers.touched_dates(snapshot, current).collect()]
            inside = F.col(date).isin([day for day in touched if day is not None])
            if None in touched:
                inside = inside | F.col(date).isNull()
            before = current.where(inside).select(*schemas.CUSTOMERS.fieldNames())
            merged = with_date(customers.merge(snapshot, before), "valid_from", date).where(inside)
            target.replace_partitions(merged, touched, check=check, after=number, **layout)
        else:
            merged = customers.merge(snapshot, target.read(schemas.CUSTOMERS, number or None))
            target.replace(with_date(merged, "valid_from", date), date, check=check, after=number, **layout)
        target.drop_older(self.keep)
        Storage(self.spark, path).delete(path)

    def build_behaviour(self) -> None:
        summary = behaviour.user_behavior_summary(
            self.table("f_sales").read(),
            self.table("d_customers").read(schemas.CUSTOMERS),
            self.bronze.clickstream_events,
            self.money_scale,
        )
        self._publish("user_behavior_summary", summary)

    def register_models(self) -> list[str]:
        """Give the newest published versions of the models their names, so that SQL can refer to them; returns the names."""
        names = [name for name in MODELS if self.table(name).versions()]
        for name in names:
            self.table(name).read().createOrReplaceTempView(name)
        return names

    def run(self, tags: set[str] | frozenset[str] = frozenset({"silver", "gold"})) -> list[str]:
        """Run the models that carry one of the tags and return their names."""
        self.run_id = uuid.uuid4().hex
        steps = [
            (products.TAGS, self.build_products),
            (sales.TAGS, self.build_sales),
            (customers.TAGS, self.build_customers),
            (behaviour.TAGS, self.build_behaviour),
        ]
        chosen = [(name, build) for name, (model_tags, build) in zip(MODELS, steps) if model_tags & set(tags)]
        for _, build in chosen:
            build()
        return [name for name, _ in chosen]
