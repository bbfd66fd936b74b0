"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Settings that change results.  Everything else is left to the cluster.
RESULT_SETTINGS = {
    # Timestamps are instants; every rendered date or time is UTC.
    "spark.sql.session.timeZone": "UTC",
    # A text that is not a number must fail a cast, not become NULL.
    "spark.sql.ansi.enabled": "true",
    # Of a repeated JSON key the last value counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

#: Settings the physical plans count on (all are defaults of Spark 4).
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

#: Settings that bound a task, unless the session has its own.
TASK_SETTINGS = {
    # A task sorts its whole partition.  Narrow columns take ten times their shuffled bytes in memory, so Spark's
    # 64 MB of them make tasks of 600 MB.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    # Before their shuffle, distinct keys and counts fill a table in memory with what one file split holds: nine
    # times its bytes for the two distinct counts of the summary.
    "spark.sql.files.maxPartitionBytes": "32MB",
    # A union of two joins by one key would be tasks that do a part of both, with the sorts of both in memory.
    "spark.sql.unionOutputPartitioning": "false",
}

#: Whether the shuffle files of a query go as it ends, or when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_scratch: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the library's runtime settings to a session and return it."""
    for name, value in {**RESULT_SETTINGS, **PLAN_SETTINGS}.items():
        spark.conf.set(name, value)
    for name, value in TASK_SETTINGS.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)
    return spark


@contextmanager
def without_shuffle_files(spark: SparkSession) -> Iterator[None]:
    """Writes started in this block leave no shuffle files behind.

    Each write is a query of its own, so nothing reads its shuffles again; a table that is computed twice shuffles twice, as ever.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the folder that all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``.  Only a local session without the
    setting gets a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        app = spark.sparkContext.applicationId
        if app not in _local_scratch:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            _local_scratch[app] = tempfile.mkdtemp(prefix="cairnlake-")
        root = _local_scratch[app]
    return f"{root.rstrip('/')}/cairnlake/{label}-{uuid.uuid4().hex}"
