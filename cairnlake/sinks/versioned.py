"""Tables that are replaced version by version, as a whole or by partitions."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cairnlake.storage import Storage

#: Seconds that a writer has for publishing, which takes a few small files.  After that another may take its claim over.
LEASE = 10.0
#: Folders that a version's data may be spread over before a write by partitions should become one of everything.
MOST_FOLDERS = 32
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class ConflictingWrite(RuntimeError):
    """Another writer published a version while this one was being written."""


@dataclass(frozen=True)
class Version:
    """What a pointer file says: the columns, and the data folders with their partition folders ("" if there are none).

    Of a data folder's partitions the live ones belong to the version; the dead ones were replaced since.
    """

    schema: T.StructType
    partition_by: str | None
    folders: dict[str, dict[str, list[str]]]

    def text(self) -> str:
        return json.dumps({"schema": json.loads(self.schema.json()), "partition_by": self.partition_by, "folders": self.folders})

    @classmethod
    def parse(cls, text: str) -> Version:
        found = json.loads(text)
        return cls(T.StructType.fromJson(found["schema"]), found["partition_by"], found["folders"])

    def parts(self) -> set[tuple[str, str]]:
        return {(folder, part) for folder, parts in self.folders.items() for part in parts["live"]}

    def without(self, gone: set[str]) -> dict[str, dict[str, list[str]]]:
        """The data folders that are left if some partitions are replaced."""
        left = {
            folder: {
                "live": [part for part in parts["live"] if part not in gone],
                "dead": parts["dead"] + [part for part in parts["live"] if part in gone],
            }
            for folder, parts in self.folders.items()
        }
        return {folder: parts for folder, parts in left.items() if parts["live"]}


class VersionedTable:
    """A parquet table of versions.  A version is a small pointer file that lists folders of data.

    A write goes to a new folder first, is checked there, and becomes a version by its pointer ``versions/<number>``.  A
    version can take over partition folders of the one before by naming them, so that only what changed is written.
    Readers follow pointers: a run that breaks off or fails its check leaves a folder that nobody sees, and
    readers of older versions are never disturbed.

    The number follows the newest version at the start of the write, so a writer that did not see another's version cannot
    publish over it.  To publish, a writer claims the number by creating an empty file, writes the pointer under another name
    and gives it its own, which fails if that is taken: a pointer is there as a whole or not at all.  A writer that
    dies in between leaves a claim; others wait for its lease to pass, watching for the pointer, and claim
    the number anew.  A writer that took longer than its lease gives up.
    """

    def __init__(self, spark: SparkSession, path: str, lease: float = LEASE):
        self.spark = spark
        self.path = path.rstrip("/")
        self.lease = lease

    def _storage(self) -> Storage:
        return Storage(self.spark, self.path)

    def _pointer(self, number: int) -> str:
        return f"{self.path}/versions/{number:06d}"

    def versions(self) -> list[int]:
        """Numbers of the published versions, oldest first."""
        return sorted(int(n) for n in self._storage().names(f"{self.path}/versions", False) if n.isdigit())

    def version(self, number: int | None = None) -> Version | None:
        """What the newest (or a given) version consists of; None before the first one."""
        versions = self.versions()
        if number is None and not versions:
            return None
        return Version.parse(self._storage().text(self._pointer(number or versions[-1])))

    def folders(self, number: int | None = None) -> list[str]:
        """Where the data of the newest (or a given) version is."""
        version = self.version(number)
        return [f"{self.path}/{folder}/{part}".rstrip("/") for folder, part in sorted(version.parts())] if version else []

    def folder(self, number: int | None = None) -> str:
        """The one data folder of a version that took nothing over."""
        (name,) = self.version(number).folders
        return f"{self.path}/{name}"

    def read(self, schema: T.StructType | None = None, version: int | None = None) -> DataFrame:
        """The newest (or a given) version; an empty table of ``schema`` before the first one."""
        found = self.version(version)
        if found is None:
            if schema is None:
                raise FileNotFoundError(f"no published version in {self.path}")
            return self.spark.createDataFrame([], schema)
        table = self._frame(found)
        return table.select(*schema.fieldNames()) if schema is not None else table

    def _frame(self, version: Version) -> DataFrame:
        def scan(folder: str, dead: list[str]) -> DataFrame:
            table = self.spark.read.schema(version.schema).parquet(f"{self.path}/{folder}")
            if not dead:
                return table
            # A filter of partitions: Spark opens no file of the dead ones.
            value = F.coalesce(F.col(version.partition_by).cast("string"), F.lit(_NO_VALUE))
            return table.where(~value.isin([part.partition("=")[2] for part in dead]))

        scans = [scan(folder, parts["dead"]) for folder, parts in sorted(version.folders.items())]
        return reduce(DataFrame.unionByName, scans) if scans else self.spark.createDataFrame([], version.schema)

    def replace(
        self,
        table: DataFrame,
        partition_by: str | None = None,
        sort_by: tuple[str, ...] = (),
        check: Callable[[DataFrame], None] | None = None,
        after: int | None = None,
    ) -> DataFrame:
        """Write the next version, let ``check`` look at it (it raises to refuse), publish and return it.

        What was computed from a version names it in ``after`` (0: from none) and is refused if there is a newer one.
        """
        return self._write(table, partition_by, sort_by, check, self._newest(after), lambda folder, parts: {folder: parts})

    def _newest(self, after: int | None) -> int:
        newest = max(self.versions(), default=0)
        if after not in (None, newest):
            raise ConflictingWrite(f"version {newest} of {self.path} was published by another writer")
        return newest

    def can_take_over(self, partition_by: str, number: int | None = None) -> bool:
        """Whether the newest (or a given) version is partitioned so, and its data not spread over too many folders."""
        newest = self.version(number)
        return newest is not None and newest.partition_by == partition_by and len(newest.folders) < MOST_FOLDERS

    def replace_partitions(
        self,
        table: DataFrame,
        touched: Iterable[object],
        sort_by: tuple[str, ...] = (),
        check: Callable[[DataFrame], None] | None = None,
        after: int | None = None,
    ) -> DataFrame:
        """Write a version in which ``table`` takes the place of the ``touched`` partitions; all others are taken over.

        ``touched`` are values of the partition column (dates, whole numbers or None), ``table`` has rows of these only.
        A touched partition without rows is gone.  ``check`` sees the whole version; ``after`` is as in :meth:`replace`.
        """
        newest = self._newest(after)
        before = self.version(newest) if newest else None
        if before is None or before.partition_by is None:
            raise ValueError(f"{self.path} has no partitioned version")
        gone = {f"{before.partition_by}={_NO_VALUE if value is None else value}" for value in touched}

        def combined(folder: str, parts: dict[str, list[str]]) -> dict[str, dict[str, list[str]]]:
            if not set(parts["live"]) <= gone:
                raise ValueError(f"rows outside the touched partitions: {sorted(set(parts['live']) - gone)}")
            return before.without(gone) | ({folder: parts} if parts["live"] else {})

        return self._write(table.select(*before.schema.fieldNames()), before.partition_by, sort_by, check, newest, combined)

    def _write(
        self,
        table: DataFrame,
        partition_by: str | None,
        sort_by: tuple[str, ...],
        check: Callable[[DataFrame], None] | None,
        newest: int,
        content: Callable[[str, dict[str, list[str]]], dict[str, dict[str, list[str]]]],
    ) -> DataFrame:
        number = newest + 1
        name = f"data-{number:06d}-{uuid.uuid4().hex}"
        staged = f"{self.path}/{name}"
        try:
            write_table(table, staged, partition_by, sort_by)
            parts = [""] if partition_by is None else sorted(self._storage().names(staged, True))
            fields = [f for f in table.schema.fields if f.name != partition_by]
            if partition_by is not None:
                fields.append(table.schema[partition_by])
            # Stored columns can always be NULL.
            schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
            version = Version(schema, partition_by, content(name, {"live": parts, "dead": []}))
            written = self._frame(version)
            if check is not None:
                check(written)
            self._publish(number, version.text())
        except BaseException:
            self._storage().delete(staged)
            raise
        return written

    def _claim(self, storage: Storage, number: int) -> None:
        """Have the number to oneself, after the lease of whoever claimed it before and did not publish."""
        folder, prefix = f"{self.path}/claims", f"{number:06d}-"
        while not storage.size(self._pointer(number)):
            attempts = [int(n.removeprefix(prefix)) for n in storage.names(folder, False, empty=True) if n.startswith(prefix)]
            end = time.monotonic() + self.lease if attempts else 0.0
            while time.monotonic() < end and not storage.size(self._pointer(number)):
                time.sleep(min(0.2, self.lease))
            if not storage.size(self._pointer(number)) and storage.create(f"{folder}/{prefix}{max(attempts, default=0) + 1}"):
                return
        raise ConflictingWrite(f"version {number} of {self.path} was published by another writer")

    def _publish(self, number: int, text: str) -> None:
        storage, pointer = self._storage(), self._pointer(number)
        self._claim(storage, number)
        began = time.monotonic()
        if storage.size(pointer) == 0:
            storage.delete(pointer)  # no pointer of this protocol is ever empty
        draft = f"{self.path}/drafts/{number:06d}-{uuid.uuid4().hex}"
        storage.write(draft, text)
        if time.monotonic() - began > self.lease / 2 or not storage.move(draft, pointer):
            storage.delete(draft)
            raise ConflictingWrite(f"version {number} of {self.path} was published by another writer, or too late")

    def drop_older(self, keep: int = 2) -> None:
        """Delete all but the newest ``keep`` versions, and the data that none of these has."""
        storage, numbers = self._storage(), self.versions()
        old, new = numbers[:-keep], numbers[-keep:]
        needed = set().union(*(self.version(number).parts() for number in new))
        folders = {folder for folder, _ in needed}
        for number in old:
            own = self.version(number).parts()
            storage.delete(self._pointer(number))
            for claim in storage.names(f"{self.path}/claims", False, empty=True):
                if claim.startswith(f"{number:06d}-"):
                    storage.delete(f"{self.path}/claims/{claim}")
            for folder in {folder for folder, _ in own} - folders:
                storage.delete(f"{self.path}/{folder}")
            for folder, part in own - needed:
                if folder in folders:
                    storage.delete(f"{self.path}/{folder}/{part}")


def write_table(
    table: DataFrame, path: str, partition_by: str | None = None, sort_by: tuple[str, ...] = ()
) -> None:
    """Write parquet files, optionally split by a column and sorted inside each file.

    Rows are dealt to ranges of the partition column, the sort columns and a hash of the row: few files per partition, and
    each file has its own range of the sort columns, narrow minimum and maximum values to skip by.  The bounds
    come from a sample of the rows, so values that very many rows share take up several ranges, told apart by the hash.
    """
    if partition_by:
        hashed = [f.name for f in table.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        table = table.repartitionByRange(*(F.col(name) for name in (partition_by, *sort_by)), F.xxhash64(*hashed))
    if partition_by or sort_by:
        order = ([partition_by] if partition_by else []) + list(sort_by)
        table = table.sortWithinPartitions(*order)
    writer = table.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def with_date(table: DataFrame, timestamp: str, name: str) -> DataFrame:
    """Add the date of a timestamp, to partition by."""
    return table.withColumn(name, F.to_date(timestamp))
