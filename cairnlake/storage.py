"""Listing and small files on whatever storage a path names; the one place that reaches for Hadoop's file systems."""

from __future__ import annotations

import errno
import os

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _move_here(source: str, target: str) -> bool:
    """A move on a disk of this machine: Hadoop's would start a process for each, and could overwrite a file."""
    os.makedirs(os.path.dirname(target), exist_ok=True)
    try:
        if os.path.isdir(source):
            os.rename(source, target)  # refuses a folder that has something in it
        else:
            os.link(source, target)
            os.unlink(source)
    except OSError as error:
        if error.errno in (errno.EEXIST, errno.ENOTEMPTY):
            return False
        raise
    return True


class Storage:
    """The file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self._hadoop, self._gateway = context._jvm.org.apache.hadoop.fs, context._gateway
        self._configuration = context._jsc.hadoopConfiguration()
        self._files = self._hadoop.Path(path).getFileSystem(self._configuration)
        self._local = self._files.getScheme() == "file"
        self._context = None

    def names(self, folder: str, folders: bool, empty: bool = False) -> list[str]:
        """Names of the folders, or of the files, directly below a folder; none if it is not there.

        Files without content count only if ``empty``.
        """
        path = self._hadoop.Path(folder)
        if not self._files.exists(path):
            return []
        return [
            entry.getPath().getName()
            for entry in self._files.listStatus(path)
            if entry.isDirectory() == folders and (folders or empty or entry.getLen() > 0)
        ]

    def is_folder(self, path: str) -> bool:
        return self._files.getFileStatus(self._hadoop.Path(path)).isDirectory()

    def size(self, path: str) -> int | None:
        """Bytes of a file; None if it is not there."""
        place = self._hadoop.Path(path)
        return self._files.getFileStatus(place).getLen() if self._files.exists(place) else None

    def create(self, path: str) -> bool:
        """Create an empty file unless it is there already.  Of several that try at once, one succeeds.

        That holds on local disks, on HDFS, and on object stores with conditional writes.
        """
        place = self._hadoop.Path(path)
        if self._local:
            name = place.toUri().getPath()
            os.makedirs(os.path.dirname(name), exist_ok=True)
            try:
                os.close(os.open(name, os.O_CREAT | os.O_EXCL | os.O_WRONLY, 0o644))
            except FileExistsError:
                return False
            return True
        try:
            self._files.create(place, False).close()
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def write(self, path: str, text: str) -> None:
        """Write a small file of its own name."""
        stream = self._files.create(self._hadoop.Path(path), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def move(self, source: str, target: str) -> bool:
        """Give a file or folder another name unless that is taken; nobody sees a part of it."""
        start, end = self._hadoop.Path(source), self._hadoop.Path(target)
        if self._local:
            return _move_here(start.toUri().getPath(), end.toUri().getPath())
        self._files.mkdirs(end.getParent())
        if self._context is None:
            self._context = self._hadoop.FileContext.getFileContext(self._files.getUri(), self._configuration)
        no_options = self._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        try:
            self._context.rename(self._files.makeQualified(start), self._files.makeQualified(end), no_options)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def text(self, path: str) -> str:
        """The content of a small file."""
        place = self._hadoop.Path(path)
        length = self._files.getFileStatus(place).getLen()
        stream = self._files.open(place)
        try:
            return bytes(stream.readNBytes(int(length))).decode()
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        self._files.delete(self._hadoop.Path(path), True)
