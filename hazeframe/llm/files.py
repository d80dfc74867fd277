"""Files that tasks write and read below the checkpoint folder, by its URI."""

from __future__ import annotations

import uuid
from typing import BinaryIO

from pyarrow import fs
from pyspark.sql import SparkSession


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


class NewFile:
    """A file with a name of its own, whatever attempt of a task writes it.

    Only files that a finished task reports are read later, so an attempt that is lost
    or repeated leaves at most an unused file.
    """

    def __init__(self, folder: str, name: str):
        self.uri = f"{folder}/{uuid.uuid4().hex}-{name}"
        store, path = _at(self.uri)
        store.create_dir(path.rpartition("/")[0], recursive=True)
        self._out: BinaryIO = store.open_output_stream(path, compression=None)
        self.size = 0

    def write(self, data: bytes) -> int:
        """Append; gives the position of the first byte."""
        at = self.size
        self._out.write(data)
        self.size += len(data)
        return at

    def close(self) -> None:
        self._out.close()


def open_input(uri: str) -> BinaryIO:
    store, path = _at(uri)
    return store.open_input_file(path)


def reading_tasks(spark: SparkSession) -> int:
    """Tasks that read files whose names come as a few small rows: adaptive execution would
    put such rows into one task."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
