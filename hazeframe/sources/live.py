"""A table that is replaced in a single step: versioned folders and one pointer file.

A version is written to a folder of its own; then a pointer file that names it takes the
place of the old one by a rename, which file systems do in one step (on object stores, as
far as their connector does). Readers read the pointer once and stay on their version. A
write that fails leaves the pointer, and so the old table, as it was. One writer at a time.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hazeframe.operators.upsert import tagged

POINTER = "_current"


class _Files:
    """The file system calls that a pointer needs."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.root = self.jvm.org.apache.hadoop.fs.Path(root)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self.root.toUri() if self.root.toUri().getScheme() else self.jvm.java.net.URI("file:///"),
            spark._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.root, name)

    def exists(self, name: str) -> bool:
        return self.context.util().exists(self.at(name))

    def read(self, name: str) -> str:
        stream = self.context.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Write a file beside ``name``, then rename it over it."""
        Create = self.jvm.org.apache.hadoop.fs.CreateFlag
        Rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.jvm.org.apache.hadoop.fs.Options.CreateOpts
        gateway = self.jvm.java.util.EnumSet.of(Create.CREATE, Create.OVERWRITE)
        fresh = self.at(f"_pointer-{uuid.uuid4().hex}")
        make = _array(self.jvm, options, [options.createParent()])
        stream = self.context.create(fresh, gateway, make)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.context.rename(fresh, self.at(name), _array(self.jvm, Rename, [Rename.OVERWRITE]))


def _array(jvm, kind, items):
    from pyspark import SparkContext

    out = SparkContext._gateway.new_array(kind, len(items))
    for i, item in enumerate(items):
        out[i] = item
    return out


def pointer(spark: SparkSession, root: str) -> dict | None:
    """{"version", "token"} of the current table, or None where none was published."""
    files = _Files(spark, root)
    return json.loads(files.read(POINTER)) if files.exists(POINTER) else None


def read_live(spark: SparkSession, root: str) -> DataFrame | None:
    """The current version, whatever is published later; None before the first one."""
    now = pointer(spark, root)
    return None if now is None else spark.read.parquet(f"{root}/{now['version']}")


def publish(df: DataFrame, root: str, token: int | None = None) -> str:
    """Write ``df`` as the next version and make it the current one; gives its folder name.

    ``token`` numbers the writes of a stream: one that the current version already has, or
    a smaller one, was committed before and is not written again.
    """
    spark = df.sparkSession
    now = pointer(spark, root)
    if token is not None and now is not None and now["token"] is not None and token <= now["token"]:
        return now["version"]
    version = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(f"{root}/{version}")
    if token is None and now is not None:
        token = now["token"]
    _Files(spark, root).replace(POINTER, json.dumps({"version": version, "token": token}))
    return version


def upsert_live(updates: DataFrame, root: str, keys: Sequence[str], identity: Sequence[str], measures: Sequence[str],
                order: Sequence[str], token: int | None = None) -> dict[str, int]:
    """Merge ``updates`` into the live table as ``upsert.merge_measures`` does, and publish.

    Gives the keys inserted and updated, observed in the write itself: no second pass over
    either table. A repeated ``token`` changes nothing and gives zeros.
    """
    spark = updates.sparkSession
    old = read_live(spark, root)
    if old is None:
        old = updates.select(*keys, *identity, *measures).limit(0)
    merged = tagged(old, updates, keys, identity, measures, order)
    seen = Observation()
    counted = merged.observe(seen, F.count_if("_new").alias("inserted"), F.count_if(~F.col("_new") & F.col("_met")).alias("updated"))
    before = pointer(spark, root)
    version = publish(counted.drop("_new", "_met"), root, token)
    if before is not None and version == before["version"]:
        return {"inserted": 0, "updated": 0}
    return {k: int(v or 0) for k, v in seen.get.items()}
