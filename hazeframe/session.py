"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None
_shipped: set[str] = set()


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench. On a cluster use the cluster's own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hazeframe")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``.

    A temporary folder is made only where the setting is missing and Spark runs in
    local mode; on a cluster a missing setting is an error.
    """
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="hazeframe-")
    return _local_folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the scratch folder."""
    return f"{scratch_root(spark)}/hazeframe/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    The written table fixes values that a recomputation could change (range
    boundaries, partition ids) and survives the loss of executors. Readers prune
    columns, which a row checkpoint could not.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver was started.

    The package is added to the session once; Spark hands it to every executor.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(SparkFiles.getRootDirectory(), f"package-{uuid.uuid4().hex}"), "zip",
        root_dir=os.path.dirname(package), base_dir=os.path.basename(package))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
