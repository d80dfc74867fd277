"""Helpers shared by the corpus operators."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeframe.session import ship, stored

__all__ = ["add_columns", "bounded_rows", "fresh", "in_tasks", "number_slots", "remainder", "running_total", "stored", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    while name in df.columns:
        name += "_"
    return name


def remainder(col: str, by: int) -> Column:
    """crc32 of the value as text, modulo ``by``; null for a null value."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % by


def in_tasks(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
             schema: T.StructType | str) -> DataFrame:
    """mapInArrow with this package shipped to the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def add_columns(df: DataFrame, read: Sequence[str], fields: Sequence[T.StructField],
                fn: Callable[..., Sequence[pa.Array]], keep: Sequence[str] | None = None) -> DataFrame:
    """Append columns that ``fn`` computes from the Arrow arrays of ``read``, batch by batch.

    ``keep`` names the columns that are passed on (all, if not given). A kept column
    whose name clashes with a new one is replaced by it.
    """
    new = [f.name for f in fields]
    keep = [c for c in (df.columns if keep is None else keep) if c not in new]
    schema = T.StructType([df.schema[c] for c in keep] + list(fields))
    cols = list(dict.fromkeys([*keep, *read]))
    kept, reads = [cols.index(c) for c in keep], [cols.index(c) for c in read]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = fn(*[batch.column(i) for i in reads])
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], *made], names=[*keep, *new])

    return in_tasks(df.select(*[F.col(f"`{c}`") for c in cols]), run, schema)


def bounded_rows(df: DataFrame, key: Column, limit: int) -> DataFrame:
    """At most ``limit`` rows, those with the smallest hash of ``key``: the documented
    sample a model is fitted on. Rows are counted and cut by their hash where they are, so
    that little more than ``limit`` rows leave the tasks, however many tasks there are.
    ``df`` is read twice; null keys count as one value."""
    n = df.count()
    place = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30))
    if n > 2 * limit:
        df = df.where(place < math.ceil((1.2 * limit + 100) / n * (1 << 30)))
    return df.orderBy(place, key).limit(limit)


def running_total(df: DataFrame, by: Sequence[str], order: Sequence[str], weight: str, out: str,
                  rows: int, per_bucket: int = 50_000) -> DataFrame:
    """Add ``out``: the sum of ``weight`` over the earlier rows of the same ``by`` group.

    Rows are dealt into buckets by a hash of ``order``; a group runs through its buckets
    one after another, so no task ever holds a whole group. Only the bucket sums, one row
    per group and bucket, are summed in order. Columns in ``order`` must tell rows apart;
    rows that agree in all of them may swap places.
    """
    buckets = max(1, math.ceil(rows / per_bucket))
    dealt = df.withColumn("_b", F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(buckets)))
    keys = [*by, "_b"]
    sums = dealt.groupBy(*keys).agg(F.sum(weight).alias("_w"))
    before = F.sum("_w").over(_before(by, "_b"))
    starts = sums.select(*[F.col(k).alias(f"_k{k}") for k in keys], F.coalesce(before, F.lit(0)).alias("_s"))
    inside = F.coalesce(F.sum(weight).over(_before(keys, *order)), F.lit(0))
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_k{k}"))
    joined = dealt.withColumn("_i", inside).join(starts, match)
    return joined.select(*df.columns, (F.col("_s") + F.col("_i")).cast("long").alias(out))


def _before(by, *order):
    from pyspark.sql import Window

    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def number_slots(df: DataFrame, by: str, order: Sequence[str], out: str, rows: int) -> DataFrame:
    """Gapless numbers from 0 within ``by``, without a task per group."""
    return running_total(df.withColumn("_one", F.lit(1).cast("long")), [by], order, "_one", out, rows).drop("_one")
