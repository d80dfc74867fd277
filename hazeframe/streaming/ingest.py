"""Structured Streaming jobs over a folder of landed readings.

Every job drains what has landed (``availableNow``) and can be restarted: each
micro-batch writes its own folder, so a repeated batch replaces what it wrote before.
Keyed results are kept as a log of per-batch changes and read back latest-wins.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hazeframe.operators.filters import keep_last
from hazeframe.scale import ranking
from hazeframe.session import scratch_path
from hazeframe.sources.live import upsert_live

BATCH = "_batch_id"


def landed(spark: SparkSession, path: str, schema: StructType, ts: str = "ts",
           files_per_trigger: int = 1000, nested: bool = False) -> DataFrame:
    """Stream of the files in ``path`` (``nested``: and below it) in the order they landed;
    times become zoned, as watermarks require."""
    rows = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .option("recursiveFileLookup", nested).parquet(path))
    return rows.withColumn(ts, F.col(ts).cast("timestamp"))


def append_rows(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Drain a stream into Parquet files (append mode)."""
    query = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()


def change_log(stream: DataFrame, out: str, checkpoint: str, mode: str = "update",
               each: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Drain a stream, writing every micro-batch to its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = each(batch) if each else batch
        rows.write.mode("overwrite").parquet(f"{out}/{BATCH}={batch_id}")

    query = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .outputMode(mode).trigger(availableNow=True).start())
    query.awaitTermination()


def read_log(spark: SparkSession, out: str, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Newest state of each key in a change log."""
    return fold_latest(spark.read.parquet(out), keys, order)


def hourly_mean_stream(rows: DataFrame, by: Sequence[str], cols: Sequence[str], delay: str = "2 hours") -> DataFrame:
    """Tumbling hourly means; rows later than ``delay`` are cut off."""
    hours = rows.withWatermark("ts", delay).groupBy(F.window("ts", "1 hour").alias("w"), *by)
    return hours.agg(*[F.avg(c).alias(c) for c in cols]).select(
        *by, F.col("w.start").cast("timestamp_ntz").alias("hour"), *cols)


def sliding_mean_stream(rows: DataFrame, by: Sequence[str], col: str, size: str = "8 hours",
                        slide: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Clock-hour sliding mean (unlike the batch value, which takes the last hours with data)."""
    spans = rows.withWatermark("ts", delay).groupBy(F.window("ts", size, slide).alias("w"), *by)
    return spans.agg(F.avg(col).alias("mean"), F.count(col).alias("readings")).select(
        *by, F.col("w.end").cast("timestamp_ntz").alias("window_end"), "mean", "readings")


def dedup_stream(rows: DataFrame, keys: Sequence[str], delay: str = "2 hours") -> DataFrame:
    """One row per key within the lateness bound; copies must agree."""
    return rows.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(keys))


def last_valid_stream(rows: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Running last non-null value per key and column (update mode)."""
    rank = ranking(order)
    return rows.groupBy(*by).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c) for c in cols])


def late_rows(rows: DataFrame, ts: str, newest_seen, delay_hours: int) -> DataFrame:
    """Count rows behind the watermark, which stateful operators drop without a word."""
    behind = F.col(ts) < F.lit(newest_seen) - F.expr(f"interval {int(delay_hours)} hours")
    return rows.agg(F.count_if(behind).alias("late"))


def upsert_stream(rows: DataFrame, out: str, checkpoint: str, keys: Sequence[str], identity: Sequence[str],
                  measures: Sequence[str], order: Sequence[str]) -> None:
    """Upsert by event order: a key keeps the identity columns of its earliest row and takes
    the measures of its latest one, whatever batch they land in. Each micro-batch is
    reduced to one row per key; ``read_upserts`` folds the batches."""
    rank = F.struct(*order)

    def reduce(batch: DataFrame) -> DataFrame:
        return batch.groupBy(*keys).agg(
            F.min(rank).alias("_first"), F.min_by(F.struct(*identity), rank).alias("_id"),
            F.max(rank).alias("_last"), F.max_by(F.struct(*measures), rank).alias("_m"))

    change_log(rows, out, checkpoint, "append", reduce)


def read_upserts(spark: SparkSession, out: str, keys: Sequence[str]) -> DataFrame:
    """Current state of every key of an upsert log; a repeated event order goes to the later batch."""
    return fold_upserts(spark.read.parquet(out), keys).select(*keys, "_id.*", "_m.*")


def live_upserts(rows: DataFrame, root: str, checkpoint: str, keys: Sequence[str], identity: Sequence[str],
                 measures: Sequence[str], order: Sequence[str]) -> None:
    """Upsert a stream into the live table at ``root``. A micro-batch is one swap; repeated
    after a restart, it is known by its number and left out."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_live(batch, root, keys, identity, measures, order, token=batch_id)

    query = (rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()


def fold_latest(log: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Fold of a ``read_log`` log: the newest row of each key."""
    return keep_last(log, keys, [BATCH, *order]).drop(BATCH)


def fold_upserts(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fold of an ``upsert_stream`` log: the earliest identity and the latest measures of
    each key, with the event orders they rank by."""
    first, last = F.struct("_first", BATCH), F.struct("_last", BATCH)
    return log.groupBy(*keys).agg(F.min("_first").alias("_first"), F.min_by("_id", first).alias("_id"),
                                  F.max("_last").alias("_last"), F.max_by("_m", last).alias("_m"))


def fold_nearest(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fold of a ``nearest_weather_stream`` log: the nearest hit of each key and its rank."""
    return log.groupBy(*keys).agg(F.max("_rank").alias("_rank"), F.max_by("_hit", "_rank").alias("_hit"))


def compact_log(spark: SparkSession, out: str, new_out: str, fold: Callable[[DataFrame], DataFrame]) -> None:
    """Fold a change log into one folder of a new log, between two drains, by the fold of
    its kind. Folds give rows of the log's own form and can be repeated.

    Later drains go on into ``new_out``; the old folder may be removed then. The folded
    state ranks below every later batch.
    """
    fold(spark.read.parquet(out)).write.mode("overwrite").parquet(f"{new_out}/{BATCH}=-1")


def nearest_weather_stream(readings: DataFrame, weather: DataFrame, by: Sequence[str], ts: str, key: Sequence[str],
                           out: str, checkpoint: str, tolerance: str = "1 hour", delay: str = "2 hours") -> None:
    """Join two streams on ``by`` within ``tolerance`` and log the nearest row per reading.

    Both sides are held in state until the watermark has passed, so weather may land
    before or after the reading. A micro-batch writes one row per reading it matched.
    """
    right = weather.withColumnsRenamed({c: f"_r_{c}" if c in by else f"wx_{c}" for c in weather.columns})
    left, right = readings.withWatermark(ts, delay), right.withWatermark(f"wx_{ts}", delay)
    near = F.lit(True)
    for c in by:
        near = near & (F.col(c) == F.col(f"_r_{c}"))
    width = F.expr(f"interval {tolerance}")
    near = near & (F.col(f"wx_{ts}") >= F.col(ts) - width) & (F.col(f"wx_{ts}") <= F.col(ts) + width)
    pairs = left.join(right, near).drop(*[f"_r_{c}" for c in by])
    found = [f"wx_{c}" for c in weather.columns if c not in by]

    def nearest(batch: DataFrame) -> DataFrame:
        at, wx = F.unix_micros(F.col(ts)), F.unix_micros(F.col(f"wx_{ts}"))
        rank = F.struct((-F.abs(at - wx)).alias("d"), wx.alias("t"))
        return batch.groupBy(*key).agg(F.max(rank).alias("_rank"), F.max_by(F.struct(*found), rank).alias("_hit"))

    change_log(pairs, out, checkpoint, "append", nearest)


def read_nearest(readings: DataFrame, out: str, key: Sequence[str]) -> DataFrame:
    """Landed readings with the nearest weather found so far; nulls where there is none."""
    best = fold_nearest(readings.sparkSession.read.parquet(out), key).drop("_rank")
    return readings.join(best, list(key), "left").select(*readings.columns, "_hit.*")


def folders(spark: SparkSession, name: str) -> tuple[str, str]:
    """New output and checkpoint folders below the shared scratch folder."""
    root = scratch_path(spark, f"stream-{name}")
    return f"{root}/out", f"{root}/checkpoint"
