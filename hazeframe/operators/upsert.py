"""Keyed merges of new rows into a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from hazeframe.operators.filters import keep_last


def append_unique(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Old and new rows, one per key, the newest batch and then ``order`` deciding."""
    both = old.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)))
    return keep_last(both, keys, ["_batch", *order]).drop("_batch")


def inserted_count(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows the merge adds: distinct keys of both minus the old rows, never negative."""
    both = old.select(*keys, F.lit(1).alias("_old")).unionByName(new.select(*keys, F.lit(0).alias("_old")))
    per_key = both.groupBy(*keys).agg(F.sum("_old").alias("_old"))
    return per_key.agg(
        F.greatest(F.count("*") - F.coalesce(F.sum("_old"), F.lit(0)), F.lit(0)).cast("long").alias("inserted"))


def merge_measures(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                   identity: Sequence[str], measures: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Insert new keys; for known keys replace the measures and keep the identity columns.

    The update wins even where its measure is null. ``order`` ranks several updates of
    one key. One aggregate over both tables: one shuffle, combined map-side.
    """
    return tagged(target, updates, keys, identity, measures, order).drop("_new", "_met")


def tagged(target: DataFrame, updates: DataFrame, keys: Sequence[str],
           identity: Sequence[str], measures: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``merge_measures`` with two flags per key: ``_new`` if ``target`` lacks it, ``_met`` if
    ``updates`` has it."""
    rank = F.struct("_batch", *[F.col(f"_o{i}") for i in range(len(order))])
    rows = target.select(*keys, *identity, *measures, F.lit(0).alias("_batch"),
                         *[F.lit(None).cast(updates.schema[c].dataType).alias(f"_o{i}") for i, c in enumerate(order)])
    fresh = updates.select(*keys, *identity, *measures, F.lit(1).alias("_batch"),
                           *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    both = rows.unionByName(fresh)
    parts = {"_id": (F.min_by, identity), "_m": (F.max_by, measures)}
    parts = {name: part for name, part in parts.items() if part[1]}
    merged = both.groupBy(*keys).agg(
        *[pick(F.struct(*cols), rank).alias(name) for name, (pick, cols) in parts.items()],
        (F.min("_batch") == 1).alias("_new"), (F.max("_batch") == 1).alias("_met"))
    return merged.select(*keys, *[f"{name}.*" for name in parts], "_new", "_met")


def append_counted(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, Observation]:
    """``append_unique`` and what it adds: writing the rows fills the observation with
    ``inserted`` (keys that ``old`` lacked) and ``rows``, in the same job."""
    both = old.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)))
    rank = F.struct("_batch", *order)
    kept = both.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in old.columns if c not in keys]), rank).alias("_r"),
                                   (F.min("_batch") == 1).alias("_new"))
    seen = Observation()
    counted = kept.observe(seen, F.count_if("_new").alias("inserted"), F.count("*").alias("rows"))
    return counted.select(*keys, "_r.*").select(*old.columns), seen
