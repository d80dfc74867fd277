"""Stations that fall silent: keyed state with event-time timers.

Stations are dealt into buckets, and the state of a bucket holds the open spells of readings
of its stations, as first and last time, number of readings and the last valid value. A
spell ends once the watermark has passed its last reading by the allowed silence: a timer
of the bucket stands at the earliest such end. Ended spells are reported and their state is
dropped, so state is held for talking stations only. A call from Spark to Python costs
milliseconds whatever it holds, so a batch makes some per bucket, not per station or spell.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, StringType, StructField, StructType, TimestampNTZType

from hazeframe.session import ship

Spell = tuple[int, int, int, int, float]  # first, last, readings, time of the last valid value, value
SPELL = {"first": "int64", "last": "int64", "readings": "int64", "valid_at": "int64", "value": "float64"}
#: Buckets that the stations are dealt into; a checkpoint goes on only with the same number.
BUCKETS = 512
NEVER = -(1 << 62)
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def merge_spells(spells: list[Spell], gap: int) -> list[Spell]:
    """Spells in time order, those no more than ``gap`` apart as one."""
    out: list[Spell] = []
    for first, last, n, at, value in sorted(spells):
        if out and first - out[-1][1] <= gap:
            a = out[-1]
            valid = (at, value) if at > a[3] else a[3:]
            out[-1] = (a[0], max(a[1], last), a[2] + n, *valid)
        else:
            out.append((first, last, n, at, value))
    return out


def spells_of(times: np.ndarray, values: np.ndarray, gap: int) -> list[Spell]:
    """Spells of readings in any order. Of valid values with one time the largest counts."""
    order = np.lexsort((np.nan_to_num(values, nan=-np.inf), times))
    times, values = times[order], values[order]
    starts = np.flatnonzero(np.r_[True, np.diff(times) > gap]) if len(times) else np.empty(0, int)
    out = []
    for lo, hi in zip(starts, np.r_[starts[1:], len(times)]):
        valid = np.flatnonzero(~np.isnan(values[lo:hi]))
        last = (int(times[lo + valid[-1]]), float(values[lo + valid[-1]])) if len(valid) else (NEVER, float("nan"))
        out.append((int(times[lo]), int(times[hi - 1]), int(hi - lo), *last))
    return out


def joined_spells(parts: pd.DataFrame, keys: list[str], gap: int) -> pd.DataFrame:
    """``merge_spells`` of many stations at once: columns ``keys`` and ``SPELL`` in any order.
    Of valid values with one time the largest counts."""
    codes = np.zeros(len(parts), np.int64)
    for k in keys:
        own, kinds = pd.factorize(parts[k], use_na_sentinel=False)
        codes = pd.factorize(codes * len(kinds) + own)[0] if len(kinds) else codes
    order = np.lexsort((parts["first"].to_numpy(), codes))
    parts, codes = parts.iloc[order], codes[order]
    reach = parts["last"].groupby(codes).cummax().to_numpy()
    first = parts["first"].to_numpy()
    fresh = np.r_[True, (np.diff(codes) != 0) | (first[1:] - reach[:-1] > gap)][:len(parts)]
    starts = np.flatnonzero(fresh)
    if len(starts) == len(parts):
        return parts.reset_index(drop=True)
    ends = np.r_[starts[1:], len(parts)] - 1
    best = np.lexsort((parts["value"].fillna(-np.inf).to_numpy(), parts["valid_at"].to_numpy(), np.cumsum(fresh)))[ends]
    out = parts.iloc[starts].reset_index(drop=True)
    return out.assign(last=reach[ends], readings=np.add.reduceat(parts["readings"].to_numpy(), starts),
                      valid_at=parts["valid_at"].to_numpy()[best], value=parts["value"].to_numpy()[best])


class Silence(StatefulProcessor):
    """Open spells of a bucket of stations, kept as one Arrow table, with one timer at the
    earliest end. Times are whole milliseconds, which timers count in."""

    def __init__(self, keys: list[str], gap: int):
        self.keys, self.gap = keys, gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open_spells", "spells binary")

    def _read(self) -> pd.DataFrame:
        row = self.open.get()
        if row is None:
            return pd.DataFrame({**{k: pd.Series(dtype=object) for k in self.keys}, **{c: pd.Series(dtype=t) for c, t in SPELL.items()}})
        return pa.ipc.open_stream(row[0]).read_all().to_pandas().astype({**dict.fromkeys(self.keys, object), **SPELL})

    def _put(self, spells: pd.DataFrame) -> None:
        if spells.empty:
            self.open.clear()
            return
        table = pa.table({c: pa.array(spells[c], from_pandas=True) for c in spells})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as to:
            to.write_table(table)
        self.open.update((sink.getvalue().to_pybytes(),))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        old = now = self._read()
        for pdf in rows:
            at, value = pdf["at_ms"].to_numpy(np.int64), pdf["read_value"].to_numpy(float)
            fresh = pdf[self.keys].astype(object).assign(
                first=at, last=at, readings=np.int64(1), valid_at=np.where(np.isnan(value), NEVER, at), value=value)
            now = joined_spells(pd.concat([now, fresh], ignore_index=True) if len(now) else fresh, self.keys, self.gap)
        self._put(now)
        due = int(now["last"].min()) + self.gap
        before = int(old["last"].min()) + self.gap if len(old) else None
        if before != due:
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(due)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        spells = self._read()
        # as timers fire, at the watermark too; the timer handled here is deleted afterwards
        over = (spells["last"] + self.gap <= timerValues.getCurrentWatermarkInMs()).to_numpy()
        kept = spells[~over]
        self._put(kept)
        if len(kept):
            self.handle.registerTimer(int(kept["last"].min()) + self.gap)
        done = spells[over]
        if len(done):
            at = {f"{c}_ts": pd.to_datetime(done[c], unit="ms") for c in ("first", "last")}
            yield done[self.keys].assign(**at, readings=done["readings"], value=done["value"])

    def close(self) -> None:
        pass


@contextmanager
def rocksdb(spark: SparkSession):
    """The state store that timers need, for streams started inside."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, PROVIDER)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def silent_stations(rows: DataFrame, by: list[str], ts: str, value: str, silence: str = "6 hours", delay: str = "2 hours") -> DataFrame:
    """One row per spell of readings that ended because its station sent nothing for
    ``silence``: keys, first_ts, last_ts (whole milliseconds), readings, and the last valid
    value, null if none was. Rows later than ``delay`` may still extend a spell; rows behind
    the watermark are cut off. Needs the RocksDB state store.
    """
    spark = rows.sparkSession
    ship(spark)
    gap = int(spark.range(1).select(F.expr(f"cast(interval {silence} as interval second)").cast("decimal(18,3)")).first()[0] * 1000)
    # rows reach the processor as named tuples, whose names cannot begin with an underscore;
    # keys go as text, since pandas makes floats of whole numbers beside a null
    types = [rows.schema[k].dataType for k in by]
    keys = [f"key{i}" for i in range(len(by))]
    texts = [F.col(k) if isinstance(t, (StringType, BinaryType)) else F.col(k).cast("string") for k, t in zip(by, types)]
    bucket = F.pmod(F.xxhash64(*by), F.lit(BUCKETS)).cast("int").alias("spell_bucket")
    keyed = rows.withWatermark(ts, delay).select(*[c.alias(n) for c, n in zip(texts, keys)], bucket, ts,
                                                 F.unix_millis(ts).alias("at_ms"), F.col(value).cast("double").alias("read_value"))
    out = StructType([keyed.schema[n] for n in keys]).add(StructField("first_ts", TimestampNTZType())).add(
        StructField("last_ts", TimestampNTZType())).add("readings", "long").add("value", "double")
    spells = keyed.groupBy("spell_bucket").transformWithStateInPandas(
        statefulProcessor=Silence(keys, gap), outputStructType=out, outputMode="Append", timeMode="EventTime")
    return spells.select(*[F.col(n).cast(t).alias(k) for n, t, k in zip(keys, types, by)], "first_ts", "last_ts", "readings", "value")
