"""Profiles, correlation and rankings."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazeframe.operators.columns import numeric_columns
from hazeframe.scale import medians, one_row, quantiles
from hazeframe.session import ship


def _long(row: DataFrame, parts: dict[str, list], names: Sequence[str]) -> DataFrame:
    """Turn one wide row into one row per entry of ``parts``."""
    items = [F.struct(F.lit(k).alias("column_name"), *[F.col(c).alias(n) for c, n in zip(cols, names)])
             for k, cols in parts.items()]
    return row.select(F.explode(F.array(*items)).alias("_e")).select("_e.*")


def daily_median(df: DataFrame, ts: str, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Median of every numeric column per date; rows without a date are left out."""
    cols = list(cols or numeric_columns(df))
    dated = df.select(F.to_date(ts).alias("date"), *cols).where("date is not null")
    return medians(dated, ["date"], cols, approx)


def hour_of_day_mean(df: DataFrame, ts: str, cols: Sequence[str]) -> DataFrame:
    return (df.where(F.col(ts).isNotNull()).groupBy(F.hour(ts).alias("hour"))
            .agg(*[F.avg(c).alias(c) for c in cols]))


def top_medians(df: DataFrame, key: str, col: str, n: int = 10) -> DataFrame:
    """Keys with the highest medians."""
    med = medians(df.where(F.col(key).isNotNull()).select(key, col), [key], [col])
    return med.orderBy(F.desc_nulls_last(col), key).limit(n)


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max; one row per column."""
    basic = one_row(df.agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (
        ("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))]))
    q = quantiles(df, [], cols, [0.25, 0.5, 0.75]).withColumn("_b", basic)
    flat = q.select("*", "_b.*")
    items = [F.struct(
        F.lit(c).alias("column_name"), F.col(f"count_{c}").alias("count"), F.col(f"mean_{c}").alias("mean"),
        F.col(f"std_{c}").alias("std"), F.col(f"min_{c}").cast("double").alias("min"),
        F.col(c)[0].alias("q25"), F.col(c)[1].alias("q50"), F.col(c)[2].alias("q75"),
        F.col(f"max_{c}").cast("double").alias("max")) for c in cols]
    return flat.select(F.explode(F.array(*items)).alias("_e")).select("_e.*")


def boxplot(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (extremes within 1.5 IQR) and outlier count per column."""
    q = one_row(quantiles(df, [], cols, [0.25, 0.5, 0.75]))
    data = df.select(*cols).withColumn("_q", q)
    aggs = [F.first("_q").alias("_q")]
    for c in cols:
        q1, q3 = F.col("_q")[c][0], F.col("_q")[c][2]
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = F.col(c).between(low, high)
        aggs += [F.min(F.when(inside, F.col(c))).alias(f"lo_{c}"),
                 F.max(F.when(inside, F.col(c))).alias(f"hi_{c}"),
                 F.count_if(~inside).alias(f"out_{c}")]
    row = data.agg(*aggs)
    items = [F.struct(
        F.lit(c).alias("column_name"), F.col("_q")[c][0].alias("q1"), F.col("_q")[c][1].alias("median"),
        F.col("_q")[c][2].alias("q3"), F.col(f"lo_{c}").cast("double").alias("whisker_low"),
        F.col(f"hi_{c}").cast("double").alias("whisker_high"), F.col(f"out_{c}").alias("outliers"))
        for c in cols]
    return row.select(F.explode(F.array(*items)).alias("_e")).select("_e.*")


def null_profile(df: DataFrame) -> DataFrame:
    """Null count per column, highest first."""
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
    long = _long(row, {c: [f"n{i}"] for i, c in enumerate(df.columns)}, ["nulls"])
    return long.orderBy(F.desc("nulls"), "column_name")


def coverage(feeds: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows, parsed times, first and last date and distinct dates of each feed."""
    out = None
    for name, (df, ts) in feeds.items():
        days = df.groupBy(F.to_date(ts).alias("d")).agg(F.count("*").alias("n"))
        one = days.agg(
            F.lit(name).alias("feed"), F.sum("n").alias("rows_total"),
            F.coalesce(F.sum(F.when(F.col("d").isNotNull(), F.col("n"))), F.lit(0)).alias("rows_with_time"),
            F.min("d").alias("first_date"), F.max("d").alias("last_date"), F.count("d").alias("dates"))
        out = one if out is None else out.unionByName(one)
    return out


_GRAM = "a int, b int, oa double, ob double, n double, sa double, sb double, saa double, sbb double, sab double"


def gram(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, n, sa, sb, saa, sbb, sab) per pair of columns, a <= b by their numbers: over the
    rows that hold both, the count, and the sums, squares and products of the values less
    an origin near them.

    One scan, however many columns there are: a task multiplies blocks of rows as matrices
    and emits one row per pair. Its origin is the first value it sees of each column; the
    few rows of a pair are moved to one origin and summed.
    """
    ship(df.sparkSession)
    upper = np.triu_indices(len(cols))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, ss, sp = (np.zeros((len(cols), len(cols))) for _ in range(4))
        origin = np.full(len(cols), np.nan)
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            has = np.isfinite(x)
            fresh = np.isnan(origin) & has.any(axis=0)
            origin[fresh] = x[has.argmax(axis=0)[fresh], fresh]
            x = np.where(has, x - np.nan_to_num(origin), 0.0)
            mask = has.astype(float)
            n += mask.T @ mask
            s += x.T @ mask  # row a, column b: sum of a where b is there
            ss += (x * x).T @ mask
            sp += x.T @ x
        origin = np.nan_to_num(origin)
        parts = [origin[upper[0]], origin[upper[1]], n[upper], s[upper], s.T[upper], ss[upper], ss.T[upper], sp[upper]]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(i.astype("int32")) for i in upper), *(pa.array(np.ascontiguousarray(v)) for v in parts)],
            names=[f.split()[0] for f in _GRAM.split(", ")])

    blocks = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]).mapInArrow(run, _GRAM).where("n > 0")
    # a row without values for every pair, so that none is missing
    place = [(F.col("id") / len(cols)).cast("int").alias("a"), (F.col("id") % len(cols)).cast("int").alias("b")]
    nothing = df.sparkSession.range(len(cols) ** 2).select(*place).where("a <= b").selectExpr(
        "a", "b", "cast(null as double) as oa", "cast(null as double) as ob", *[f"0D as {c}" for c in ("n", "sa", "sb", "saa", "sbb", "sab")])
    blocks = blocks.unionByName(nothing)
    pair = Window.partitionBy("a", "b")
    n = F.col("n")
    da, db = (F.coalesce(F.col(c) - F.min(c).over(pair), F.lit(0.0)) for c in ("oa", "ob"))
    moved = blocks.withColumns({"da": da, "db": db}).select(
        "a", "b", "n", (F.col("sa") + n * F.col("da")).alias("sa"), (F.col("sb") + n * F.col("db")).alias("sb"),
        (F.col("saa") + 2 * F.col("da") * F.col("sa") + n * F.col("da") * F.col("da")).alias("saa"),
        (F.col("sbb") + 2 * F.col("db") * F.col("sb") + n * F.col("db") * F.col("db")).alias("sbb"),
        (F.col("sab") + F.col("da") * F.col("sb") + F.col("db") * F.col("sa") + n * F.col("da") * F.col("db")).alias("sab"))
    return moved.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "saa", "sbb", "sab")])


def _correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair a <= b over the rows that hold both; null where no
    row does."""
    sums = gram(df, cols)
    n = F.nullif("n", F.lit(0.0))
    va = F.col("saa") - F.col("sa") * F.col("sa") / n
    vb = F.col("sbb") - F.col("sb") * F.col("sb") / n
    # what rounding leaves of the squares of a constant is no variance
    spread = (va > 1e-13 * F.col("saa")) & (vb > 1e-13 * F.col("sbb"))
    value = F.try_divide(F.col("sab") - F.col("sa") * F.col("sb") / n, F.sqrt(va * vb))
    corr = F.when(F.col("n") > 0, F.when(spread, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), value))).otherwise(F.lit(float("nan"))))
    names = F.array(*[F.lit(c) for c in cols])
    return sums.select(F.element_at(names, F.col("a") + 1).alias("a"), F.element_at(names, F.col("b") + 1).alias("b"), corr.alias("corr"))


def corr_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlation of every unordered pair, in one scan."""
    return _correlations(df, cols).where("a <> b")


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Full matrix in long form; each unordered pair is computed once and mirrored."""
    half = _correlations(df, cols)
    same = F.struct("a", "b", "corr")
    turned = F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("corr"))
    both = F.when(F.col("a") == F.col("b"), F.array(same)).otherwise(F.array(same, turned))
    return half.select(F.explode(both).alias("_e")).select("_e.*")


def top_pairs(df: DataFrame, cols: Sequence[str], n: int = 12, digits: int = 6) -> DataFrame:
    """Strongest pairs by absolute correlation, each unordered pair once."""
    ranked = (corr_pairs(df, cols).withColumn("abs_corr", F.round(F.abs("corr"), digits))
              .where("abs_corr is not null and not isnan(abs_corr)"))
    return ranked.orderBy(F.desc("abs_corr"), "a", "b").limit(n).select("a", "b", "abs_corr")


def tail(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)
