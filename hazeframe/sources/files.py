"""Table sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazeframe.functions.casts import to_number, to_timestamp
from hazeframe.operators.columns import with_schema
from hazeframe.operators.joins import union_feeds


def read_text_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                    encoding: str = "utf-8") -> DataFrame:
    """CSV with a header, every column as text: bad cells never fail the scan.

    Without ``columns`` the names are read from the first header line on the driver; the
    finders of ``operators.columns`` then pick what a plan needs.
    """
    if columns is None:
        return (spark.read.option("header", True).option("inferSchema", False).option("mode", "PERMISSIVE")
                .option("encoding", encoding).csv(path))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
            .option("enforceSchema", False).option("encoding", encoding).csv(path))


def typed(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Cast text columns to double, long, boolean or timestamp; bad cells become null."""
    out = []
    for c in df.columns:
        kind = kinds.get(c, "string")
        if kind == "double":
            out.append(to_number(c).alias(c))
        elif kind == "timestamp":
            out.append(to_timestamp(c).alias(c))
        elif kind in ("string", "asis"):
            out.append(F.col(c))
        else:
            out.append(F.trim(F.col(c)).try_cast(kind).alias(c))
    return df.select(*out)


def read_if_present(spark: SparkSession, path: str, format: str = "parquet",
                    columns: Sequence[str] | None = None, encoding: str = "utf-8") -> DataFrame | None:
    """The table at ``path``, or None if the path is missing or holds no row."""
    try:
        df = read_text_table(spark, path, columns, encoding) if format == "csv" else spark.read.format(format).load(path)
        return None if df.isEmpty() else df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def first_source(spark: SparkSession, paths: Sequence[str], format: str = "parquet",
                 columns: Sequence[str] | None = None, encoding: str = "utf-8") -> DataFrame | None:
    """The first non-empty table of an ordered list."""
    for path in paths:
        df = read_if_present(spark, path, format, columns, encoding)
        if df is not None:
            return df
    return None


def all_sources(spark: SparkSession, paths: Sequence[str], format: str = "parquet",
                columns: Sequence[str] | None = None, encoding: str = "utf-8") -> DataFrame:
    """Every non-empty table of the list, stacked by column name with its list position."""
    found = [read_if_present(spark, p, format, columns, encoding) for p in paths]
    parts = [d.withColumn("source_no", F.lit(i)) for i, d in enumerate(found) if d is not None]
    if not parts:
        raise FileNotFoundError(f"no usable table among {list(paths)}")
    return union_feeds(*parts)


def write_by_date(df: DataFrame, path: str, ts: str, mode: str = "overwrite", max_rows: int = 20_000_000) -> None:
    """Parquet partitioned by date.

    Rows are ranged by date, time and a row hash, so a hot date, or a hot time, is written
    by many tasks, and files cover short time spans.
    """
    dated = df.withColumn("date", F.to_date(ts))
    ranged = dated.repartitionByRange("date", ts, F.xxhash64(*df.columns))
    ranged.write.mode(mode).option("maxRecordsPerFile", max_rows).partitionBy("date").parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; ``mode="append"`` adds files with their own header."""
    df.write.mode(mode).option("header", True).csv(path)


def write_report(df: DataFrame, json_path: str, csv_path: str) -> None:
    """Nested rows as JSON lines, and as CSV with nested columns in JSON text."""
    df.write.mode("overwrite").json(json_path)
    nested = (T.StructType, T.ArrayType, T.MapType)
    flat = df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
                       for f in df.schema.fields])
    write_csv(flat, csv_path)


def append_table(df: DataFrame, columns: Sequence[tuple[str, str]], format: str = "parquet", **options: str) -> None:
    """Append the expected columns to a table store, for example ``format="jdbc"``."""
    with_schema(df, columns).write.format(format).mode("append").options(**options).save()
