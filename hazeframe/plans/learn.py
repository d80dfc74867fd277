"""Regression of the index on hourly features with Spark ML.

A null feature is an error: fill both parts with ``fill_from_training`` first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeframe.plans.forecast import evaluate
from hazeframe.scale import medians

TRAIN_SHARE = 0.8


def split_by_time(df: DataFrame, ts: str, share: float = TRAIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """Rows before and after the point that cuts the time span at ``share``."""
    span = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
    cut = F.lit(span["lo"] + (span["hi"] - span["lo"]) * share).cast("timestamp_ntz")
    return df.where(F.col(ts) <= cut), df.where(F.col(ts) > cut)


def fill_from_training(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both parts with null features filled by the medians of the training part; 0 where
    that part has no value. No row is dropped, and no test row shapes the fill."""
    row = medians(train.select(*cols), [], cols).first()
    fill = {c: float(row[c]) if row is not None and row[c] is not None else 0.0 for c in cols}
    whole = {c: F.coalesce(F.col(c).cast("double"), F.lit(fill[c])) for c in cols}
    return train.withColumns(whole), test.withColumns(whole)


def fit_linear(train: DataFrame, features: Sequence[str], target: str, scale: bool = False) -> PipelineModel:
    vector = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    stages = [vector]
    used = "features"
    if scale:
        stages.append(StandardScaler(inputCol="features", outputCol="scaled", withMean=True))
        used = "scaled"
    return Pipeline(stages=stages + [LinearRegression(featuresCol=used, labelCol=target, solver="normal")]).fit(train)


def fit_trees(train: DataFrame, features: Sequence[str], target: str, rounds: int = 20, depth: int = 5,
              seed: int = 42) -> PipelineModel:
    vector = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    trees = GBTRegressor(labelCol=target, maxIter=rounds, maxDepth=depth, seed=seed)
    return Pipeline(stages=[vector, trees]).fit(train)


def metrics(model: PipelineModel, test: DataFrame, target: str, name: str) -> DataFrame:
    scored = model.transform(test).withColumn("model", F.lit(name))
    return evaluate(scored, ["model"], target, "prediction")


def importances(model: PipelineModel, features: Sequence[str], df: DataFrame) -> DataFrame:
    """Features with their importance, highest first; one row per feature."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature")
