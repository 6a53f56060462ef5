"""Selected features, hyperparameters and fitted models on shared storage.

Every store replaces what was there, so a repeated run does not fail on an existing path, and every
load uses the same path function as its store.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.ml import Estimator
from pyspark.ml.util import MLReadable, MLWritable
from pyspark.sql import DataFrame, SparkSession

FEATURES = "selected_features"
HYPERPARAMETERS = "hyperparameters"
MODEL = "final_model"
CLEANED = "cleaned"


def artifact_path(work_dir: str, kind: str) -> str:
    return f"{work_dir.rstrip('/')}/{kind}"


def feature_table(spark: SparkSession, features: list[str]) -> DataFrame:
    rows = [(i, f) for i, f in enumerate(features)]
    return spark.createDataFrame(rows, "position int, selected_features string")


def store_features(spark: SparkSession, features: list[str], path: str) -> None:
    feature_table(spark, features).coalesce(1).write.mode("overwrite").parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_features(spark: SparkSession, path: str) -> list[str]:
    """The stored names in the order they were stored."""
    rows = read_features(spark, path).orderBy("position").select("selected_features").collect()
    return [r[0] for r in rows]


def hyperparameter_table(spark: SparkSession, params: dict) -> DataFrame:
    """One row per parameter; the value is kept as JSON so that its type comes back."""
    rows = sorted((name, json.dumps(value)) for name, value in params.items())
    return spark.createDataFrame(rows, "param string, value string")


def store_hyperparameters(spark: SparkSession, params: dict, path: str) -> None:
    hyperparameter_table(spark, params).coalesce(1).write.mode("overwrite").json(path)


def load_hyperparameters(spark: SparkSession, path: str) -> dict:
    rows = spark.read.schema("param string, value string").json(path).collect()
    return {r["param"]: json.loads(r["value"]) for r in sorted(rows)}


def with_hyperparameters(estimator: Estimator, params: dict) -> Estimator:
    """A copy of the estimator with the named parameters set; an unknown name is an error."""
    unknown = sorted(name for name in params if not estimator.hasParam(name))
    if unknown:
        raise ValueError(f"{type(estimator).__name__} has no parameter {', '.join(unknown)}")
    return estimator.copy({estimator.getParam(name): value for name, value in params.items()})


def store_model(model: MLWritable, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(model_type: type[MLReadable], path: str):
    return model_type.load(path)


def stored(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Whether a finished table lies at ``path``; a missing or still empty folder counts as no."""
    try:
        return len(spark.read.format(fmt).load(path).columns) > 0
    except AnalysisException:
        return False
