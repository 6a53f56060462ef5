"""Forests and boosted trees of Spark ML, and scoring with them."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.operators.features import FEATURES, LABEL, balanced_weights
from sieveline.sources.artifacts import with_hyperparameters

# Names of boosted-tree settings and the Spark ML parameter each one sets.
BOOSTED_PARAMETERS = {
    "n_estimators": "maxIter",
    "learning_rate": "stepSize",
    "max_depth": "maxDepth",
    "max_bin": "maxBins",
    "min_data_in_leaf": "minInstancesPerNode",
    "min_gain_to_split": "minInfoGain",
    "feature_fraction": "featureSubsetStrategy",
    "sampling_rate": "subsamplingRate",
}

# Settings without a counterpart in Spark ML, whose trees grow level by level.
WITHOUT_COUNTERPART = ("num_leaves", "min_samples_split", "boosting_type")

MAX_DEPTH = 30
CLASS_WEIGHT = "class_weight"


def random_forest(
    seed: int, label: str = LABEL, features: str = FEATURES, weight: str | None = None, **params
) -> RandomForestClassifier:
    """A forest with Spark ML's defaults unless ``params`` says otherwise."""
    forest = RandomForestClassifier(featuresCol=features, labelCol=label, seed=seed)
    if weight is not None:
        forest.setWeightCol(weight)
    return with_hyperparameters(forest, params)


def spark_parameters(settings: dict) -> dict:
    """Translate boosted-tree settings to Spark ML parameters.

    ``class_weight`` is left out here, see :func:`with_class_weight`; settings without counterpart
    are ignored; an unknown name is an error.
    """
    params = {}
    for name, value in settings.items():
        if name == CLASS_WEIGHT or name in WITHOUT_COUNTERPART:
            continue
        if name not in BOOSTED_PARAMETERS:
            raise ValueError(f"unknown boosted-tree setting {name}")
        target = BOOSTED_PARAMETERS[name]
        if target == "featureSubsetStrategy":
            # a fraction is written with a point: "1" would mean one feature
            value = "all" if value >= 1 else str(float(value))
        elif target == "maxDepth":
            value = min(value, MAX_DEPTH)
        elif target in ("minInfoGain", "stepSize", "subsamplingRate"):
            value = float(value)
        params[target] = value
    return params


def boosted_trees(
    settings: dict, seed: int, label: str = LABEL, features: str = FEATURES, weight: str | None = None
) -> GBTClassifier:
    """Gradient-boosted trees for a 0/1 label."""
    booster = GBTClassifier(featuresCol=features, labelCol=label, seed=seed)
    if weight is not None:
        booster.setWeightCol(weight)
    return with_hyperparameters(booster, spark_parameters(settings))


def with_class_weight(train: DataFrame, setting: str | None, label: str = LABEL) -> tuple[DataFrame, str | None]:
    """The training set with a weight column for ``"balanced"``, and the name of that column."""
    if setting is None:
        return train, None
    if setting != "balanced":
        raise ValueError("class_weight must be None or balanced")
    if CLASS_WEIGHT in train.columns:
        return train, CLASS_WEIGHT
    return balanced_weights(train, label), CLASS_WEIGHT


def score(model, df: DataFrame) -> DataFrame:
    """Add the prediction with its raw scores and class probabilities."""
    return model.transform(df)


def class_probability(df: DataFrame, index: int = 1, output: str = "score", probability: str = "probability") -> DataFrame:
    """Add the probability of one class as a plain column."""
    return df.withColumn(output, vector_to_array(F.col(probability))[index])


def top_scored(df: DataFrame, score_column: str = "score", id: str = "id") -> DataFrame:
    """The row with the highest score, the lowest id on ties; each task keeps one candidate."""
    return df.orderBy(F.desc(score_column), F.asc(id)).limit(1)
