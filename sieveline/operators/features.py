"""Label index, feature vector, importances and class weights."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sieveline.operators.clean import project_features

LABEL = "label"
FEATURES = "features"


def fit_label_index(
    df: DataFrame, column: str, output: str = LABEL, handle_invalid: str = "error"
) -> StringIndexerModel:
    """Number the labels by falling frequency, ties by their text. ``handle_invalid`` says what an
    unseen label does later: ``error``, ``skip`` or ``keep``."""
    return StringIndexer(inputCol=column, outputCol=output, handleInvalid=handle_invalid).fit(df)


def label_table(spark: SparkSession, index: StringIndexerModel) -> DataFrame:
    rows = [(name, float(i)) for i, name in enumerate(index.labels)]
    return spark.createDataFrame(rows, "label string, label_index double")


def encode_label(df: DataFrame, index: StringIndexerModel) -> DataFrame:
    return index.transform(df)


def assemble(df: DataFrame, columns: list[str], output: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=output).transform(df)


def prepare_data(
    train: DataFrame,
    test: DataFrame,
    features: list[str],
    label: str,
    index: StringIndexerModel,
    keep: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Project to features and label, index the label and assemble the vector, for both sets.

    Columns in ``keep``, such as an id or a fold, come along.
    """

    def prepared(df: DataFrame) -> DataFrame:
        return assemble(encode_label(project_features(df, features + (keep or []), label), index), features)

    return prepared(train), prepared(test)


def importance_table(spark: SparkSession, model, features: list[str]) -> DataFrame:
    """(feature, importance) of a fitted tree ensemble."""
    values = model.featureImportances.toArray()
    if len(values) != len(features):
        raise ValueError(f"the model has {len(values)} features, {len(features)} names were given")
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return spark.createDataFrame(rows, "feature string, importance double")


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """(label, class_weight): rows / (classes * rows of the class)."""
    every = Window.partitionBy()
    # one row per class
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    weight = F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n"))
    return counts.select(label, weight.alias("class_weight"))


def balanced_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Add ``class_weight`` so that every class carries the same total weight."""
    # one row per class; Spark sees the size and broadcasts it if it is small
    return df.join(class_weights(df, label), label, "left")
