"""Boosted trees at every length from one fit.

The margin of a boosted ensemble is a sum over its trees in order, so the margins of all shorter ensembles are its prefix sums: a single
long fit answers for every number of trees. A row walks down all trees in one Arrow pass, and its outcomes at the lengths
asked for are counted in one aggregate.
"""

from __future__ import annotations

import json
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.operators.features import FEATURES, LABEL
from sieveline.operators.models import CLASS_WEIGHT, boosted_trees, with_class_weight
from sieveline.operators.search import SearchResult, _objective, recalls
from sieveline.sources.artifacts import store_model
from sieveline.sources.scratch import remove, scratch_path


class Tree(NamedTuple):
    """The nodes of one tree by number: tested feature, threshold, children (a leaf is its own), weighted value and depth."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int


def read_trees(spark: SparkSession, model: GBTClassificationModel) -> list[Tree]:
    """The trees of a model in order, read from its saved node table. Only the model comes to the driver."""
    path = scratch_path(spark, "model")
    store_model(model, path)
    nodes: dict[int, dict] = {}
    for row in spark.read.parquet(f"{path}/data").select("treeID", "nodeData").collect():
        nodes.setdefault(row["treeID"], {})[row["nodeData"]["id"]] = row["nodeData"]
    remove(spark, path)
    trees = []
    for number, own in sorted(nodes.items()):
        n = max(own) + 1
        feature, threshold = np.zeros(n, np.int64), np.full(n, np.inf)
        left, right, value = np.arange(n), np.arange(n), np.zeros(n)
        depth, level = 0, [0]
        while level:
            below = []
            for k in level:
                node = own[k]
                value[k] = node["prediction"] * model.treeWeights[number]
                if node["leftChild"] >= 0:
                    if node["split"]["numCategories"] != -1:
                        raise ValueError("staged margins need numeric features; the model splits on categories")
                    feature[k], threshold[k] = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"][0]
                    left[k], right[k] = node["leftChild"], node["rightChild"]
                    below += [left[k], right[k]]
            depth, level = depth + bool(below), below
        trees.append(Tree(feature, threshold, left, right, value, depth))
    return trees


def margin_function(shared):
    """The function that runs in the tasks: from feature rows to the margin after each of the stages."""

    def margins(column: pa.Array) -> pa.Array:
        trees, stages = shared.value
        rows = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
        everyone = np.arange(len(rows))
        total = np.zeros(len(rows))
        out = np.zeros((len(rows), len(stages)))
        for number in range(max(stages, default=0) + 1):
            for k, stage in enumerate(stages):
                if stage == number:
                    out[:, k] = total
            if number >= len(trees) or number >= max(stages, default=0):
                continue
            feature, threshold, left, right, value, depth = trees[number]
            at = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                at = np.where(rows[everyone, feature[at]] <= threshold[at], left[at], right[at])
            total = total + value[at]
        ends = pa.array(np.arange(len(column) + 1, dtype=np.int32) * len(stages))
        return pa.ListArray.from_arrays(ends, pa.array(out.ravel()))

    return margins


def staged_margins(df: DataFrame, model: GBTClassificationModel, stages: list[int], features: str = FEATURES, output: str = "margins") -> DataFrame:
    """Add an array: the margin of the model cut off after each number of trees in ``stages``.

    A stage beyond the trees of the model has the margin of the whole; one of 0 has none, 0.
    """
    if any(s < 0 for s in stages):
        raise ValueError("a number of trees must not be negative")
    trees = read_trees(df.sparkSession, model)
    # its size is that of the model
    shared = df.sparkSession.sparkContext.broadcast(([tuple(t) for t in trees], list(stages)))
    return df.withColumn(output, F.arrow_udf(margin_function(shared), "array<double>")(vector_to_array(features)))


def staged_outcomes(
    df: DataFrame, model: GBTClassificationModel, stages: list[int], keys: list[str], label: str = LABEL, features: str = FEATURES
) -> DataFrame:
    """(n_estimators, keys, label, prediction, n): what each shorter model predicts, from one scan and one aggregate."""
    ladder = F.array(*[F.lit(s) for s in stages])
    found = staged_margins(df.select(*keys, label, features), model, stages, features, "_margins")
    each = F.explode(F.arrays_zip(ladder.alias("stage"), F.col("_margins").alias("margin"))).alias("e")
    rows = found.select(*keys, F.col(label).alias("label"), each)
    prediction = (F.col("e.margin") > 0).cast("double")
    return rows.groupBy(F.col("e.stage").alias("n_estimators"), *keys, "label", prediction.alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def staged_search(
    train: DataFrame,
    validation: DataFrame,
    settings: list[dict],
    seed: int,
    stages: list[int],
    objective: str = "recall",
    label: str = LABEL,
) -> SearchResult:
    """Fit each setting once, at its largest number of trees, and score it at all ``stages`` up to that; the best is refitted.

    ``trials`` has a row (trial, params, score) per setting and number of trees, ``outcomes`` their counts (trial, set, label,
    prediction, n). Of equal scores the earlier setting wins, then the fewer trees.
    """
    if not settings or not stages:
        raise ValueError("settings and stages must not be empty")
    if objective not in ("recall", "penalized"):
        raise ValueError("objective must be recall or penalized")
    spark = train.sparkSession
    if any(s.get(CLASS_WEIGHT) for s in settings):
        train, _ = with_class_weight(train, "balanced", label)
    train, validation = train.persist(), validation.persist()
    penalized = objective == "penalized"
    tried: list[dict] = []
    counted: list[tuple] = []
    try:
        sets = validation.select(F.lit("validation").alias("_set"), label, FEATURES)
        if penalized:
            sets = sets.unionByName(train.select(F.lit("train").alias("_set"), label, FEATURES))
        for setting in settings:
            most = setting.get("n_estimators", max(stages))
            own = sorted({min(s, most) for s in stages})
            weight = CLASS_WEIGHT if setting.get(CLASS_WEIGHT) else None
            model = boosted_trees(setting | {"n_estimators": max(own)}, seed, label=label, weight=weight).fit(train)
            place = {stage: len(tried) + k for k, stage in enumerate(own)}
            tried += [setting | {"n_estimators": stage} for stage in own]
            rows = staged_outcomes(sets, model, own, ["_set"], label).collect()  # a row per stage, set, class and prediction
            counted += [(place[r["n_estimators"]], r["_set"], r["label"], r["prediction"], r["n"]) for r in rows]
        found = recalls(counted)
        scores = [_objective(found, i, penalized) for i in range(len(tried))]
        best = max(range(len(tried)), key=lambda i: (scores[i], -i))
        weight = CLASS_WEIGHT if tried[best].get(CLASS_WEIGHT) else None
        model = boosted_trees(tried[best], seed, label=label, weight=weight).fit(train)
    finally:
        train.unpersist()
        validation.unpersist()
    rows = [(i, json.dumps(s, sort_keys=True), v) for i, (s, v) in enumerate(zip(tried, scores, strict=True))]
    kind = train.schema[label].dataType.simpleString()
    outcomes = spark.createDataFrame(counted, f"trial int, set string, label {kind}, prediction double, n long")
    return SearchResult(tried[best], scores[best], model, spark.createDataFrame(rows, "trial int, params string, score double"), outcomes)
