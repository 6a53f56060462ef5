"""The training job from a raw table to a stored, evaluated model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.operators.clean import cast_to_int, columns_of_type, handle_missing, sentinel_to_null
from sieveline.operators.features import encode_label, fit_label_index, prepare_data
from sieveline.operators.metrics import confusion_matrix, multiclass_metrics
from sieveline.operators.models import random_forest, score
from sieveline.operators.search import grid_search, parameter_maps, refit, tuned_parameters
from sieveline.operators.selection import recursive_elimination
from sieveline.operators.split import assign_folds, hash_split
from sieveline.sources.artifacts import (
    CLEANED,
    FEATURES,
    HYPERPARAMETERS,
    MODEL,
    artifact_path,
    load_features,
    load_hyperparameters,
    load_model,
    store_features,
    store_hyperparameters,
    store_model,
    stored,
)
from sieveline.sources.manifests import Stages, data_fingerprint

# The default search ranges, minimum number of features and seed of a training run.
SEARCH_RANGES = {
    "numTrees": {"start": 3, "stop": 50, "num": 5},
    "maxDepth": {"start": 2, "stop": 10, "num": 2},
    "maxBins": {"start": 3, "stop": 64, "num": 2},
}
MIN_FEATURES = 30
SEED = 2023
FOLDS = 5

SPLIT = "_split"
FOLD = "_fold"


@dataclass(frozen=True)
class TrainingResult:
    model: Model
    features: list[str]
    hyperparameters: dict
    scored: DataFrame
    metrics: DataFrame
    confusion: DataFrame
    stages: DataFrame


def clean_table(
    table: DataFrame,
    target: str,
    key: str | list[str] | None = None,
    null_threshold: float = 0.5,
    seed: int = SEED,
    fit_on: str = "all",
    median: str = "approx",
    median_error: float = 0.01,
    nan_as_null: bool = False,
) -> DataFrame:
    """Sentinels to null, text columns to INT, sparse columns out, medians in; with split and fold.

    The split hashes ``key``, or all columns where there is none, before anything is changed, so that
    equal rows never sit on both sides.
    """
    if fit_on not in ("all", "train"):
        raise ValueError("fit_on must be all or train")
    keys = table.columns if key is None else key
    table = assign_folds(hash_split(table, keys, seed=seed, output=SPLIT), keys, FOLDS, seed + 1, FOLD)
    text = [c for c in columns_of_type(table, "string") if c not in (target, SPLIT)]
    table = cast_to_int(sentinel_to_null(table, columns=text), text)
    base = table.where(F.col(SPLIT) == "train") if fit_on == "train" else None
    return handle_missing(table, text, null_threshold, median, median_error, base, nan_as_null)


def train_classifier(
    table: DataFrame,
    work_dir: str,
    target: str = "target",
    key: str | list[str] | None = None,
    ignore: tuple[str, ...] = (),
    null_threshold: float = 0.5,
    min_features: int = MIN_FEATURES,
    ranges: dict[str, dict] | None = None,
    seed: int = SEED,
    fit_on: str = "all",
    select: bool = True,
    parallelism: int = 4,
    median: str = "approx",
    median_error: float = 0.01,
    nan_as_null: bool = False,
    unseen: str = "error",
    stale: str = "rebuild",
) -> TrainingResult:
    """Clean, split, select features, tune a forest by cross-validation, evaluate and store it.

    The cleaned table, the selected features, the hyperparameters and the model are stages below ``work_dir``, each with a manifest of
    what it was made from: input rows, arguments, the stages before. A job that was stopped goes on from the last finished stage, and
    stages that are still right are not written again. What other inputs or arguments have made stale, ``stale`` decides:
    ``rebuild`` it, ``refuse`` with an error, or ``keep`` features and hyperparameters that were searched on other data. Features and
    hyperparameters stored by hand in place of those of a finished stage are taken. ``stages`` of the result tells what was done.
    ``select=False`` trains on all features. ``unseen`` says what becomes of test rows whose class the label
    index has not met, which takes ``fit_on="train"``: ``error``, ``skip`` or ``keep`` as a class of its own. Columns in ``ignore``, such as a row id, are no features.
    """
    if not work_dir.strip() or not target.strip():
        raise ValueError("work_dir and target must not be empty")
    spark = table.sparkSession
    stages = Stages(spark, work_dir, stale)
    path = {kind: artifact_path(work_dir, kind) for kind in (CLEANED, FEATURES, HYPERPARAMETERS, MODEL)}

    def write_cleaned() -> None:
        rows = clean_table(table, target, key, null_threshold, seed, fit_on, median, median_error, nan_as_null)
        rows.write.mode("overwrite").parquet(path[CLEANED])

    cleaned = stages.run(
        CLEANED,
        write_cleaned,
        lambda: spark.read.parquet(path[CLEANED]),
        lambda: stored(spark, path[CLEANED]),
        data=data_fingerprint(table),
        target=target,
        key=key,
        null_threshold=null_threshold,
        seed=seed,
        fit_on=fit_on,
        median=(median, median_error, nan_as_null),
    )
    train, test = (cleaned.where(F.col(SPLIT) == s) for s in ("train", "test"))
    features = [c for c in cleaned.columns if c not in (target, SPLIT, FOLD, *ignore)]
    index = fit_label_index(train if fit_on == "train" else cleaned, target, handle_invalid=unseen)
    before = {"cleaned": stages.states[-1][2]}

    if select:
        features = stages.run(
            FEATURES,
            lambda: store_features(spark, recursive_elimination(encode_label(train, index), features, min_features, seed), path[FEATURES]),
            lambda: load_features(spark, path[FEATURES]),
            lambda: stored(spark, path[FEATURES]),
            found=True,
            candidates=features,
            min_features=min_features,
            **before,
        )
        before = {"selected": stages.states[-1][2]}

    prepared, held_out = prepare_data(train, test, features, target, index, keep=[FOLD])
    forest = random_forest(seed)
    ranges = SEARCH_RANGES if ranges is None else ranges
    tuned = {}

    def search() -> None:
        found = grid_search(forest, parameter_maps(forest, ranges), prepared, FOLD, FOLDS, parallelism=parallelism)
        tuned["model"] = found.best_model
        store_hyperparameters(spark, tuned_parameters(found.best_model, list(ranges)), path[HYPERPARAMETERS])

    hyperparameters = stages.run(
        HYPERPARAMETERS,
        search,
        lambda: load_hyperparameters(spark, path[HYPERPARAMETERS]),
        lambda: stored(spark, path[HYPERPARAMETERS], "json"),
        found=True,
        ranges=ranges,
        unseen=unseen,
        **before,
    )
    # the model follows what the stored features and hyperparameters are, also where they were put there by hand
    model = stages.run(
        MODEL,
        lambda: store_model(tuned.get("model") or refit(forest, hyperparameters, prepared), path[MODEL]),
        lambda: load_model(RandomForestClassificationModel, path[MODEL]),
        lambda: stored(spark, f"{path[MODEL]}/data"),
        features=features,
        hyperparameters=hyperparameters,
        **before,
    )

    scored = score(model, held_out)
    return TrainingResult(
        model, features, hyperparameters, scored, multiclass_metrics(scored), confusion_matrix(scored), stages.table()
    )
