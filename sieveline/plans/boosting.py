"""The boosted-tree study: search, shadow selection, second search, refit, diagnostics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.operators.clean import binarize_label
from sieveline.operators.explain import attribute, fit_explainer
from sieveline.operators.features import FEATURES, LABEL, assemble
from sieveline.operators.models import boosted_trees, class_probability, score
from sieveline.operators.search import BOOSTED_SPACE, SearchResult, draw_settings, random_search
from sieveline.operators.selection import shadow_selection, surviving_features
from sieveline.operators.split import three_way_split
from sieveline.plans.evaluation import Evaluation, evaluate_sets
from sieveline.sources.scratch import written

# Trials of the first search, of the shadow selection and of the second search.
FIRST_TRIALS = 200
SHADOW_TRIALS = 100
SECOND_TRIALS = 500
P_VALUE = 0.1

# Settings that are not searched.
STATIC_SETTINGS = {"sampling_rate": 1, "max_bin": 63}


@dataclass(frozen=True)
class BoostedResult:
    model: Model
    features: list[str]
    selection: DataFrame
    search: SearchResult
    scored: DataFrame
    attributions: DataFrame
    evaluation: Evaluation


def train_boosted(
    table: DataFrame,
    target: str,
    key: str,
    features: list[str],
    negative_value=1,
    space: dict[str, tuple] | None = None,
    first_trials: int = FIRST_TRIALS,
    shadow_trials: int = SHADOW_TRIALS,
    second_trials: int = SECOND_TRIALS,
    objective: str = "recall",
    p_value: float = P_VALUE,
    seed: int = 42,
    bins: int = 10,
    parallelism: int = 4,
) -> BoostedResult:
    """Run the study on a cleaned table whose ``key`` identifies a row.

    The label becomes 0 for ``negative_value`` and 1 otherwise, and the sets are 81 / 9 / 10 %. A
    first search over all features is followed by a shadow selection with the settings it found, a
    second search on the surviving features (all of them, should none survive) and a refit.
    Attributions are those of the test set.
    """
    labelled = binarize_label(table, target, negative_value, LABEL).withColumn(LABEL, F.col(LABEL).cast("double"))
    data = written(three_way_split(labelled.select(key, LABEL, *features), key), "study")
    space = BOOSTED_SPACE if space is None else space

    def search(names: list[str], trials: int, at: int) -> tuple[SearchResult, DataFrame]:
        ready = assemble(data, names).select(key, "split", LABEL, FEATURES)
        train, validation = (ready.where(F.col("split") == s) for s in ("train", "val"))
        settings = [STATIC_SETTINGS | s for s in draw_settings(space, trials, at)]
        return random_search(train, validation, settings, at, objective, parallelism=parallelism), ready

    first, _ = search(features, first_trials, seed)
    selection = shadow_selection(
        data.where(F.col("split") == "train"),
        features,
        key,
        seed,
        trials=shadow_trials,
        p_value=p_value,
        estimator=boosted_trees(first.best_params, seed),
        parallelism=parallelism,
    )
    kept = surviving_features(selection) or features
    found, ready = search(kept, second_trials, seed + 1)
    predicted = class_probability(score(found.best_model, ready))
    scored = written(predicted.withColumn(LABEL, F.col(LABEL).cast("int")).withColumnRenamed(key, "id"), "scored")
    explained = attribute(scored.where(F.col("split") == "test"), fit_explainer(table.sparkSession, found.best_model))
    return BoostedResult(
        found.best_model, kept, selection, found, scored, explained, evaluate_sets(scored, bins=bins, stored=True)
    )
