"""Parameter spaces, cross-validated grid search and random search.

The driver only picks parameters and compares one number per fit. Every fit is a Spark job over a persisted table; a
bounded pool keeps several of them in flight. Fitted candidates are scored together: one scan applies them all to a row,
and one aggregate counts the outcomes per candidate.
"""

from __future__ import annotations

import json
import random
from collections.abc import Callable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Model
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.operators.features import FEATURES, LABEL
from sieveline.operators.metrics import multiclass_metrics, multiclass_metrics_of, recall_of
from sieveline.operators.models import CLASS_WEIGHT, boosted_trees, with_class_weight
from sieveline.sources.artifacts import with_hyperparameters

# Range of a parameter that does not name its own.
DEFAULT_RANGE = {"start": 1, "stop": 10, "num": 5}

# The boosted-tree search space.
BOOSTED_SPACE = {
    "n_estimators": ("int", 3, 500),
    "learning_rate": ("float", 0.001, 0.3),
    "num_leaves": ("int", 20, 300),
    "feature_fraction": ("float", 0.2, 1.0),
    "max_depth": ("int", 3, 24),
    "min_data_in_leaf": ("int", 4, 500),
    "min_gain_to_split": ("int", 0, 15),
    "min_samples_split": ("int", 2, 10),
    "class_weight": ("choice", None, "balanced"),
}


#: Candidates that one scan scores: their models are held, and their predictions laid out beside a row, at the same time.
SCORED_TOGETHER = 20


OBJECTIVES = ("recall", "penalized")


@dataclass(frozen=True)
class SearchResult:
    """``trials`` has one row per candidate: (trial, params as JSON, ..., score); ``outcomes`` the counts that the scores come from."""

    best_params: dict
    best_score: float
    best_model: Model
    trials: DataFrame
    outcomes: DataFrame | None = None


def even_steps(start: Column, stop: Column, num: Column) -> Column:
    """``num`` evenly spaced values from start to stop, each rounded half to even, as an array; null
    if ``num`` is below 1."""
    step = F.try_divide((stop - start).cast("double"), (num - 1).cast("double"))
    value = lambda i: F.bround(start.cast("double") + F.coalesce(i * step, F.lit(0.0))).cast("int")
    return F.when(num >= 1, F.transform(F.sequence(F.lit(0), num - 1), value))


def search_space(ranges: DataFrame, keep: list[str]) -> DataFrame:
    """One row per value of a table of (start, stop, num) ranges."""
    values = even_steps(F.col("start"), F.col("stop"), F.col("num"))
    return ranges.select(*keep, F.posexplode(values).alias("step", "value"))


def parameter_grid(spaces: DataFrame, keep: list[str], parameters: list[str]) -> DataFrame:
    """All combinations of the arrays held in the parameter columns, without any join."""
    grid = spaces.select(*keep, *parameters)
    for p in parameters:
        grid = grid.withColumn(p, F.explode(p))
    return grid


def range_values(spec: dict) -> list[int]:
    """The values of one range as plain integers, for Spark ML's parameter maps."""
    unknown = sorted(spec.keys() - DEFAULT_RANGE.keys())
    if unknown:
        raise ValueError(f"unknown range setting {', '.join(unknown)}")
    full = DEFAULT_RANGE | spec
    start, stop, num = full["start"], full["stop"], full["num"]
    if num < 1:
        raise ValueError("a range needs at least one value")
    # the step is applied like in even_steps, so that both round the same numbers
    step = (stop - start) / (num - 1) if num > 1 else 0.0
    return [round(start + i * step) for i in range(num)]


def parameter_maps(estimator: Estimator, ranges: dict[str, dict]) -> list[dict]:
    """Spark ML parameter maps for every combination; an unknown parameter is an error."""
    builder = ParamGridBuilder()
    for name, spec in ranges.items():
        if not estimator.hasParam(name):
            raise ValueError(f"{type(estimator).__name__} has no parameter {name}")
        builder = builder.addGrid(estimator.getParam(name), range_values(spec))
    return builder.build()


def _named(param_map: dict) -> dict:
    return {param.name: value for param, value in param_map.items()}


def weighted_f1(scored: DataFrame, label: str = LABEL) -> float:
    return multiclass_metrics(scored, label, "prediction").first()["weighted_f1"]


def candidate_outcomes(models: dict[int, Model], rows: DataFrame, keys: list[str], label: str = LABEL) -> DataFrame:
    """(trial, keys, label, prediction, n): how often each model predicts what, from one scan of ``rows`` and one aggregate.

    A null label or prediction is a value of its own.
    """
    features = next(iter(models.values())).getFeaturesCol()
    given = scored = rows.select(*keys, F.col(label).alias("label"), features)
    for trial, model in models.items():
        names = {"predictionCol": f"_p{trial}", "probabilityCol": "", "rawPredictionCol": ""}
        scored = model.copy({model.getParam(p): v for p, v in names.items() if model.hasParam(p)}).transform(scored)
    each = F.array(*[F.struct(F.lit(t).alias("trial"), F.col(f"_p{t}").alias("prediction")) for t in models])
    out = scored.select(*[c for c in given.columns if c != features], F.inline(each))
    return out.groupBy("trial", *keys, "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def _score_together(fit: Callable[[int], Model], trials: list[int], count: Callable[[dict[int, Model]], DataFrame], parallelism: int) -> list:
    """Outcome rows of all trials; no more than :data:`SCORED_TOGETHER` models are held at a time."""
    rows: list = []
    for k in range(0, len(trials), SCORED_TOGETHER):
        part = trials[k : k + SCORED_TOGETHER]
        with ThreadPool(min(parallelism, len(part))) as pool:
            models = dict(zip(part, pool.map(fit, part, chunksize=1), strict=True))
        rows += count(models).collect()  # a row per trial, class and prediction
    return rows


def grid_search(
    estimator: Estimator,
    param_maps: list[dict],
    train: DataFrame,
    fold: str = "fold",
    folds: int = 5,
    metric: Callable[[DataFrame], float] | None = None,
    parallelism: int = 4,
    label: str = LABEL,
) -> SearchResult:
    """Mean weighted F1 over the folds per parameter map, then a refit of the best on all of ``train``.

    The folds are a column, so the sets are the same in every run, and they are cut by a plain
    predicate. The models of a fold score its rows in one scan; ``outcomes`` has their counts (trial, fold, label, prediction, n).
    A ``metric`` of your own takes a scan per model. Of equal means the earlier parameter map wins.
    """
    if not param_maps:
        raise ValueError("param_maps must name at least one parameter map")
    spark = train.sparkSession
    train = train.persist()
    trials = list(range(len(param_maps)))
    values: dict[tuple[int, int], float] = {}
    outcomes = None
    try:

        def fit(i: int, k: int) -> Model:
            return estimator.fit(train.where(F.col(fold) != k), param_maps[i])

        if metric is None:
            counted = []
            for k in range(folds):
                rows = train.where(F.col(fold) == k).select("*", F.lit(k).alias("_fold_number"))
                count = lambda models, rows=rows: candidate_outcomes(models, rows, ["_fold_number"], label)
                counted += _score_together(lambda i, k=k: fit(i, k), trials, count, parallelism)
            kind = train.schema[label].dataType.simpleString()
            outcomes = spark.createDataFrame([tuple(r) for r in counted], f"trial int, fold int, label {kind}, prediction double, n long")
            found = multiclass_metrics_of(outcomes, ["trial", "fold"]).collect()
            values = {(i, k): 0.0 for i in trials for k in range(folds)} | {(r["trial"], r["fold"]): r["weighted_f1"] for r in found}
        else:
            jobs = [(i, k) for k in range(folds) for i in trials]
            with ThreadPool(min(parallelism, len(jobs))) as pool:
                scores = pool.map(lambda job: metric(fit(*job).transform(train.where(F.col(fold) == job[1]))), jobs, chunksize=1)
            values = dict(zip(jobs, scores, strict=True))
        means = [sum(values[i, k] for k in range(folds)) / folds for i in trials]
        best = max(trials, key=lambda i: (means[i], -i))
        model = estimator.fit(train, param_maps[best])
    finally:
        train.unpersist()
    rows = [
        (i, json.dumps(_named(p), sort_keys=True), [float(values[i, k]) for k in range(folds)], float(means[i]))
        for i, p in enumerate(param_maps)
    ]
    table = spark.createDataFrame(rows, "trial int, params string, fold_scores array<double>, score double")
    return SearchResult(_named(param_maps[best]), means[best], model, table, outcomes)


def tuned_parameters(model: Model, names: list[str]) -> dict:
    """The values a fitted model was trained with, of the named parameters only."""
    return {name: model.getOrDefault(name) for name in names if model.hasParam(name)}


def draw_settings(space: dict[str, tuple], trials: int, seed: int) -> list[dict]:
    """Seeded random settings from ranges ``("int" | "float", low, high)`` and ``("choice", ...)``."""
    rng = random.Random(seed)
    drawn = []
    for _ in range(trials):
        setting = {}
        for name, (kind, *values) in space.items():
            if kind == "int":
                setting[name] = rng.randint(*values)
            elif kind == "float":
                setting[name] = rng.uniform(*values)
            elif kind == "choice":
                setting[name] = rng.choice(values)
            else:
                raise ValueError(f"unknown kind {kind} of setting {name}")
        drawn.append(setting)
    return drawn


def objective_score(train: DataFrame | None, validation: DataFrame, label: str = LABEL) -> float:
    """Recall on validation, less its distance to the training recall if ``train`` is given."""
    recall = recall_of(F.col(label), F.col("prediction")).alias("r")
    value = validation.agg(recall).first()["r"] or 0.0
    if train is None:
        return value
    return value - abs((train.agg(recall).first()["r"] or 0.0) - value)


def recalls(outcomes: list, positive=1) -> dict[tuple, float]:
    """Recall per trial and set from rows (trial, set, label, prediction, n); 0 without positive rows."""
    hits: dict[tuple, list[int]] = {}
    for trial, part, label, prediction, n in outcomes:
        own = hits.setdefault((trial, part), [0, 0])
        if label == positive:
            own[0] += n if prediction == positive else 0
            own[1] += n
    return {k: hit / all if all else 0.0 for k, (hit, all) in hits.items()}


def _objective(scores: dict[tuple, float], trial: int, penalized: bool) -> float:
    """Recall on validation, less its distance to the training recall if penalised."""
    value = scores.get((trial, "validation"), 0.0)
    return value - abs(scores.get((trial, "train"), 0.0) - value) if penalized else value


def random_search(
    train: DataFrame,
    validation: DataFrame,
    settings: list[dict],
    seed: int,
    objective: str = "recall",
    make: Callable[..., Estimator] = boosted_trees,
    label: str = LABEL,
    parallelism: int = 4,
) -> SearchResult:
    """Fit each setting on ``train``, keep the best on ``validation`` and refit it.

    ``objective`` is ``recall`` or ``penalized``, which also looks at the training recall. Of equal
    scores the earlier trial wins. Several fitted settings score the rows in one scan.
    """
    if not settings:
        raise ValueError("settings must name at least one setting")
    if objective not in OBJECTIVES:
        raise ValueError(f"objective must be {' or '.join(OBJECTIVES)}")
    spark = train.sparkSession
    if any(s.get(CLASS_WEIGHT) for s in settings):
        train, _ = with_class_weight(train, "balanced", label)
    train, validation = train.persist(), validation.persist()
    try:

        def fit(setting: dict) -> Model:
            weight = CLASS_WEIGHT if setting.get(CLASS_WEIGHT) else None
            return make(setting, seed, label=label, weight=weight).fit(train)

        penalized = objective == "penalized"
        sets = validation.select(F.lit("validation").alias("_set"), label, FEATURES)
        if penalized:
            sets = sets.unionByName(train.select(F.lit("train").alias("_set"), label, FEATURES))
        trials = list(range(len(settings)))
        counted = _score_together(
            lambda i: fit(settings[i]), trials, lambda models: candidate_outcomes(models, sets, ["_set"], label), parallelism
        )
        found = recalls([tuple(r) for r in counted])
        scores = [_objective(found, i, penalized) for i in trials]
        best = max(trials, key=lambda i: (scores[i], -i))
        model = fit(settings[best])
    finally:
        train.unpersist()
        validation.unpersist()
    rows = [(i, json.dumps(s, sort_keys=True), v) for i, (s, v) in enumerate(zip(settings, scores))]
    table = spark.createDataFrame(rows, "trial int, params string, score double")
    kind = train.schema[label].dataType.simpleString()
    outcomes = spark.createDataFrame([tuple(r) for r in counted], f"trial int, set string, label {kind}, prediction double, n long")
    return SearchResult(settings[best], scores[best], model, table, outcomes)


def refit(estimator: Estimator, params: dict, train: DataFrame) -> Model:
    """Fit a copy of the estimator with the given parameters."""
    return with_hyperparameters(estimator, params).fit(train)
