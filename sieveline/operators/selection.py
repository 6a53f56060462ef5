"""Feature selection: recursive elimination and shadow features."""

from __future__ import annotations

from math import comb
from multiprocessing.pool import ThreadPool

from pyspark.ml.classification import Classifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions.expressions import HASH_SPACE, hash_bucket
from sieveline.operators.explain import attribute_classes, fit_class_explainer, mean_abs_contribution
from sieveline.operators.features import FEATURES, LABEL, assemble
from sieveline.operators.models import random_forest

PAIRING_ROWS = 10_000
#: Trials between two decisions about the features.
DECIDE_EVERY = 10


def recursive_elimination(
    train: DataFrame,
    features: list[str],
    min_features: int,
    seed: int,
    label: str = LABEL,
    estimator: RandomForestClassifier | None = None,
    clamp: bool = True,
) -> list[str]:
    """Drop the features a forest never uses, refit, and repeat.

    Stops when every feature is used or ``min_features`` are left; does nothing if there are no more
    than that at the start. A round drops all unused features at once; with ``clamp`` it keeps the
    first of them as needed to stay at the minimum, without it the result may fall below.

    The vector is assembled and persisted once; each round slices it.
    """
    if min_features < 0:
        raise ValueError("the minimum number of features must not be negative")
    kept = list(range(len(features)))
    if len(kept) <= min_features:
        return list(features)
    forest = estimator or random_forest(seed, label)
    vectors = assemble(train.select(*features, label), list(features), "_all").select("_all", label).persist()
    try:
        while len(kept) > min_features and kept:
            sliced = VectorSlicer(inputCol="_all", outputCol=forest.getFeaturesCol(), indices=kept)
            importance = forest.fit(sliced.transform(vectors)).featureImportances.toArray()
            used = [i for i, v in zip(kept, importance) if v > 0]
            if len(used) == len(kept):
                break
            if clamp and len(used) < min_features:
                unused = [i for i in kept if i not in set(used)]
                used = sorted(used + unused[: min_features - len(used)])
            kept = used
    finally:
        vectors.unpersist()
    return [features[i] for i in kept]


def with_shadows(
    df: DataFrame, key: str, features: str, seed: int, rows: int, output: str = "shadow", pairing_rows: int = PAIRING_ROWS
) -> DataFrame:
    """Give each row the feature vector of another row, unrelated to its label.

    Rows are dealt by a hash of their key into groups of about ``pairing_rows`` and handed on by one
    place inside the group, in an order that is a hash too. This takes one shuffle however many
    features there are; permuting them one by one would take a sort each. Shadows keep the
    correlations among themselves.
    """
    groups = max(1, rows // pairing_rows)
    deal = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(groups))
    group = Window.partitionBy("_group").orderBy(F.xxhash64(F.col(key), F.lit(seed), F.lit("order")), F.col(key))
    following = F.coalesce(F.lead(features).over(group), F.first(features).over(group))
    return df.withColumn("_group", deal).withColumn(output, following).drop("_group")


def at_least(hits: int, trials: int) -> float:
    """Probability of at least ``hits`` heads in ``trials`` tosses of a fair coin."""
    return sum(comb(trials, k) for k in range(hits, trials + 1)) / 2**trials


def verdict(hits: int, trials: int, tests: int, p_value: float) -> tuple[str, float, float]:
    """Decision and the two Bonferroni-corrected probabilities behind it."""
    accept = min(1.0, at_least(hits, trials) * tests)
    reject = min(1.0, at_least(trials - hits, trials) * tests)
    decision = "accepted" if accept < p_value else "rejected" if reject < p_value else "tentative"
    return decision, accept, reject


def _trial_importance(
    vectors: DataFrame,
    active: list[int],
    key: str,
    label: str,
    rows: int,
    seed: int,
    estimator: Classifier,
    importance: str,
    held_out: float,
) -> list[float]:
    """Importance of the active features, then of their shadows, in one trial."""
    sliced = VectorSlicer(inputCol="_all", outputCol="_real", indices=active).transform(vectors)
    paired = with_shadows(sliced.select(key, label, "_real"), key, "_real", seed, rows)
    both = VectorAssembler(inputCols=["_real", "shadow"], outputCol=FEATURES).transform(paired)
    is_test = hash_bucket([key], seed) < round(held_out * HASH_SPACE)
    both = both.select(label, F.col(FEATURES).alias(estimator.getFeaturesCol()), is_test.alias("_test")).persist()
    try:
        model = estimator.copy({estimator.seed: seed}).fit(both.where(~F.col("_test")))
        if importance == "impurity":
            return list(model.featureImportances.toArray())
        test = both.where("_test").select(estimator.getFeaturesCol())
        total = [0.0] * (2 * len(active))
        # with two classes the attributions of one are those of the other with the sign turned
        classes = list(range(model.numClasses)) if model.numClasses > 2 else [model.numClasses - 1]
        explainer = fit_class_explainer(vectors.sparkSession, model, classes)
        explained = attribute_classes(test, explainer, estimator.getFeaturesCol())
        per_class = explained.select(F.explode("contributions").alias("contributions"))
        for row in mean_abs_contribution(per_class, k=None).collect():
            total[int(row["feature"])] = row["mean_abs"] * len(classes)
        return total
    finally:
        both.unpersist()


def shadow_selection(
    df: DataFrame,
    features: list[str],
    key: str,
    seed: int,
    label: str = LABEL,
    trials: int = 100,
    p_value: float = 0.1,
    estimator: Classifier | None = None,
    importance: str = "attribution",
    held_out: float = 0.3,
    parallelism: int = 4,
    decide_every: int = DECIDE_EVERY,
) -> DataFrame:
    """(feature, hits, trials, accept_p, reject_p, decision, importance) of a shadow-feature selection.

    In each trial a tree ensemble, a forest by default, is fitted on the features and their shadows; a feature scores a hit if it
    matters more than every shadow. ``attribution`` measures that by the mean absolute attribution on
    held-out rows, ``impurity`` by the impurity decrease in training. After every ``decide_every`` trials rejected
    features leave; the trials end early only if none is left. ``parallelism`` trials run at a time, which changes
    nothing about the result. ``importance`` is the mean over a feature's trials of its share in all
    importance, shadows included. ``key`` must identify a row.
    """
    if importance not in ("attribution", "impurity"):
        raise ValueError("importance must be attribution or impurity")
    if min(trials, parallelism, decide_every) < 1:
        raise ValueError("trials, parallelism and decide_every must be at least 1")
    estimator = estimator or random_forest(seed, label)
    vectors = (
        assemble(df.select(key, label, *features), list(features), "_all").select(key, label, "_all").persist()
    )
    hits = [0] * len(features)
    shares = [0.0] * len(features)
    result: dict[int, tuple[int, str, float, float]] = {}
    active = list(range(len(features)))
    try:
        rows = vectors.count()
        done = 0
        while done < trials and active:
            batch = range(done + 1, min(done + decide_every, trials) + 1)

            def run(trial: int) -> list[float]:
                return _trial_importance(
                    vectors, active, key, label, rows, seed + trial, estimator, importance, held_out
                )

            with ThreadPool(min(parallelism, len(batch))) as pool:
                for values in pool.map(run, batch, chunksize=1):
                    bar, whole = max(values[len(active) :]), sum(values)
                    for position, i in enumerate(active):
                        hits[i] += int(values[position] > bar)
                        shares[i] += values[position] / whole if whole else 0.0
            done = batch[-1]
            for i in active:
                result[i] = (done, *verdict(hits[i], done, len(features), p_value))
            active = [i for i in active if result[i][1] != "rejected"]
    finally:
        vectors.unpersist()
    table = [
        (f, hits[i], result[i][0], result[i][2], result[i][3], result[i][1], float(shares[i] / result[i][0]))
        for i, f in enumerate(features)
    ]
    return df.sparkSession.createDataFrame(
        table, "feature string, hits int, trials int, accept_p double, reject_p double, decision string, importance double"
    )


def surviving_features(selection: DataFrame, tentative: bool = True) -> list[str]:
    """Accepted features, and by default those still undecided."""
    wanted = ["accepted", "tentative"] if tentative else ["accepted"]
    return [r["feature"] for r in selection.where(F.col("decision").isin(wanted)).collect()]
