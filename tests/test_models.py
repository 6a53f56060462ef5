"""Features, models, selection, search, stored artifacts and the training job."""

import json

import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import functions as F

from sieveline.operators import features, models, search, selection, staged
from sieveline.operators.split import assign_folds, hash_split
from sieveline.plans import training
from sieveline.plans.boosting import train_boosted
from sieveline.plans.evaluation import evaluate_sets
from sieveline.sources import artifacts, manifests
from sieveline.sources.scratch import remove, scratch_path, written

SIGNAL = ["a", "b"]
ALL = ["constant", "a", "noise", "b"]


@pytest.fixture(scope="module")
def data(spark):
    """a and b decide the label; noise does not; one column is constant."""
    return (
        spark.range(600)
        .selectExpr(
            "id",
            "double(pmod(hash(id, 1), 100)) a",
            "double(pmod(hash(id, 2), 100)) b",
            "double(pmod(hash(id, 3), 100)) noise",
            "3.0D constant",
        )
        .withColumn("target", F.when(F.col("a") + F.col("b") > 100, "yes").otherwise("no"))
        .withColumn("label", (F.col("target") == "yes").cast("double"))
        .repartition(4, "id")
        .cache()
    )


# --- features ---------------------------------------------------------------------------------


def test_label_index_orders_by_frequency_then_text(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "y string")
    index = features.fit_label_index(df, "y")
    rows = features.label_table(spark, index).collect()
    assert [tuple(r) for r in rows] == [("c", 0.0), ("a", 1.0), ("b", 2.0)]


def test_unseen_label(spark):
    known = spark.createDataFrame([("a",), ("a",), ("b",)], "y string")
    new = spark.createDataFrame([("a",), ("z",)], "y string")
    with pytest.raises(Exception, match="Unseen label"):
        features.encode_label(new, features.fit_label_index(known, "y")).collect()
    kept = features.encode_label(new, features.fit_label_index(known, "y", handle_invalid="keep"))
    assert {r["y"]: r["label"] for r in kept.collect()} == {"a": 0.0, "z": 2.0}
    assert features.encode_label(new, features.fit_label_index(known, "y", handle_invalid="skip")).count() == 1


def test_prepare_data(data):
    index = features.fit_label_index(data.drop("label"), "target")
    split = hash_split(data.drop("label"), "id")
    sets = [split.where(F.col("split") == s) for s in ("train", "test")]
    train, test = features.prepare_data(*sets, ALL, "target", index)
    assert train.columns == test.columns == [*ALL, "target", "label", "features"]
    assert train.count() + test.count() == 600


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0.0,)] * 6 + [(1.0,)] * 2 + [(None,)], "label double")
    rows = features.balanced_weights(df).collect()
    assert {r["label"]: r["class_weight"] for r in rows} == {0.0: 8 / 12, 1.0: 2.0, None: None}
    assert len(rows) == 9


# --- models -----------------------------------------------------------------------------------


def test_forest_scores_every_row(data):
    ready = features.assemble(data, SIGNAL)
    model = models.random_forest(1, numTrees=5).fit(ready)
    scored = models.class_probability(models.score(model, ready))
    row = scored.agg(F.count("*"), F.min("score"), F.max("score"), F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()
    assert row[0] == 600 and row[1] >= 0 and row[2] <= 1 and row[3] > 0.9
    table = features.importance_table(data.sparkSession, model, SIGNAL).collect()
    assert sum(r["importance"] for r in table) == pytest.approx(1.0)
    with pytest.raises(ValueError):
        features.importance_table(data.sparkSession, model, ALL)


def test_top_scored_takes_the_lowest_id_of_a_tie(spark):
    df = spark.createDataFrame([(5, 0.9), (3, 0.9), (1, 0.2)], "id int, score double")
    assert models.top_scored(df).first()["id"] == 3


def test_boosted_settings():
    settings = {"n_estimators": 7, "learning_rate": 0.2, "feature_fraction": 0.5, "num_leaves": 31, "max_depth": 99}
    params = models.spark_parameters(settings | {"min_gain_to_split": 2, "class_weight": "balanced", "max_bin": 63})
    assert params == {
        "maxIter": 7,
        "stepSize": 0.2,
        "featureSubsetStrategy": "0.5",
        "maxDepth": 30,
        "minInfoGain": 2.0,
        "maxBins": 63,
    }
    assert models.spark_parameters({"feature_fraction": 1.0}) == {"featureSubsetStrategy": "all"}
    with pytest.raises(ValueError):
        models.spark_parameters({"depth": 3})


def test_boosted_trees_with_balanced_weights(data):
    ready = features.assemble(data, SIGNAL)
    train, weight = models.with_class_weight(ready, "balanced")
    model = models.boosted_trees({"n_estimators": 4, "max_depth": 3}, 1, weight=weight).fit(train)
    assert model.getOrDefault("weightCol") == "class_weight" and model.getNumTrees == 4
    assert models.with_class_weight(ready, None) == (ready, None)
    with pytest.raises(ValueError):
        models.with_class_weight(ready, "heavy")


# --- selection --------------------------------------------------------------------------------


def test_elimination_drops_the_constant_and_keeps_the_signal(data):
    kept = selection.recursive_elimination(data, ALL, 2, seed=1)
    assert "constant" not in kept and set(SIGNAL) <= set(kept)


def test_elimination_respects_the_minimum(spark, data):
    flat = data.selectExpr("label", *[f"double({i}) c{i}" for i in range(5)])
    names = [f"c{i}" for i in range(5)]
    assert selection.recursive_elimination(flat, names, 3, seed=1) == ["c0", "c1", "c2"]
    assert selection.recursive_elimination(flat, names, 3, seed=1, clamp=False) == []
    assert selection.recursive_elimination(flat, names, 5, seed=1) == names
    with pytest.raises(ValueError):
        selection.recursive_elimination(flat, names, -1, seed=1)


def test_shadows_are_a_permutation_of_the_rows(spark, data):
    df = features.assemble(data, ["a", "b"]).select("id", "features")
    paired = selection.with_shadows(df, "id", "features", 5, 600, pairing_rows=50).collect()
    assert len(paired) == 600
    assert sorted(map(str, (r["features"] for r in paired))) == sorted(map(str, (r["shadow"] for r in paired)))
    assert sum(r["features"] != r["shadow"] for r in paired) > 550


def test_verdict():
    assert selection.at_least(8, 8) == 1 / 256
    assert selection.at_least(0, 5) == 1.0
    assert selection.verdict(8, 8, 1, 0.1)[0] == "accepted"
    assert selection.verdict(0, 8, 1, 0.1)[0] == "rejected"
    assert selection.verdict(4, 8, 1, 0.1)[0] == "tentative"
    # the correction multiplies by the number of tests
    assert selection.verdict(8, 8, 30, 0.1)[0] == "tentative"


def test_shadow_selection_does_not_depend_on_the_pool(spark, data):
    forest = models.random_forest(3, numTrees=4, maxDepth=3)
    found = [
        selection.shadow_selection(
            data, ALL, "id", 3, trials=8, estimator=forest, importance="impurity", parallelism=pool, decide_every=4
        ).collect()
        for pool in (1, 3, 4)
    ]
    assert found[0] == found[1] == found[2]
    assert all(0 <= r["importance"] <= 1 for r in found[0])


@pytest.mark.parametrize("importance", ["attribution", "impurity"])
def test_shadow_selection_finds_the_signal(spark, data, importance):
    forest = models.random_forest(1, numTrees=8, maxDepth=4)
    table = selection.shadow_selection(
        data, ALL, "id", seed=3, trials=7, p_value=0.1, estimator=forest, importance=importance
    )
    found = {r["feature"]: r["decision"] for r in table.collect()}
    assert found["a"] == found["b"] == "accepted" and found["constant"] == "rejected"
    assert set(SIGNAL) <= set(selection.surviving_features(table))
    assert "constant" not in selection.surviving_features(table)
    with pytest.raises(ValueError):
        selection.shadow_selection(data, ALL, "id", 1, importance="luck")


# --- search -----------------------------------------------------------------------------------


def test_ranges_round_half_to_even():
    assert search.range_values({"start": 3, "stop": 50}) == [3, 15, 26, 38, 50]
    assert search.range_values({}) == [1, 3, 6, 8, 10]
    assert search.range_values({"start": 4, "num": 1}) == [4]
    with pytest.raises(ValueError):
        search.range_values({"step": 2})
    with pytest.raises(ValueError):
        search.range_values({"num": 0})


def test_an_empty_range_has_no_values(spark):
    ranges = spark.createDataFrame([("x", 1, 5, 0)], "p string, start int, stop int, num int")
    assert search.search_space(ranges, ["p"]).count() == 0


def test_search_space_table_agrees(spark):
    ranges = spark.createDataFrame([("x", 3, 50, 5), ("y", 7, 9, 1), ("z", -5, 4, 4)], "p string, start int, stop int, num int")
    rows = search.search_space(ranges, ["p"]).orderBy("p", "step").collect()
    found = {}
    for r in rows:
        found.setdefault(r["p"], []).append(r["value"])
    for r in ranges.collect():
        assert found[r["p"]] == search.range_values({"start": r["start"], "stop": r["stop"], "num": r["num"]})


def test_parameter_maps():
    forest = models.random_forest(1)
    maps = search.parameter_maps(forest, training.SEARCH_RANGES)
    assert len(maps) == 20
    assert {p.name for p in maps[0]} == {"numTrees", "maxDepth", "maxBins"}
    with pytest.raises(ValueError, match="numLeaves"):
        search.parameter_maps(forest, {"numLeaves": {}})


def test_grid_search(data):
    ready = assign_folds(features.assemble(data, SIGNAL), "id", 2, seed=1)
    forest = models.random_forest(1)
    maps = search.parameter_maps(forest, {"maxDepth": {"start": 1, "stop": 6, "num": 2}, "numTrees": {"start": 4, "num": 1}})
    found = search.grid_search(forest, maps, ready, folds=2)
    assert found.best_params == {"maxDepth": 6, "numTrees": 4}
    trials = found.trials.collect()
    assert len(trials) == 2 and found.best_score == max(r["score"] for r in trials)
    assert all(r["score"] == pytest.approx(sum(r["fold_scores"]) / 2) for r in trials)
    assert search.tuned_parameters(found.best_model, ["maxDepth", "numTrees"]) == found.best_params


def test_candidates_scored_together_equal_a_scan_each(data, monkeypatch):
    monkeypatch.setattr(search, "SCORED_TOGETHER", 2)
    ready = assign_folds(features.assemble(data, SIGNAL), "id", 2, seed=1)
    forest = models.random_forest(1)
    maps = search.parameter_maps(forest, {"maxDepth": {"start": 0, "stop": 4, "num": 3}, "numTrees": {"start": 3, "num": 1}})
    together = search.grid_search(forest, maps, ready, folds=2)
    apart = search.grid_search(forest, maps, ready, folds=2, metric=search.weighted_f1)
    scores = [{r["trial"]: r["fold_scores"] for r in found.trials.collect()} for found in (together, apart)]
    assert scores[0].keys() == scores[1].keys()
    for trial in scores[0]:
        assert scores[0][trial] == pytest.approx(scores[1][trial])
    assert together.best_params == apart.best_params and apart.outcomes is None
    sizes = {r["fold"]: r["count"] for r in ready.groupBy("fold").count().collect()}
    counted = together.outcomes.groupBy("trial", "fold").agg(F.sum("n").alias("n")).collect()
    assert len(counted) == 6 and all(r["n"] == sizes[r["fold"]] for r in counted)
    with pytest.raises(ValueError):
        search.grid_search(forest, [], ready, folds=2)


def test_models_of_a_fold_take_one_scan(data, plan_of):
    ready = written(features.assemble(data, SIGNAL).select("label", "features"), "ready")
    fitted = {t: models.random_forest(t, numTrees=2).fit(ready) for t in range(4)}
    plan = plan_of(search.candidate_outcomes(fitted, ready, []))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_staged_margins_are_those_of_shorter_models(data):
    ready = hash_split(features.assemble(data, SIGNAL), "id")
    train, test = (ready.where(F.col("split") == s) for s in ("train", "test"))
    settings = {"n_estimators": 6, "max_depth": 3, "learning_rate": 0.2}
    model = models.boosted_trees(settings, 1).fit(train)
    found = {r["id"]: r["margins"] for r in staged.staged_margins(test, model, [0, 1, 3, 6, 9]).collect()}
    for place, n in ((1, 1), (2, 3), (3, 6)):
        shorter = models.boosted_trees(settings | {"n_estimators": n}, 1).fit(train).transform(test)
        for r in shorter.collect():
            assert found[r["id"]][place] == pytest.approx(r["rawPrediction"][1], abs=1e-9)
    assert all(m[0] == 0.0 and m[4] == m[3] for m in found.values())
    counts = staged.staged_outcomes(test, model, [3, 6], ["split"]).collect()
    want = {}
    for n in (3, 6):
        shorter = models.boosted_trees(settings | {"n_estimators": n}, 1).fit(train).transform(test)
        for r in shorter.collect():
            k = (n, "test", r["label"], r["prediction"])
            want[k] = want.get(k, 0) + 1
    assert {tuple(r)[:4]: r["n"] for r in counts} == want
    assert staged.staged_margins(test.limit(0), model, [1]).collect() == []
    with pytest.raises(ValueError):
        staged.staged_margins(test, model, [-1])


@pytest.mark.parametrize("objective", ["recall", "penalized"])
def test_staged_search_equals_a_fit_per_length(data, objective):
    ready = hash_split(features.assemble(data, SIGNAL), "id")
    train, validation = (ready.where(F.col("split") == s) for s in ("train", "test"))
    settings = [{"max_depth": 1, "class_weight": "balanced", "n_estimators": 4}, {"max_depth": 3}]
    found = staged.staged_search(train, validation, settings, 1, [1, 2, 4, 5], objective)
    each = [s | {"n_estimators": n} for s, stages in zip(settings, ([1, 2, 4], [1, 2, 4, 5])) for n in stages]
    fits = search.random_search(train, validation, each, 1, objective)
    scores = [[r["score"] for r in f.trials.orderBy("trial").collect()] for f in (found, fits)]
    assert scores[0] == pytest.approx(scores[1])
    assert found.best_params == fits.best_params and found.best_score == pytest.approx(fits.best_score)
    with pytest.raises(ValueError):
        staged.staged_search(train, validation, [], 1, [1])
    with pytest.raises(ValueError):
        staged.staged_search(train, validation, settings, 1, [1], "luck")


def test_draws_are_seeded_and_in_range():
    drawn = search.draw_settings(search.BOOSTED_SPACE, 50, 3)
    assert drawn == search.draw_settings(search.BOOSTED_SPACE, 50, 3) != search.draw_settings(search.BOOSTED_SPACE, 50, 4)
    for s in drawn:
        assert 3 <= s["n_estimators"] <= 500 and 0.001 <= s["learning_rate"] <= 0.3
    assert {s["class_weight"] for s in drawn} == {None, "balanced"}
    with pytest.raises(ValueError):
        search.draw_settings({"x": ("log", 1, 2)}, 1, 1)


@pytest.mark.parametrize("objective", ["recall", "penalized"])
def test_random_search(data, objective):
    ready = hash_split(features.assemble(data, SIGNAL), "id")
    train, validation = (ready.where(F.col("split") == s) for s in ("train", "test"))
    settings = [{"n_estimators": 2, "max_depth": 1, "class_weight": "balanced"}, {"n_estimators": 6, "max_depth": 4}]
    found = search.random_search(train, validation, settings, 1, objective)
    scores = [r["score"] for r in found.trials.orderBy("trial").collect()]
    assert found.best_score == max(scores) and found.best_params == settings[scores.index(max(scores))]
    seen = found.best_model.transform(train) if objective == "penalized" else None
    assert search.objective_score(seen, found.best_model.transform(validation)) == pytest.approx(found.best_score)
    with pytest.raises(ValueError):
        search.random_search(train, validation, settings, 1, "luck")


# --- artifacts --------------------------------------------------------------------------------


def test_feature_list_keeps_its_order_and_replaces_the_old(spark):
    path = scratch_path(spark, "features")
    assert not artifacts.stored(spark, path)
    artifacts.store_features(spark, ["z", "a", "m"], path)
    assert artifacts.stored(spark, path) and artifacts.load_features(spark, path) == ["z", "a", "m"]
    artifacts.store_features(spark, ["q"], path)
    assert artifacts.load_features(spark, path) == ["q"]


def test_hyperparameters_keep_their_types(spark):
    path = scratch_path(spark, "hp")
    params = {"numTrees": 7, "subsamplingRate": 0.5, "featureSubsetStrategy": "all", "bootstrap": True}
    artifacts.store_hyperparameters(spark, params, path)
    assert artifacts.load_hyperparameters(spark, path) == params
    forest = artifacts.with_hyperparameters(models.random_forest(1), params)
    assert {name: forest.getOrDefault(name) for name in params} == params
    with pytest.raises(ValueError):
        artifacts.with_hyperparameters(forest, {"unknown": 1})


# --- jobs -------------------------------------------------------------------------------------


def raw(data):
    text = lambda c, n: F.when(F.col("id") % n == 0, "?").otherwise(F.col(c).cast("int").cast("string")).alias(c)
    sparse = F.when(F.col("id") % 4 == 0, "1").otherwise("?").alias("sparse")
    return data.select("id", text("a", 9), "b", text("noise", 13), "constant", sparse, "target")


def test_training_job_resumes(spark, data):
    work = scratch_path(spark, "job")
    arguments = dict(key="id", ignore=("id",), min_features=2, ranges={"maxDepth": {"start": 2, "stop": 5, "num": 2}})
    first = training.train_classifier(raw(data), work, **arguments)
    assert "sparse" not in first.features and "constant" not in first.features
    assert set(SIGNAL) <= set(first.features)
    assert first.metrics.first()["accuracy"] > 0.8
    wide = first.confusion.collect()
    total = sum(r[c] for r in wide for c in first.confusion.columns if c != "label")
    assert total == first.scored.count()
    model = artifacts.load_model(RandomForestClassificationModel, artifacts.artifact_path(work, artifacts.MODEL))
    assert model.numFeatures == len(first.features)

    artifacts.store_features(spark, ["b", "a"], artifacts.artifact_path(work, artifacts.FEATURES))
    artifacts.store_hyperparameters(spark, {"maxDepth": 3}, artifacts.artifact_path(work, artifacts.HYPERPARAMETERS))
    again = training.train_classifier(raw(data), work, **arguments)
    assert again.features == ["b", "a"] and again.hyperparameters == {"maxDepth": 3}
    assert again.model.getOrDefault("maxDepth") == 3


def states(result):
    return {r["stage"]: r["state"] for r in result.stages.collect()}


def test_training_job_rebuilds_what_is_stale(spark, data):
    work = scratch_path(spark, "job")
    arguments = {"ignore": ("id",), "min_features": 3, "ranges": {"numTrees": {"start": 3, "num": 1}}}
    every = ["cleaned", "selected_features", "hyperparameters", "final_model"]
    first = training.train_classifier(raw(data), work, **arguments)
    assert states(first) == dict.fromkeys(every, "built")
    # the same rows in another order and other partitions are the same input
    files = lambda kind: sorted(r[0] for r in spark.read.format("binaryFile").load(f"{work}/{kind}").select("modificationTime").collect())
    written = files("cleaned")
    again = training.train_classifier(raw(data).repartition(3), work, **arguments)
    assert states(again) == dict.fromkeys(every, "reused") and files("cleaned") == written
    assert again.scored.select("prediction").collect() == first.scored.select("prediction").collect()
    # other arguments of one stage leave those before it
    fewer = training.train_classifier(raw(data), work, **(arguments | {"ranges": {"numTrees": {"start": 4, "num": 1}}}))
    assert states(fewer) == {"cleaned": "reused", "selected_features": "reused", "hyperparameters": "rebuilt", "final_model": "rebuilt"}
    assert fewer.hyperparameters == {"numTrees": 4}
    # other rows make all stages stale
    less = raw(data).where("id % 10 != 0")
    with pytest.raises(ValueError, match="cleaned.*other data"):
        training.train_classifier(less, work, **arguments, stale="refuse")
    kept = training.train_classifier(less, work, **(arguments | {"ranges": {"numTrees": {"start": 9, "num": 1}}}), stale="keep")
    assert states(kept) == {"cleaned": "rebuilt", "selected_features": "kept", "hyperparameters": "kept", "final_model": "rebuilt"}
    assert kept.hyperparameters == {"numTrees": 4} and kept.features == fewer.features
    # a manifest is missing where a run was stopped before the end of its stage
    remove(spark, f"{work}/{manifests.MANIFESTS}/selected_features")
    stopped = training.train_classifier(less, work, **arguments)
    assert states(stopped) == {"cleaned": "reused", "selected_features": "built", "hyperparameters": "rebuilt", "final_model": "rebuilt"}
    with pytest.raises(ValueError):
        training.train_classifier(less, work, **arguments, stale="perhaps")


def test_fingerprint_of_rows(spark):
    print_of = manifests.data_fingerprint
    rows = [(1, "a", None), (2, None, 0.5), (2, None, 0.5)]
    df = spark.createDataFrame(rows, "x int, y string, z double")
    assert print_of(df) == print_of(spark.createDataFrame(rows[::-1], df.schema).repartition(4))
    others = [rows[:2], [*rows, rows[0]], [(1, None, None), *rows[1:]], [(1, "a", 0.5), (2, None, None), (2, None, 0.5)]]
    assert len({print_of(df), *(print_of(spark.createDataFrame(o, df.schema)) for o in others)}) == 5
    assert print_of(df) != print_of(df.withColumnRenamed("x", "w")) != print_of(df.withColumn("x", F.col("x").cast("long")))
    assert print_of(df.limit(0)) != print_of(df)


def test_training_on_all_features_with_train_medians(spark, data):
    result = training.train_classifier(
        raw(data),
        scratch_path(spark, "job"),
        ignore=("id",),
        ranges={"numTrees": {"start": 3, "num": 1}},
        fit_on="train",
        select=False,
    )
    assert set(result.features) == set(ALL)
    with pytest.raises(ValueError):
        training.train_classifier(raw(data), " ")
    with pytest.raises(ValueError):
        training.clean_table(raw(data), "target", fit_on="test")


def test_boosted_study(spark, data):
    space = {
        "n_estimators": ("int", 3, 6),
        "max_depth": ("int", 3, 5),
        "learning_rate": ("float", 0.1, 0.3),
        "class_weight": ("choice", None, "balanced"),
    }
    result = train_boosted(
        data.drop("label"),
        "target",
        "id",
        ALL,
        negative_value="no",
        space=space,
        first_trials=2,
        second_trials=2,
        shadow_trials=4,
        objective="penalized",
    )
    assert set(SIGNAL) <= set(result.features) and result.model.numFeatures == len(result.features)
    auc = {r["split"]: r["auc"] for r in result.evaluation.auc.collect()}
    assert set(auc) == {"train", "val", "test"} and min(auc.values()) > 0.8
    sizes = {r["split"]: r["count"] for r in result.scored.groupBy("split").count().collect()}
    assert sum(sizes.values()) == 600
    assert result.attributions.where(F.size("contributions") == len(result.features)).count() == sizes["test"]
    assert result.search.trials.count() == 2 and result.selection.count() == 4


def test_evaluation_of_all_sets(spark):
    rows = [(i, i % 2, float(i % 2) if i % 5 else 0.5, ("train", "val", "test")[i % 3]) for i in range(90)]
    df = spark.createDataFrame(rows, "id int, label int, score double, split string")
    found = evaluate_sets(df.withColumn("prediction", (F.col("score") > 0.6).cast("int")), bins=5)
    assert {r["split"] for r in found.auc.collect()} == {"train", "val", "test"}
    assert all(r["auc"] > 0.9 for r in found.auc.collect())
    assert found.lift_gain.count() == 18 and found.recall.count() == 3
    assert found.lift.count() == found.gain.count() == 15
    assert found.roc.count() == 12
    assert json.loads(found.recall.toJSON().first())["recall"] > 0
