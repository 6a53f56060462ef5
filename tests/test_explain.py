"""Attributions against brute-force Shapley values on the trees' own conditional expectations."""

import subprocess
import sys
from itertools import combinations
from math import factorial
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sieveline.operators.explain import (
    _blocks,
    _grouped,
    attribute,
    attribute_classes,
    attribution_function,
    fit_class_explainer,
    fit_explainer,
    fit_explainers,
    mean_abs_contribution,
    top_contributions,
)
from sieveline.operators.features import assemble
from sieveline.sources.scratch import scratch_path

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def data(spark):
    df = spark.range(300).selectExpr(
        "id",
        "double(id % 7) a",
        "double(id % 11) b",
        "double(hash(id) % 5) c",
        "1.0D d",
        "double(((id % 7) * (id % 11) > 20) or (hash(id) % 5 > 2)) label",
    )
    return assemble(df, NAMES).cache()


def tables(spark, model):
    path = scratch_path(spark, "test-model")
    model.write().overwrite().save(path)
    trees = {}
    for row in spark.read.parquet(f"{path}/data").collect():
        trees.setdefault(row["treeID"], {})[row["nodeData"]["id"]] = row["nodeData"]
    return [trees[t] for t in sorted(trees)]


def expectation(nodes, x, known, cover, value, at=0):
    node = nodes[at]
    if node["leftChild"] < 0:
        return value(node)
    left, right = node["leftChild"], node["rightChild"]
    feature = node["split"]["featureIndex"]
    if feature in known:
        side = left if x[feature] <= node["split"]["leftCategoriesOrThreshold"][0] else right
        return expectation(nodes, x, known, cover, value, side)
    share = cover(nodes[left]) / cover(node)
    return share * expectation(nodes, x, known, cover, value, left) + (1 - share) * expectation(
        nodes, x, known, cover, value, right
    )


def shapley(f, width):
    out = np.zeros(width)
    for i in range(width):
        others = [j for j in range(width) if j != i]
        for size in range(width):
            weight = factorial(size) * factorial(width - size - 1) / factorial(width)
            for subset in combinations(others, size):
                out[i] += weight * (f(set(subset) | {i}) - f(set(subset)))
    return out


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_attributions_equal_brute_force(spark, data, kind):
    if kind == "forest":
        model = RandomForestClassifier(numTrees=3, maxDepth=4, seed=1).fit(data)
        scales = [1 / 3] * 3
        cover = lambda n: sum(n["impurityStats"])
        value = lambda n: n["impurityStats"][1] / sum(n["impurityStats"])
    else:
        model = GBTClassifier(maxIter=3, maxDepth=3, seed=1).fit(data)
        scales = model.treeWeights
        cover = lambda n: n["impurityStats"][0]
        value = lambda n: n["prediction"]
    trees = tables(spark, model)
    explained = attribute(data.where("id % 20 = 3"), fit_explainer(spark, model))
    rows = explained.select(vector_to_array("features").alias("x"), "contributions", "base_value").collect()
    assert len(rows) == 15
    for row in rows:

        def f(known):
            return sum(s * expectation(t, row["x"], known, cover, value) for s, t in zip(scales, trees))

        assert row["base_value"] == pytest.approx(f(set()))
        assert row["contributions"] == pytest.approx(shapley(f, 4).tolist(), abs=1e-9)
        assert row["contributions"][3] == 0.0


def test_attributions_add_up_to_the_output(spark, data):
    total = F.aggregate("contributions", F.col("base_value"), lambda a, c: a + c)
    forest = RandomForestClassifier(numTrees=8, maxDepth=7, seed=2).fit(data)
    scored = attribute(forest.transform(data), fit_explainer(spark, forest))
    gap = scored.select(F.max(F.abs(total - vector_to_array("probability")[1]))).first()[0]
    assert gap < 1e-9 and scored.count() == 300
    boosted = GBTClassifier(maxIter=6, seed=2).fit(data)
    scored = attribute(boosted.transform(data), fit_explainer(spark, boosted))
    assert scored.select(F.max(F.abs(total - vector_to_array("rawPrediction")[1]))).first()[0] < 1e-9


def test_a_tree_without_splits(spark, data):
    model = RandomForestClassifier(numTrees=2, maxDepth=0, seed=1).fit(data)
    explained = attribute(data.limit(2), fit_explainer(spark, model)).collect()
    assert all(r["contributions"] == [0.0] * 4 for r in explained)


def test_workers_need_not_have_the_package(spark, data, tmp_path):
    model = RandomForestClassifier(numTrees=2, maxDepth=2, seed=1).fit(data)
    explainer = fit_explainer(spark, model)
    shared = SimpleNamespace(value=(_grouped(explainer.leaves), explainer.width))
    (tmp_path / "f.pickle").write_bytes(cloudpickle.dumps(attribution_function(shared)))
    code = (
        "import pickle, pyarrow as pa, sys; f = pickle.load(open('f.pickle', 'rb'));"
        "print(len(f(pa.array([[1.0, 2.0, 3.0, 1.0]]))), 'sieveline' in sys.modules)"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.stdout.split() == ["1", "False"], done.stderr


def test_only_the_feature_column_goes_to_python(spark, data, plan_of):
    model = RandomForestClassifier(numTrees=2, maxDepth=2, seed=1).fit(data)
    text = plan_of(attribute(data, fit_explainer(spark, model)))
    assert "ArrowEvalPython" in text and "Exchange" not in text


def test_all_classes_from_one_saved_model(spark, data):
    model = RandomForestClassifier(numTrees=3, maxDepth=3, seed=1).fit(data)
    together = fit_explainers(spark, model, [0, 1])
    for k, explainer in enumerate(together):
        alone = fit_explainer(spark, model, k)
        assert explainer.base == pytest.approx(alone.base) and len(explainer.leaves) == len(alone.leaves)
    rows = [attribute(data, e).select("contributions").collect() for e in together]
    for a, b in zip(*rows, strict=True):
        assert a[0] == pytest.approx([-x for x in b[0]])


def test_other_models_are_refused(spark, data):
    with pytest.raises(TypeError):
        fit_explainer(spark, LogisticRegression(maxIter=1).fit(data))


def test_top_contributions(spark):
    df = spark.createDataFrame([(1, [0.1, -0.5, 0.3, 0.2]), (2, [1.0, 0.0, 0.0, -2.0])], "id int, contributions array<double>")
    rows = top_contributions(df, k=3, names=list("wxyz")).orderBy("id", "position").collect()
    assert [(r["id"], r["position"], r["feature"]) for r in rows] == [
        (1, 1, "x"),
        (1, 2, "y"),
        (1, 3, "others"),
        (2, 1, "z"),
        (2, 2, "w"),
        (2, 3, "others"),
    ]
    assert [r["contribution"] for r in rows] == pytest.approx([-0.5, 0.3, 0.3, -2.0, 1.0, 0.0])
    assert top_contributions(df, k=9).count() == 8
    with pytest.raises(ValueError):
        top_contributions(df, k=1)


def test_top_contributions_shuffle_nothing(spark, plan_of):
    df = spark.createDataFrame([(1, [0.1])], "id int, contributions array<double>")
    text = plan_of(top_contributions(df))
    assert "Exchange" not in text and "Window" not in text


def test_mean_abs_contribution(spark):
    df = spark.createDataFrame([([0.5, -1.0, 0.0],), ([0.5, 1.0, 0.25],)], "contributions array<double>")
    rows = mean_abs_contribution(df, k=2, names=list("abc")).collect()
    assert [tuple(r) for r in rows] == [("b", 1.0), ("a", 0.5)]
    assert mean_abs_contribution(df, k=None).count() == 3


@pytest.fixture(scope="module")
def three_classes(spark, data):
    model = RandomForestClassifier(numTrees=7, maxDepth=4, seed=5).fit(data.withColumn("label", F.pmod(F.col("a") + F.col("c"), F.lit(3.0))))
    assert model.numClasses == 3
    return model


@pytest.mark.parametrize("block_bytes", [32 << 20, 300])
def test_attributions_of_all_classes_add_up_and_equal_those_of_each(spark, data, three_classes, plan_of, block_bytes):
    whole = fit_class_explainer(spark, three_classes)
    assert len(_blocks(_grouped(whole.leaves), block_bytes)) > (1 if block_bytes < 1000 else 0)
    df = attribute_classes(three_classes.transform(data), whole, block_bytes=block_bytes)
    assert plan_of(df.select("contributions")).count("ArrowEvalPython") <= 1
    rows = {r["id"]: r for r in df.select("id", "contributions", "base_values", vector_to_array("probability").alias("p")).collect()}
    assert sum(whole.bases) == pytest.approx(1.0)
    for r in rows.values():
        found = np.array(r["contributions"])
        assert found.shape == (3, 4)
        assert found.sum(axis=1) + np.array(r["base_values"]) == pytest.approx(np.array(r["p"]))
        assert found.sum(axis=0) == pytest.approx(np.zeros(4), abs=1e-9)
    for c, explainer in enumerate(fit_explainers(spark, three_classes, [0, 1, 2])):
        for r in attribute(data, explainer).select("id", "contributions", "base_value").collect():
            assert rows[r["id"]]["contributions"][c] == pytest.approx(r["contributions"], abs=1e-12)
            assert rows[r["id"]]["base_values"][c] == pytest.approx(r["base_value"])


def test_blocks_hold_every_leaf_within_their_bytes(spark, three_classes):
    groups = _grouped(fit_class_explainer(spark, three_classes).leaves)
    for size in (1, 300, 5_000, 1 << 20):
        blocks = _blocks(groups, size)
        assert sum(len(part[0]) for block in blocks for part in block) == sum(len(g[0]) for g in groups)
        for block in blocks:
            held = sum(a.nbytes for part in block for a in part)
            assert held <= size or (len(block) == 1 and len(block[0][0]) == 1)


def test_all_classes_of_no_rows(spark, data, three_classes):
    assert attribute_classes(data.limit(0), fit_class_explainer(spark, three_classes)).count() == 0


def test_boosted_trees_have_one_class(spark, data):
    model = GBTClassifier(maxIter=3, maxDepth=3, seed=2).fit(data)
    one = {r["id"]: r["contributions"] for r in attribute(data, fit_explainer(spark, model)).select("id", "contributions").collect()}
    for r in attribute_classes(data, fit_class_explainer(spark, model)).select("id", "contributions").collect():
        assert len(r["contributions"]) == 1 and r["contributions"][0] == pytest.approx(one[r["id"]], abs=1e-12)
