"""Per-row attributions of tree ensembles, and the rankings drawn from them.

Path-dependent tree attributions (Lundberg et al., 2018) are a sum over leaves. A leaf with value v
whose path tests the features 1..d contributes to feature i

    v * (o_i - z_i) * integral over [0, 1] of prod_{j != i} (z_j (1 - x) + o_j x) dx

where o_j says whether the row passes the tests on j and z_j is the share of training weight that
did. The integrand is a polynomial of degree d - 1, so Gauss-Legendre quadrature gives it exactly.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.operators.features import FEATURES
from sieveline.sources.artifacts import store_model
from sieveline.sources.scratch import remove, scratch_path

OTHERS = "others"
#: Bytes of leaves in one broadcast: a large ensemble is sent in several.
BLOCK_BYTES = 32 << 20


class Leaf(NamedTuple):
    """What is left of a path: per feature the interval it allows and the share of weight passing."""

    value: float
    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray


class Explainer(NamedTuple):
    """The leaves of an ensemble and the output it gives before any feature is known."""

    leaves: list[Leaf]
    base: float
    width: int


class ClassExplainer(NamedTuple):
    """The leaves of an ensemble with a value per class, and per class the output before any feature is known."""

    leaves: list[Leaf]
    bases: list[float]
    width: int


def _leaf_value(model, node, class_index: int) -> float:
    if isinstance(model, GBTClassificationModel):
        return node["prediction"]
    return node["impurityStats"][class_index] / sum(node["impurityStats"])


def _cover(model, node) -> float:
    stats = node["impurityStats"]
    return stats[0] if isinstance(model, GBTClassificationModel) else sum(stats)


def _paths(nodes: dict, root: int = 0):
    """(leaf, [(parent, child, goes left)]) for every leaf below the root."""
    open_nodes = [(root, [])]
    while open_nodes:
        at, path = open_nodes.pop()
        node = nodes[at]
        if node["leftChild"] < 0:
            yield node, path
            continue
        if node["split"]["numCategories"] != -1:
            raise ValueError("attributions need numeric features; the model splits on categories")
        open_nodes.append((node["leftChild"], path + [(node, nodes[node["leftChild"]], True)]))
        open_nodes.append((node["rightChild"], path + [(node, nodes[node["rightChild"]], False)]))


def fit_explainer(spark: SparkSession, model, class_index: int = 1) -> Explainer:
    """The explainer of one class; see :func:`fit_explainers`."""
    return fit_explainers(spark, model, [class_index])[0]


def fit_explainers(spark: SparkSession, model, classes: list[int]) -> list[Explainer]:
    """An explainer per class, from one reading of the model; see :func:`fit_class_explainer` for all classes in one pass."""
    whole = fit_class_explainer(spark, model, classes)
    return [
        Explainer([leaf._replace(value=leaf.value[k]) for leaf in whole.leaves], whole.bases[k], whole.width) for k in range(len(classes))
    ]


def fit_class_explainer(spark: SparkSession, model, classes: list[int] | None = None) -> ClassExplainer:
    """Read the node table of a saved ensemble, once for any number of classes, by default all.

    A forest is explained on the probability of each class, boosted trees on the margin of the
    positive class. Only the model, never the data, comes to the driver.
    """
    if not isinstance(model, (GBTClassificationModel, RandomForestClassificationModel)):
        raise TypeError(f"cannot explain a {type(model).__name__}")
    boosted = isinstance(model, GBTClassificationModel)
    if classes is None:
        classes = [1] if boosted else list(range(model.numClasses))
    path = scratch_path(spark, "model")
    store_model(model, path)
    trees: dict[int, dict] = {}
    for row in spark.read.parquet(f"{path}/data").select("treeID", "nodeData").collect():
        trees.setdefault(row["treeID"], {})[row["nodeData"]["id"]] = row["nodeData"]
    remove(spark, path)
    leaves: list[Leaf] = []
    bases = np.zeros(len(classes))
    for tree, nodes in sorted(trees.items()):
        scale = model.treeWeights[tree] if boosted else 1.0 / len(trees)
        for leaf, path_taken in _paths(nodes):
            tests: dict[int, list[float]] = {}
            for parent, child, left in path_taken:
                threshold = parent["split"]["leftCategoriesOrThreshold"][0]
                test = tests.setdefault(parent["split"]["featureIndex"], [-np.inf, np.inf, 1.0])
                if left:
                    test[1] = min(test[1], threshold)
                else:
                    test[0] = max(test[0], threshold)
                test[2] *= _cover(model, child) / _cover(model, parent)
            columns = np.array(list(tests.values()), dtype=np.float64).reshape(-1, 3)
            values = np.array([scale * _leaf_value(model, leaf, c) for c in classes])
            bases += values * columns[:, 2].prod()
            if tests:
                leaves.append(Leaf(values, np.array(list(tests)), columns[:, 0], columns[:, 1], columns[:, 2]))
    return ClassExplainer(leaves, [float(b) for b in bases], model.numFeatures)


def _grouped(leaves: list[Leaf]) -> list[tuple]:
    """Leaves with paths over equally many features, stacked: (values, features, low, high, share)."""
    by_length: dict[int, list[Leaf]] = {}
    for leaf in leaves:
        by_length.setdefault(len(leaf.features), []).append(leaf)
    return [
        (np.array([x.value for x in group]), *(np.stack([getattr(x, c) for x in group]) for c in ("features", "low", "high", "share")))
        for _, group in sorted(by_length.items())
    ]


def _blocks(groups: list[tuple], block_bytes: int) -> list[list[tuple]]:
    """Groups of leaves cut into parts of bounded size."""
    blocks: list[list[tuple]] = [[]]
    held = 0
    for group in groups:
        per_leaf = max(1, sum(a[0].nbytes if a.ndim > 1 else a.itemsize for a in group))
        step = max(1, block_bytes // per_leaf)
        for k in range(0, len(group[0]), step):
            part = tuple(a[k : k + step] for a in group)
            size = per_leaf * len(part[0])
            if held and held + size > block_bytes:
                blocks.append([])
                held = 0
            blocks[-1].append(part)
            held += size
    return blocks


def class_attribution_function(shared, classes: int, width: int):
    """Like :func:`attribution_function`, for several classes: the rows pass the leaves once, whatever the number of classes.

    ``shared`` are the blocks of leaves. A cell of the result holds the features of one class after those of another.
    """
    cells = 1 << 20

    def contributions(column: pa.Array) -> pa.Array:
        rows = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)
        out = np.zeros((classes, *rows.shape))
        for block in shared:
            for values, features, low, high, share in block.value:
                depth = features.shape[1]
                nodes, weights = np.polynomial.legendre.leggauss(depth // 2 + 1)
                step = max(1, cells // max(1, depth * len(rows)))
                for k in range(0, len(values), step):
                    part = slice(k, k + step)
                    x = rows[:, features[part]]
                    passed = ((x > low[part]) & (x <= high[part])).astype(np.float64)
                    integral = np.zeros_like(passed)
                    for at, weight in zip((nodes + 1) / 2, weights / 2):
                        terms = share[part] * (1 - at) + passed * at
                        integral += weight * terms.prod(axis=2, keepdims=True) / terms
                    gained = ((passed - share[part]) * integral).reshape(len(rows), -1)
                    names, place = np.unique(features[part], return_inverse=True)
                    for c in range(classes):
                        indicator = np.zeros((place.size, len(names)))
                        indicator[np.arange(place.size), place.ravel()] = np.repeat(values[part, c], depth)
                        out[c][:, names] += gained @ indicator
        inner = pa.array(np.ascontiguousarray(out.transpose(1, 0, 2)).ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(column) * classes + 1, dtype=np.int32) * width), inner)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(column) + 1, dtype=np.int32) * classes), lists)

    return contributions


def attribute_classes(
    df: DataFrame, explainer: ClassExplainer, features: str = FEATURES, output: str = "contributions", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Add ``contributions`` (an array of features per class) and ``base_values``; per class they sum to its output.

    All classes in one Arrow pass. The leaves are sent in blocks of at most ``block_bytes``.
    """
    context = df.sparkSession.sparkContext
    shared = [context.broadcast(block) for block in _blocks(_grouped(explainer.leaves), block_bytes)]
    run = class_attribution_function(shared, len(explainer.bases), explainer.width)
    contributions = F.arrow_udf(run, "array<array<double>>")
    bases = F.array(*[F.lit(b) for b in explainer.bases])
    return df.withColumns({output: contributions(vector_to_array(features)), "base_values": bases})


def attribution_function(shared):
    """The function that runs in the tasks, from one Arrow column of feature rows to another.

    It refers to NumPy, Arrow and plain tuples only, so that workers need not have this package. Leaves of equal path
    length are worked on together, in parts of about a million cells, which bounds the memory of a task.
    """
    cells = 1 << 20

    def contributions(column: pa.Array) -> pa.Array:
        groups, width = shared.value
        rows = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)
        out = np.zeros(rows.shape)
        for values, features, low, high, share in groups:
            depth = features.shape[1]
            nodes, weights = np.polynomial.legendre.leggauss(depth // 2 + 1)
            step = max(1, cells // max(1, depth * len(rows)))
            for k in range(0, len(values), step):
                part = slice(k, k + step)
                x = rows[:, features[part]]
                passed = ((x > low[part]) & (x <= high[part])).astype(np.float64)
                integral = np.zeros_like(passed)
                for at, weight in zip((nodes + 1) / 2, weights / 2):
                    terms = share[part] * (1 - at) + passed * at
                    integral += weight * terms.prod(axis=2, keepdims=True) / terms
                gained = values[part][:, None] * (passed - share[part]) * integral
                # features repeat among the leaves of a part: a product with their indicator adds them up
                names, place = np.unique(features[part], return_inverse=True)
                indicator = np.zeros((place.size, len(names)))
                indicator[np.arange(place.size), place.ravel()] = 1.0
                out[:, names] += gained.reshape(len(rows), -1) @ indicator
        ends = pa.array(np.arange(len(column) + 1, dtype=np.int32) * width)
        return pa.ListArray.from_arrays(ends, pa.array(out.ravel()))

    return contributions


def attribute(
    df: DataFrame, explainer: Explainer, features: str = FEATURES, output: str = "contributions"
) -> DataFrame:
    """Add ``contributions`` (one per feature) and ``base_value``; together they sum to the output.

    Only the feature column goes to Python, in Arrow batches without a copy per row; all other
    columns stay in the JVM.
    """
    # its size is that of the model: leaves times path length
    shared = df.sparkSession.sparkContext.broadcast((_grouped(explainer.leaves), explainer.width))
    contributions = F.arrow_udf(attribution_function(shared), "array<double>")
    return df.withColumns(
        {output: contributions(vector_to_array(features)), "base_value": F.lit(explainer.base)}
    )


def top_contributions(
    df: DataFrame, id: str = "id", contributions: str = "contributions", k: int = 6, names: list[str] | None = None
) -> DataFrame:
    """The ``k - 1`` largest contributions of each row and the sum of all others, as rows
    (id, position, feature, contribution). Works inside each row: nothing is shuffled."""
    if k < 2:
        raise ValueError("show at least one contribution and the rest")
    label = F.array(*[F.lit(n) for n in names]) if names else None

    def entry(value, i):
        name = i.cast("string") if label is None else F.element_at(label, i + 1)
        return F.struct((-F.abs(value)).alias("order"), i.alias("i"), name.alias("feature"), value.alias("c"))

    ordered = F.array_sort(F.transform(contributions, entry))
    rest = F.when(
        F.size(contributions) >= k,
        F.array(
            F.struct(
                F.lit(OTHERS).alias("feature"),
                F.aggregate(
                    F.slice("ordered", k, F.size(contributions)), F.lit(0.0), lambda a, e: a + e["c"].cast("double")
                ).alias("contribution"),
            )
        ),
    ).otherwise(F.array().cast("array<struct<feature:string,contribution:double>>"))
    shown = F.transform(
        F.slice("ordered", 1, k - 1),
        lambda e: F.struct(e["feature"].alias("feature"), e["c"].cast("double").alias("contribution")),
    )
    return (
        df.select(id, contributions, ordered.alias("ordered"))
        .select(id, F.posexplode(F.concat(shown, rest)).alias("position", "e"))
        .select(id, (F.col("position") + 1).alias("position"), "e.feature", "e.contribution")
    )


def mean_abs_contribution(
    df: DataFrame, contributions: str = "contributions", k: int | None = 8, names: list[str] | None = None
) -> DataFrame:
    """(feature, mean_abs) over all rows, the ``k`` largest or all of them."""
    feature = F.col("i").cast("string")
    if names:
        feature = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("i") + 1)
    ranked = (
        df.select(F.posexplode(contributions).alias("i", "c"))
        .groupBy("i")
        .agg(F.avg(F.abs("c").cast("double")).alias("mean_abs"))
    )
    if k is not None:
        ranked = ranked.orderBy(F.desc("mean_abs"), F.asc("i")).limit(k)
    return ranked.select(feature.alias("feature"), "mean_abs")
