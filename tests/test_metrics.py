import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from sieveline.operators import metrics


def scored(spark, n, seed, levels=None):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        label = int(rng.random() < 0.4)
        score = rng.gauss(label, 1.0)
        score = round(score * levels) / levels if levels else score
        rows.append((i, label, 0.25 if i % 3 == 0 else score, ("a", "b")[i % 2]))
    return rows, spark.createDataFrame(rows, "id int, label int, score double, s string").repartition(6)


def brute_auc(rows):
    pos = [s for _, y, s, *_ in rows if y == 1]
    neg = [s for _, y, s, *_ in rows if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("piece_rows", [20, 10**6])
@pytest.mark.parametrize("levels", [None, 4])
def test_auc_equals_all_pairs(spark, piece_rows, levels):
    rows, df = scored(spark, 500, 1, levels)
    assert metrics.roc_auc(df, piece_rows=piece_rows).first()["auc"] == pytest.approx(brute_auc(rows))
    by = {r["s"]: r["auc"] for r in metrics.roc_auc(df, by="s", piece_rows=piece_rows).collect()}
    assert by == pytest.approx({s: brute_auc([r for r in rows if r[3] == s]) for s in "ab"})


def test_auc_equals_spark_evaluator(spark):
    _, df = scored(spark, 400, 5)
    ready = df.select(F.col("label").cast("double"), F.col("score").alias("rawPrediction"))
    expected = BinaryClassificationEvaluator(numBins=0).evaluate(ready)
    assert metrics.roc_auc(df, piece_rows=30).first()["auc"] == pytest.approx(expected)


@pytest.mark.parametrize("piece_rows", [25, 10**6])
def test_roc_curve(spark, piece_rows):
    rows, df = scored(spark, 400, 2, 5)
    found = {r["threshold"]: (r["fpr"], r["tpr"]) for r in metrics.roc_curve(df, piece_rows=piece_rows).collect()}
    pos, neg = sum(r[1] for r in rows), sum(1 - r[1] for r in rows)
    expected = {None: (0.0, 0.0)}
    for t in {r[2] for r in rows}:
        expected[t] = (
            sum(r[2] >= t and r[1] == 0 for r in rows) / neg,
            sum(r[2] >= t and r[1] == 1 for r in rows) / pos,
        )
    assert found.keys() == expected.keys()
    for t, point in expected.items():
        assert found[t] == pytest.approx(point)


def test_one_class_and_tied_scores(spark):
    one = spark.createDataFrame([(1, 0.1), (1, 0.7)], "label int, score double")
    assert metrics.roc_auc(one).first()["auc"] is None
    assert {(r["fpr"], r["tpr"]) for r in metrics.roc_curve(one).collect()} == {(None, 0.0), (None, 0.5), (None, 1.0)}
    tied = spark.createDataFrame([(1, 0.5), (0, 0.5), (0, 0.5)], "label int, score double")
    assert metrics.roc_auc(tied).first()["auc"] == 0.5
    assert metrics.roc_curve(tied).count() == 2


def test_rows_are_ordered_piece_by_piece(spark, plan_of):
    _, df = scored(spark, 500, 1)
    text = plan_of(metrics.roc_auc(df, piece_rows=20))
    windows = [line for line in text.splitlines() if "Window [" in line and "threshold" in line]
    assert windows and all("_piece" in line for line in windows)


def test_both_sides_share_the_shuffled_counts(spark, sf_dir, plan_of):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    df = orders.selectExpr("o_totalprice as score", "int(o_orderstatus = 'F') as label", "o_orderpriority as s")
    result = metrics.roc_auc(df, by="s", piece_rows=100)
    assert len(result.collect()) == 5
    assert "ReusedExchange" in plan_of(result)


def test_a_set_without_name_is_kept(spark):
    rows = [(1, 0.9, None), (0, 0.1, None), (1, 0.2, "a"), (0, 0.7, "a")]
    df = spark.createDataFrame(rows, "label int, score double, s string")
    assert {r["s"]: r["auc"] for r in metrics.roc_auc(df, by="s").collect()} == {None: 1.0, "a": 0.0}


def classified(spark):
    rng = random.Random(4)
    rows = [(float(rng.randrange(4)), float(rng.choice([0, 1, 1, 2, 5]))) for _ in range(300)]
    return rows, spark.createDataFrame(rows, "label double, prediction double")


def test_multiclass_metrics_equal_spark_evaluator(spark):
    _, df = classified(spark)
    found = metrics.multiclass_metrics(df).first().asDict()
    names = {"accuracy": "accuracy", "weighted_precision": "weightedPrecision", "weighted_recall": "weightedRecall"}
    names["weighted_f1"] = "f1"
    for ours, theirs in names.items():
        assert found[ours] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(df))


def test_confusion_matrix_has_all_classes_of_both_sides(spark):
    rows, df = classified(spark)
    wide = {r["label"]: r.asDict() for r in metrics.confusion_matrix(df).collect()}
    assert set(wide) == {0.0, 1.0, 2.0, 3.0, 5.0}
    for label in wide:
        for prediction in wide:
            assert wide[label][f"predicted_{int(prediction)}"] == rows.count((label, prediction))
    assert metrics.confusion_pairs(df).count() == 25


def test_recall_and_penalty(spark):
    rows = [("train", 1, 1), ("train", 1, 1), ("val", 1, 1), ("val", 1, 0), ("val", 0, 1), ("test", 0, 0)]
    df = spark.createDataFrame(rows, "split string, label int, prediction int")
    by = {r["split"]: r["recall"] for r in metrics.recall(df, by="split").collect()}
    assert by == {"train": 1.0, "val": 0.5, "test": None}
    row = metrics.penalized_recall(df).first()
    assert (row["train_recall"], row["validation_recall"], row["objective"]) == (1.0, 0.5, 0.0)


def test_nothing_is_dropped_from_the_confusion_matrix(spark):
    rows = [("a", "a"), ("a", None), ("b", "b"), (None, "a"), ("a.b", "a_b"), (None, None)]
    df = spark.createDataFrame(rows, "label string, prediction string")
    found = metrics.confusion_matrix(df)
    assert found.columns == ["label", "predicted_a", "predicted_a_b", "predicted_a_b_2", "predicted_b", "predicted_null"]
    assert sum(sum(tuple(r)[1:]) for r in found.collect()) == len(rows)
    named = metrics.confusion_matrix(df, classes=["a"])
    assert named.columns == ["label", "predicted_a", "predicted_other"]
    assert sum(sum(tuple(r)[1:]) for r in named.collect()) == len(rows)
    scores = metrics.multiclass_metrics(df.limit(3).where("label is not null")).first()
    assert scores["accuracy"] == pytest.approx(2 / 3) and scores["weighted_recall"] == pytest.approx(2 / 3)


def test_one_origin_where_the_highest_score_has_no_label(spark):
    df = spark.createDataFrame([(None, 0.9), (1, 0.8), (0, 0.1)], "label int, score double")
    assert sum(r["threshold"] is None for r in metrics.roc_curve(df).collect()) == 1


@pytest.mark.parametrize("piece_rows", [3, 40, 10**6])
def test_corners_are_the_points_where_the_counts_change(spark, piece_rows):
    rng = random.Random(3)
    rows = []
    for s in ("a", "b", None):
        for score in range(60):
            # runs of equal counts, some of them across pieces
            pos, neg = [(1, 0), (1, 2), (0, 1)][(score // 7) % 3] if s != "b" else (rng.randrange(2), 1)
            rows += [(s, float(score), 1)] * pos + [(s, float(score), 0)] * neg
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "s string, score double, label int").repartition(4)
    whole = metrics.roc_curve(df, by="s", piece_rows=piece_rows).collect()
    found = metrics.roc_corners(df, by="s", piece_rows=piece_rows).collect()
    assert len(found) < len(whole) and {tuple(r) for r in found} <= {tuple(r) for r in whole}
    for s in ("a", "b", None):
        counts = {}
        for x, score, label in rows:
            if x == s:
                counts.setdefault(score, [0, 0])[label] += 1
        order = sorted(counts, reverse=True)
        kept = [k for k, t in enumerate(order) if k in (0, len(order) - 1) or counts[t] != counts[order[k + 1]]]
        assert sorted(r["threshold"] for r in found if r["s"] == s and r["threshold"] is not None) == sorted(order[k] for k in kept)
        assert sum(r["threshold"] is None for r in found if r["s"] == s) == 1
        curve = sorted((r["fpr"], r["tpr"]) for r in found if r["s"] == s)
        area = sum((x1 - x0) * (y0 + y1) / 2 for (x0, y0), (x1, y1) in zip(curve, curve[1:]))
        assert area == pytest.approx(metrics.roc_auc(df.where(F.col("s").eqNullSafe(F.lit(s)))).first()["auc"])


def test_corners_of_few_points(spark):
    one = spark.createDataFrame([(0.5, 1), (0.5, 0)], "score double, label int")
    assert {tuple(r) for r in metrics.roc_corners(one).collect()} == {(None, 0.0, 0.0), (0.5, 1.0, 1.0)}
    assert metrics.roc_corners(one.limit(0)).count() == 0
