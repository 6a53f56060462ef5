"""Classification quality: multiclass metrics, confusion matrix, recall, ROC curve and AUC.

Every metric first counts rows per (label, prediction) or per (label, score) with map-side combine;
all later steps run on those counts.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions.buckets import with_buckets
from sieveline.functions.expressions import any_of, ratio
from sieveline.operators.prefix import PIECE_ROWS, running_totals, split_points


def _names(by: str | list[str] | None) -> list[str]:
    return [] if by is None else [by] if isinstance(by, str) else list(by)


def outcome_counts(df: DataFrame, label: str, prediction: str, by: str | list[str] | None = None) -> DataFrame:
    return df.groupBy(*_names(by), F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def class_counts(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: str | list[str] | None = None
) -> DataFrame:
    """(class, tp, fp, fn, support) for every class seen as label or as prediction."""
    return class_counts_of(outcome_counts(df, label, prediction, by), by)


def class_counts_of(outcomes: DataFrame, by: str | list[str] | None = None) -> DataFrame:
    """:func:`class_counts` from rows (by, label, prediction, n)."""
    keys = _names(by)
    # null is a class like any other: a missing prediction is a miss of its label
    hit = F.col("label").eqNullSafe(F.col("prediction"))
    zero = F.lit(0).cast("long")
    sides = F.array(
        F.struct(
            F.col("label").alias("class"),
            F.when(hit, F.col("n")).otherwise(zero).alias("tp"),
            zero.alias("fp"),
            F.when(~hit, F.col("n")).otherwise(zero).alias("fn"),
            F.col("n").alias("support"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            zero.alias("tp"),
            F.when(~hit, F.col("n")).otherwise(zero).alias("fp"),
            zero.alias("fn"),
            zero.alias("support"),
        ),
    )
    rows = outcomes.select(*keys, F.inline(sides))
    return rows.groupBy(*keys, "class").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "support")])


def multiclass_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: str | list[str] | None = None
) -> DataFrame:
    """Accuracy and the precision, recall and F1 of the classes weighted by their support.

    A class that is never predicted, or never right, counts with 0.
    """
    return multiclass_metrics_of(outcome_counts(df, label, prediction, by), by)


def multiclass_metrics_of(outcomes: DataFrame, by: str | list[str] | None = None) -> DataFrame:
    """:func:`multiclass_metrics` from rows (by, label, prediction, n)."""
    zero = F.lit(0.0)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    scored = class_counts_of(outcomes, by).select(
        *_names(by),
        "tp",
        "support",
        F.coalesce(ratio(tp, tp + fp), zero).alias("precision"),
        F.coalesce(ratio(tp, tp + fn), zero).alias("recall"),
        F.coalesce(ratio(2 * tp, 2 * tp + fp + fn), zero).alias("f1"),
    )
    n = F.sum("support")

    def weighted(c: str) -> Column:
        return ratio(F.sum(F.col(c) * F.col("support")), n).alias(f"weighted_{c}")

    return scored.groupBy(*_names(by)).agg(
        ratio(F.sum("tp"), n).alias("accuracy"),
        weighted("precision"),
        weighted("recall"),
        weighted("f1"),
    )


def confusion_pairs(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n) for every pair of classes seen on either side, zeros included.

    Rows of the full matrix are laid out from the set of classes, so its size is that of the result.
    """
    counts = outcome_counts(df, label, prediction)
    classes = counts.select(F.explode(F.array("label", "prediction")).alias("class")).distinct()
    # wrapped, since collecting passes over nulls
    every = classes.agg(F.collect_set(F.struct("class")).alias("classes"))
    grid = every.select(F.explode("classes.class").alias("label"), "classes").select(
        "label", F.explode("classes.class").alias("prediction"), F.lit(0).cast("long").alias("n")
    )
    return grid.unionByName(counts).groupBy("label", "prediction").agg(F.sum("n").alias("n"))


def _class_names(values: list) -> list[str]:
    """Texts of classes that can stand in column names: ``0`` for 0.0, ``null`` for None, no dots, each once."""
    names: list[str] = []
    for value in values:
        if isinstance(value, float) and value.is_integer():
            value = int(value)
        name = "null" if value is None else str(value).replace(".", "_")
        taken = {*names}
        names.append(next(n for n in (name, *(f"{name}_{k}" for k in range(2, len(values) + 2))) if n not in taken))
    return names


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction", classes: list | None = None
) -> DataFrame:
    """Rows are actual classes, ``predicted_<class>`` columns count the predictions.

    A missing class is a class too, named ``null`` and put last. If ``classes`` names the columns, predictions of any
    other class are counted in ``predicted_other``, so that the counts always add up to the rows.
    """
    counts = outcome_counts(df, label, prediction)
    # every class is a row, also one that is only predicted
    pairs = counts.unionByName(counts.select(F.col("prediction").alias("label"), "prediction", F.lit(0).cast("long").alias("n")))
    named = classes is not None
    if not named:
        found = [r[0] for r in pairs.select("label").distinct().collect()]
        classes = sorted(c for c in found if c is not None) + [None] * (None in found)
    of_class = [F.col("prediction").eqNullSafe(F.lit(c)) for c in classes]
    n = F.col("n")
    wide = [
        F.sum(F.when(is_it, n).otherwise(0)).alias(f"predicted_{name}")
        for is_it, name in zip(of_class, _class_names(classes), strict=True)
    ]
    if named:
        wide.append(F.sum(F.when(any_of(of_class), 0).otherwise(n)).alias("predicted_other"))
    return pairs.groupBy("label").agg(*wide)


def recall(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    positive=1,
    by: str | list[str] | None = None,
) -> DataFrame:
    """Share of the positive rows that are predicted positive; null where there are none."""
    return df.groupBy(*_names(by)).agg(recall_of(F.col(label), F.col(prediction), positive).alias("recall"))


def recall_of(label: Column, prediction: Column, positive=1, where: Column | None = None) -> Column:
    """The aggregate behind :func:`recall`, over the rows that fulfil ``where``."""
    actual = label == F.lit(positive)
    if where is not None:
        actual = actual & where
    return ratio(F.count_if(actual & (prediction == F.lit(positive))), F.count_if(actual))


def penalized_recall(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    split: str = "split",
    train: str = "train",
    validation: str = "val",
) -> DataFrame:
    """Validation recall less its distance to the training recall, from one aggregate."""
    y, p, s = F.col(label), F.col(prediction), F.col(split)
    both = df.agg(
        recall_of(y, p, where=s == train).alias("train_recall"),
        recall_of(y, p, where=s == validation).alias("validation_recall"),
    )
    gap = F.abs(F.col("train_recall") - F.col("validation_recall"))
    return both.withColumn("objective", F.col("validation_recall") - gap)


def _cumulative(df, label, score, by, positive, piece_rows) -> DataFrame:
    """Per distinct score, positives and negatives at it and at or above it."""
    keys = _names(by)
    # a row without label is neither positive nor negative, and a score of such rows alone is no point of the curve
    rows = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    points = split_points(rows, score, piece_rows)
    hit = F.col(label) == F.lit(positive)
    counts = rows.groupBy(*keys, F.col(score).alias("threshold")).agg(
        F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg")
    )
    return running_totals(counts, "threshold", ["pos", "neg"], keys, points, descending=True)


def roc_curve(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    by: str | list[str] | None = None,
    positive=1,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score and for the origin, whose threshold is null.

    A rate is null in a set that lacks the class it refers to.
    """
    keys = _names(by)
    cumulative = _cumulative(df, label, score, by, positive, piece_rows)
    point = F.struct(
        F.col("threshold"),
        ratio(F.col("cum_neg"), F.col("total_neg")).alias("fpr"),
        ratio(F.col("cum_pos"), F.col("total_pos")).alias("tpr"),
    )
    origin = F.struct(
        F.lit(None).cast(cumulative.schema["threshold"].dataType).alias("threshold"),
        ratio(F.lit(0), F.col("total_neg")).alias("fpr"),
        ratio(F.lit(0), F.col("total_pos")).alias("tpr"),
    )
    # the highest score of a set is the one with nothing above it
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    return cumulative.select(*keys, F.inline(F.when(first, F.array(origin, point)).otherwise(F.array(point))))


def _next_counts(counts: DataFrame, keys: list[str], points: list[float]) -> DataFrame:
    """Add ``next_pos, next_neg``: the counts at the next lower threshold of the group, null at its lowest.

    Each piece of the score axis runs its own window; the highest row of a piece is handed to the last row of the piece before it.
    """
    axis = F.col("threshold").cast("double") + F.lit(0.0)
    pieces = with_buckets(counts.withColumn("_axis", axis), {"_piece": ("_axis", points)}).drop("_axis")
    inside = Window.partitionBy(*keys, "_piece").orderBy(F.desc("threshold"))
    row = F.struct("pos", "neg")
    local = pieces.withColumns({"_next": F.lead(row).over(inside), "_last": F.lead("threshold").over(inside).isNull()})
    heads = pieces.groupBy(*keys, "_piece").agg(F.max_by(row, "threshold").alias("_head"))
    # one row per piece and group
    below = heads.withColumn("_below", F.lead("_head").over(Window.partitionBy(*keys).orderBy(F.desc("_piece")))).select(
        *[F.col(k).alias(f"_at_{k}") for k in [*keys, "_piece"]], "_below"
    )
    same = [F.col(k).eqNullSafe(F.col(f"_at_{k}")) for k in [*keys, "_piece"]]
    joined = local.join(below, reduce(and_, same)).withColumn("_next", F.when(F.col("_last"), F.col("_below")).otherwise(F.col("_next")))
    return joined.select(*counts.columns, F.col("_next.pos").alias("next_pos"), F.col("_next.neg").alias("next_neg"))


def roc_corners(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    by: str | list[str] | None = None,
    positive=1,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """:func:`roc_curve` without the points in the middle of a straight run: those at which the counts of either class go on as they came.

    The highest and the lowest score, and the origin, always stay. The area under the curve is that of all points.
    """
    keys = _names(by)
    rows = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    points = split_points(rows, score, piece_rows)
    hit = F.col(label) == F.lit(positive)
    counts = rows.groupBy(*keys, F.col(score).alias("threshold")).agg(F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg"))
    followed = _next_counts(counts, keys, points)
    cumulative = running_totals(followed, "threshold", ["pos", "neg"], keys, points, descending=True)
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    straight = (F.col("pos") == F.col("next_pos")) & (F.col("neg") == F.col("next_neg"))
    corner = first | F.col("next_pos").isNull() | ~straight
    rate = lambda side: ratio(F.col(f"cum_{side}"), F.col(f"total_{side}"))
    none = lambda side: ratio(F.lit(0), F.col(f"total_{side}"))
    point = F.struct(F.col("threshold"), rate("neg").alias("fpr"), rate("pos").alias("tpr"))
    origin = F.struct(
        F.lit(None).cast(cumulative.schema["threshold"].dataType).alias("threshold"), none("neg").alias("fpr"), none("pos").alias("tpr")
    )
    return cumulative.where(corner).select(*keys, F.inline(F.when(first, F.array(origin, point)).otherwise(F.array(point))))


def roc_auc(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    by: str | list[str] | None = None,
    positive=1,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Area under the ROC curve by trapezoids; null in a set with one class only."""
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    above = F.col("cum_pos").cast("double") - pos
    area = F.sum(neg * (above + pos / 2))
    pairs = F.first("total_pos").cast("double") * F.first("total_neg").cast("double")
    cumulative = _cumulative(df, label, score, by, positive, piece_rows)
    return cumulative.groupBy(*_names(by)).agg(ratio(area, pairs).alias("auc"))
