"""Lift and gain over score bins.

The rows are aggregated once to one row per set and bin; everything after that runs on those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions.expressions import ratio
from sieveline.operators.bins import fit_score_bins, reversed_bin
from sieveline.operators.ranks import BRACKET_ROWS


def bin_summary(
    df: DataFrame,
    label: str,
    score: str,
    id: str,
    bins: int = 10,
    weight: str | None = None,
    by: str | None = None,
    bracket_rows: int = BRACKET_ROWS,
) -> DataFrame:
    """(by, bin, weighted_positives, weight, positives); bin 1 holds the highest scores."""
    fitted = fit_score_bins(df, score, id, bins, weight, by, bracket_rows)
    w = F.lit(1) if weight is None else F.col(weight)
    keys = [by] if by else []
    binned = fitted.apply(df, "_bin")
    summary = binned.groupBy(*keys, reversed_bin(bins, "_bin").alias("bin")).agg(
        F.sum(F.col(label) * w).alias("weighted_positives"),
        F.sum(w).alias("weight"),
        F.sum(label).alias("positives"),
        F.count("_bin").alias("binned"),
    )
    # rows without score are left out by their count: a filter on the bin itself would be pushed down
    # and compute all the bins a second time
    return summary.where(F.col("binned") > 0).drop("binned")


def _within(by: str | None):
    return Window.partitionBy(*([by] if by else []))


def _baseline(by: str | None) -> Column:
    return ratio(F.sum("weighted_positives").over(_within(by)), F.sum("weight").over(_within(by)))


def _lift() -> Column:
    return ratio(F.col("weighted_positives"), F.col("weight"))


def _gain(by: str | None) -> Column:
    so_far = _within(by).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    return ratio(F.sum("positives").over(so_far), F.sum("positives").over(_within(by)))


def lift_table(summary: DataFrame, by: str | None = None) -> DataFrame:
    """Per bin the weighted share of positives, and its ratio to the share over all rows."""
    keys = [by] if by else []
    return summary.select(
        *keys,
        "bin",
        _baseline(by).alias("baseline_percentage"),
        _lift().alias("lift_percentage"),
        ratio(_lift(), _baseline(by)).alias("lift_index"),
    )


def gain_table(summary: DataFrame, by: str | None = None) -> DataFrame:
    """Per bin the running share of all positives, from the highest scores down."""
    keys = [by] if by else []
    return summary.select(*keys, "bin", "positives", _gain(by).alias("gain"))


def lift_gain_table(summary: DataFrame, by: str | None = None) -> DataFrame:
    """The chart-ready table with rows ``deciles`` = 0 .. number of bins.

    Row k carries the lift of the bin after the k first ones and the gain through those k, so the
    lift of the last row and the gain of the first are 0. ``random`` is the lift of no model.
    """
    keys = [by] if by else []
    ordered = _within(by).orderBy("bin")
    filled = summary.select(
        *keys,
        F.row_number().over(ordered).alias("k"),
        F.count(F.lit(1)).over(_within(by)).alias("n"),
        _baseline(by).alias("baseline"),
        _lift().alias("lift"),
        ratio(_lift(), _baseline(by)).alias("index"),
        _gain(by).alias("gain"),
    )

    def row(k: Column, lift: Column | None, index: Column | None, gain: Column | None) -> Column:
        parts = {"lift_percentage": lift, "lift_index": index, "gain": gain}
        values = [(F.lit(None) if v is None else v).cast("double").alias(n) for n, v in parts.items()]
        return F.struct(k.cast("int").alias("deciles"), F.col("baseline").alias("baseline_percentage"), *values)

    zero = F.lit(0.0)
    entries = F.array(
        row(F.col("k") - 1, F.col("lift"), F.col("index"), F.when(F.col("k") == 1, zero)),
        row(
            F.col("k"),
            F.when(F.col("k") == F.col("n"), zero),
            F.when(F.col("k") == F.col("n"), zero),
            F.col("gain"),
        ),
    )
    measures = ["baseline_percentage", "lift_percentage", "lift_index", "gain"]
    return (
        filled.select(*keys, F.inline(entries))
        .groupBy(*keys, "deciles")
        .agg(*[F.max(c).alias(c) for c in measures])
        .withColumns({"baseline_index": F.lit(1), "random": F.lit(1)})
    )
